"""Path and name functions: column expressions over file paths and labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Folders of vendored or generated files, in the order in which they are looked for (fixed values).
VENDOR_DIRS = [
    "node_modules", "bower_components", "jspm_packages", "vendor", "packages", "dist", "build", "bin", "obj", "target",
    ".next", "coverage", "__pycache__", "site-packages", "wwwroot/lib",
]

#: Extensions of each class of files (fixed values).
CLASSES = {
    "code": (
        "cs vb fs java kt scala py rb go rs js jsx ts tsx php c h cpp hpp m sql sh bash ps1 psm1 bat cmd bicep tf csproj "
        "vbproj sqlproj sln gradle"
    ).split(),
    "config/data": (
        "json yml yaml xml toml ini conf config properties env bicepparam tfvars csv tsv editorconfig gitignore dockerignore "
        "gitattributes ssc"
    ).split(),
    "doc": "md txt rst adoc pdf docx xlsx pptx".split(),
    "binary": (
        "png jpg jpeg gif ico svg woff woff2 ttf zip gz tar rar 7z dll exe so dylib pdb nupkg jar war bin dat mdf ldf bak"
    ).split(),
}

#: File names that are a finding by themselves (fixed value).
RISKY = (
    r"(?i)(^|/)(\.env(\..+)?|\.envrc|\.npmrc|\.pypirc|\.netrc|\.htpasswd|id_rsa|id_dsa|id_ecdsa|id_ed25519|known_hosts|"
    r"authorized_keys|credentials?|secrets?|passwords?|apikeys?|.*\.publishsettings|.*servicedependencies\.local\.json|"
    r".*\.pem|.*\.key|.*\.pfx|.*\.p12|.*\.jks|.*\.keystore|.*\.ppk|.*\.asc|.*\.gpg|.*\.kdbx|.*\.ovpn|.*\.tfstate.*|"
    r".*\.tfvars|.*\.mdf|.*\.bak|.*\.dump|.*\.sql\.gz)$"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row: a column named several times, step upon step, is otherwise written out each time."""
    return F.element_at(F.transform(F.array(value), body), 1)


def slashes(path: Column) -> Column:
    """Forward slashes; null becomes empty."""
    return F.translate(F.coalesce(path, F.lit("")), "\\", "/")


def leaf(path: Column) -> Column:
    """The last part of a path, slashes at its end left out."""
    return F.regexp_extract(F.rtrim(slashes(path), F.lit("/")), r"(?s)([^/]*)\z", 1)


def _ending(name: Column) -> Column:
    """What follows the last dot if something precedes it."""
    return F.regexp_extract(name, r"(?s)\A.+\.([^.]*)\z", 1)


def ext_key(path: Column) -> Column:
    """Lower-case extension; a dotfile is its own extension; '' if there is none."""
    name = F.lower(leaf(path))
    return F.when(name.rlike(r"\A\.[^.]*\z"), F.substring(name, 2, 1 << 20)).otherwise(_ending(name))


def ext_or_none(path: Column) -> Column:
    """Like ``ext_key`` on the raw last part, but '(none)' where there is no dot with something before it."""
    name = F.lower(F.regexp_extract(F.coalesce(path, F.lit("")), r"(?s)([^/]*)\z", 1))
    dotted = F.when(name.rlike(r"(?s)\A.+\.[^.]*\z"), _ending(name)).otherwise("(none)")
    return F.when(name.rlike(r"\A\.[^.]*\z"), F.substring(name, 2, 1 << 20)).otherwise(dotted)


def ext_label(path: Column) -> Column:
    """'.java', '(dotfile)', '(no extension)' or '(blank)'."""
    name = leaf(path)
    dotted = F.when(name.rlike(r"(?s)\A.+\.[^.]*\z"), F.concat(F.lit("."), F.lower(_ending(name))))
    return F.when(name == "", "(blank)").when(name.rlike(r"\A\.[^.]*\z"), "(dotfile)").otherwise(F.coalesce(dotted, F.lit("(no extension)")))


def vendor_of(path: Column) -> Column:
    """The first of VENDOR_DIRS, in list order, that is a folder of the path; '' if none is."""
    folders = F.concat(F.lit("/"), F.regexp_extract(F.lower(path), r"(?s)\A(.*/)?[^/]*\z", 1))
    hit = [F.when(F.contains(folders, F.lit(f"/{v}/")), v) for v in VENDOR_DIRS]
    return F.coalesce(*hit, F.lit(""))


def _stripped(text: Column) -> Column:
    return F.trim(slashes(text), F.lit(" \t\n\x0b\f\r"))


def _parts(rel: Column, filename: Column, org: Column, repo: Column) -> Column:
    """struct<rel, name, repo, after>: path and name without what surrounds them, and what follows '<org>/<repo>/' in the path, else the path."""

    def marked(v: Column) -> Column:
        after = F.when((v["at"] > 0) & (v["org"] != "") & (v["repo"] != ""), F.substr(v["rel"], v["at"] + F.length(v["mark"]) + 1)).otherwise(v["rel"])
        return F.struct(v["rel"].alias("rel"), v["name"].alias("name"), v["repo"].alias("repo"), after.alias("after"))

    def found(v: Column) -> Column:
        at = F.instr(F.concat(F.lit("/"), F.lower(v["rel"]), F.lit("/")), F.concat(F.lit("/"), v["mark"], F.lit("/")))
        return F.struct(*[v[c].alias(c) for c in ("rel", "name", "org", "repo", "mark")], at.alias("at"))

    plain = [F.regexp_replace(_stripped(rel), r"\A(?:\./)*/*", "").alias("rel"), _stripped(filename).alias("name")]
    parts = F.struct(*plain, org.alias("org"), repo.alias("repo"), F.lower(F.concat(org, F.lit("/"), repo)).alias("mark"))
    return let(let(parts, found), marked)


def _named(rel: Column, name: Column) -> Column:
    """The path with its name, appended if it is missing, without slashes around it and doubled ones."""
    both = (
        F.when(rel.isin("", ".") & (name == ""), "")
        .when(rel.isin("", "."), name)
        .when((name == "") | (rel == name) | rel.endswith(F.concat(F.lit("/"), name)), rel)
        .otherwise(F.concat(rel, F.lit("/"), name))
    )
    return F.trim(F.regexp_replace(both, "/{2,}", "/"), F.lit("/"))


def full_path(rel: Column, filename: Column, org: Column, repo: Column, strip_root: bool = True) -> Column:
    """A path within its repository: slashes, no leading ./ or /, no doubled ones, nothing up to '<org>/<repo>/', name appended if it is missing.

    With ``strip_root`` off, folders down to the repository stay. Null parts are empty.
    """
    return let(_parts(rel, filename, org, repo), lambda v: _named(v["after" if strip_root else "rel"], v["name"]))


def candidates(rel: Column, filename: Column, org: Column, repo: Column) -> Column:
    """Paths to look for, best first, each once: within the repository, without a leading '<repo>/', and with the folders before the repository."""

    def every(v: Column) -> Column:
        inner = lambda p: F.when(p.startswith(F.concat(v["repo"], F.lit("/"))), F.substr(p, F.length(v["repo"]) + 2))
        return let(_named(v["after"], v["name"]), lambda p: F.array(p, F.coalesce(inner(p), F.lit("")), _named(v["rel"], v["name"])))

    args = F.struct(rel.alias("rel"), filename.alias("name"), org.alias("org"), repo.alias("repo"))
    found = let(args, lambda v: let(_parts(*[v[c] for c in ("rel", "name", "org", "repo")]), every))
    return F.filter(F.array_distinct(found), lambda p: p != "")


def root_of(rel: Column, org: Column, repo: Column) -> Column:
    """What stands before '<org>/<repo>' in a path; '(none)' if nothing does."""
    mark = F.lower(F.concat(F.lit("/"), org, F.lit("/"), repo, F.lit("/")))
    text = F.concat(F.lit("/"), slashes(rel), F.lit("/"))
    at = F.instr(F.lower(text), mark)
    root = F.trim(F.substring(text, F.lit(1), at - 1), F.lit("/"))
    return F.when((at > 0) & (root != ""), root).otherwise("(none)")


def inventory_key(repo: Column, path: Column, strict: bool = False) -> Column:
    """'<repo>/<path>' without outer slashes; backslashes count as slashes unless strict."""
    both = [repo, path] if strict else [slashes(repo), slashes(path)]
    return F.concat_ws("/", *[F.trim(x, F.lit("/")) for x in both])


def is_git_internal(path: Column, relpath: Column) -> Column:
    """Whether either path lies in a .git folder."""
    inside = r"\A\.git\z|\A\.git/|/\.git/"
    return slashes(path).rlike(inside) | slashes(relpath).rlike(inside)


def fold_git(label: Column, path: Column) -> Column:
    """struct<label, internal>: a label without trailing .git parts, and whether label or path is in a .git folder."""
    ending = r"(?i)(?<=[^/])(?:/\.git(?:\s*[(\-][^/]*)?)+\z"
    clean = F.array_join(F.filter(F.split(label, "/"), lambda p: p != ""), "/")
    inside = F.exists(F.split(path, "/"), lambda p: p.rlike(r"(?i)\A\.git(\s*[(\-].*)?\z"))
    return F.struct(F.regexp_replace(clean, ending, "").alias("label"), (clean.rlike(ending) | inside).alias("internal"))


def below_git(path: Column) -> Column:
    """What follows the last '/.git/'."""
    return F.substring_index(slashes(path), "/.git/", -1)


def mapped(path: Column, mark: str, root: str) -> Column:
    """What follows ``mark`` in a path, under another root; null without the mark."""
    at = F.instr(slashes(path), mark)
    return F.when(at > 0, F.concat(F.lit(root), F.substr(slashes(path), at + F.lit(len(mark)))))


def split_org(full: Column) -> Column:
    """struct<org, name> of 'org/name'; an empty org without a slash."""
    return F.struct(F.regexp_extract(full, r"\A(?:(.*)/)?[^/]*\z", 1).alias("org"), F.substring_index(full, "/", -1).alias("name"))


def file_class(path: Column) -> Column:
    """code, config/data, doc, binary, no-ext or other, by extension."""
    name = F.lower(F.regexp_extract(path, r"(?s)([^/]*)\z", 1))
    ext = F.regexp_extract(name, r"(?s)\A\.*[^.].*\.([^.]*)\z", 1)
    dotted = name.rlike(r"(?s)\A\.*[^.].*\.[^.]*\z")
    out = F.when(~dotted, "no-ext")
    for kind, exts in CLASSES.items():
        out = out.when(ext.isin(exts), kind)
    return out.otherwise("other")


def risky_name(path: Column) -> Column:
    return path.rlike(RISKY)


def unbrace_rename(path: Column) -> Column:
    """'a/{b => c}/d' to 'a/c/d'."""
    return F.regexp_replace(F.regexp_replace(path, r"\{.*? => (.*?)\}", "$1"), "//+", "/")


def ancestors(path: Column) -> Column:
    """All folders of a path, '.' first."""
    parts = F.split(path, "/")
    folders = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    return F.when(F.size(parts) > 1, F.concat(F.array(F.lit(".")), folders)).otherwise(F.array(F.lit(".")))


def left_out_reason(path: Column) -> Column:
    """docfx_cache, macos, vendored, or '' for what is to be merged (fixed values, as are the folders they are told by)."""
    low = F.lower(path)
    name = F.regexp_extract(low, r"(?s)([^/]*)\z", 1)
    mac = F.contains(F.concat(F.lit("/"), low), F.lit("__macosx/")) | name.startswith("._") | (name == ".ds_store")
    return (
        F.when(F.contains(low, F.lit("obj/.cache/build/")), "docfx_cache").when(mac, "macos").when(vendor_of(path) != "", "vendored").otherwise("")
    )


def clean_path(path: Column) -> Column:
    """Safe relative path: no empty or '.' parts; '..' cannot climb out."""
    parts = F.filter(F.split(slashes(path), "/"), lambda p: ~p.isin("", "."))
    return F.array_join(F.transform(parts, lambda p: F.when(p == "..", "_..").otherwise(p)), "/")


def clean_name(name: Column, most: int = 150) -> Column:
    """A file name of safe characters and bounded length."""
    return F.substring(F.regexp_replace(name, r"[^A-Za-z0-9._-]+", "_"), 1, most)


def case_name(path: Column, n: Column) -> Column:
    """'a/b.txt' to 'a/b__case2.txt' for n = 2; unchanged for n = 1. A dot that begins a name begins no extension."""
    stem = F.regexp_replace(path, r"(?s)(?<=[^/])\.[^./]*\z", "")
    end = F.regexp_extract(path, r"(?s)[^/](\.[^./]*)\z", 1)
    return F.when(n > 1, F.concat(stem, F.lit("__case"), n, end)).otherwise(path)


def version_name(path: Column, n: Column) -> Column:
    """'a/b.txt' to 'a/b.v2.txt'."""
    stem = F.regexp_extract(path, r"(?s)\A(.*?)(\.[^./]*)?\z", 1)
    end = F.regexp_extract(path, r"(?s)\A(.*?)(\.[^./]*)?\z", 2)
    return F.concat(stem, F.lit(".v"), n, end)


def store_path(ext: Column, blob: Column, *where: Column) -> Column:
    """Place of a content in a content-addressed store: files/<ext>/[where/]<two digits>/<blob>.<ext>."""
    name = F.when(ext == "", blob).otherwise(F.concat_ws(".", blob, ext))
    return F.concat_ws("/", F.lit("files"), F.when(ext == "", "no_ext").otherwise(ext), *where, F.substring(blob, 1, 2), name)


def fuzzy(name: Column) -> Column:
    """Letters and digits only, lower case."""
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def shape_flags(path: Column) -> dict[str, Column]:
    """What is unusual about a path."""
    return {
        "backslash": F.contains(path, F.lit("\\")),
        "leading_slash": path.startswith("/"),
        "dot_slash": path.startswith("./"),
        "dot_dot": path.rlike(r"(^|/)\.\.(/|$)"),
        "non_ascii": path.rlike(r"[^\x00-\x7f]"),
        "spaces": F.contains(path, F.lit(" ")),
        "double_slash": F.contains(path, F.lit("//")),
    }


def name_relation(rel: Column, filename: Column) -> Column:
    """Whether a relative path includes the file name, is only its folder, or ends in another name of the same ending (conflict)."""
    rel, name = F.coalesce(slashes(rel), F.lit("")), F.coalesce(filename, F.lit(""))
    last = F.substring_index(rel, "/", -1)
    dotted = F.contains(last, F.lit(".")) & F.contains(name, F.lit("."))
    return (
        F.when((rel == "") | (name == ""), "empty")
        .when((rel == name) | rel.endswith(F.concat(F.lit("/"), name)), "includes")
        .when(dotted & (F.substring_index(last, ".", -1) == F.substring_index(name, ".", -1)), "conflict")
        .otherwise("directory")
    )


def delivery_kind(rel: Column) -> Column:
    """Class of a path in a delivery folder: data, leftover, or the kind of tracking file (fixed values, as are the names of folders and files)."""
    parts = F.split(rel, "/")
    top, second, name = parts[0], F.coalesce(F.get(parts, F.lit(1)), F.lit("")), F.element_at(parts, -1)
    binary = (
        F.when((second == "files") & (F.size(parts) > 2), F.when(F.contains(name, F.lit(".tmp.")), "leftover").otherwise("data"))
        .when(second == "_state", "binary_state")
        .when(rel == "binary/manifest.csv", "binary_manifest")
        .otherwise("binary_summary")
    )
    state = F.when(name == "done.json", "text_done_json").when(name == "manifest.csv", "text_manifest").otherwise("text_state_other")
    text = F.when(second == "_state", state).when(rel.endswith(".txt"), "data").otherwise("text_other")
    return F.when(top == "binary", binary).when(top == "text", text).when(top == "reports", "reports").otherwise("other")


#: Most bytes of a path and of one of its parts, endings of pack files, names of temporary files (fixed values).
PATH_BYTES, NAME_BYTES = 4000, 255
PACK_ENDS = [".pack", ".idx", ".rev"]
TEMPORARY = r"\.tmp\.(\d+(\.\d+)?|copy)$"


def is_git_file(path: Column) -> Column:
    """Whether a path lies in a .git folder, is one, or is a file of a pack, wherever that lies. Null is not."""
    plain = slashes(path)
    packed = [F.lower(plain).endswith(e) for e in PACK_ENDS]
    return plain.rlike(r"(^|/)\.git(/|$)") | packed[0] | packed[1] | packed[2]


def repo_root(label: Column) -> Column:
    """A label without '/.git' at its end, so that a repository and its object store roll up together; '' for null."""
    return F.regexp_replace(F.coalesce(label, F.lit("")), r"/\.git\z", "")


def too_long(path: Column) -> Column:
    """Whether a path has more bytes than a file system takes, as a whole or in one of its parts."""
    return (F.octet_length(path) > PATH_BYTES) | F.exists(F.split(path, "/"), lambda p: F.octet_length(p) > NAME_BYTES)


def under_files(stored: Column) -> Column:
    """What follows the first folder 'files/' of a stored path; '' without one."""
    plain = slashes(stored)
    at = F.when(plain.startswith("files/"), 1).otherwise(F.instr(plain, F.lit("/files/")) + 1)
    return F.when(at > 1, F.substr(plain, at + 6)).when(plain.startswith("files/"), F.substr(plain, F.lit(7))).otherwise("")


def is_temporary(path: Column) -> Column:
    """Whether a file's name is that of a temporary file: '.tmp.' in front, or '.tmp.' and a process, with a thread or not, or 'copy' at its end."""
    name = leaf(path)
    return name.startswith(".tmp.") | name.rlike(TEMPORARY)
