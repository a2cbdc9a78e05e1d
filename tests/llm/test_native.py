"""Native operators against plain Python versions."""

import math
import re
import zlib
from collections import Counter

from palimpsest.llm import licenses, quality, secrets, sharding

WS = r"[^\x20\x09-\x0D]+"


def by_id(rows, texts):
    return [(r, texts[r["doc_id"] // 3] or "" if r["doc_id"] is not None else "a text without an id, twice over") for r in rows]


def test_quality_measures(docs, texts, no_docs):
    rows = by_id(quality.apply_policy(quality.ledger(docs, keep=["lang", "doc_id"])).collect(), texts)
    assert len(rows) == len(texts) + 2
    for r, t in rows:
        words = re.findall(WS, t)
        assert r["n_words"] == len(words)
        assert r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", t))
        lines = [x for x in t.split("\n") if re.search(WS, x)]
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        n = Counter(grams)
        covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(8)}
        assert r["n_repeat_words"] == len(covered), t[:50]
        base = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        assert ((r["failed"] & quality.mask("base")) != 0) == base
        assert not (base and r["kept"])
    assert quality.ledger(no_docs).count() == 0


def test_quality_ablations(docs):
    ledger = quality.ledger(docs).cache()
    rows = ledger.collect()
    on = quality.mask("v2")
    for a in quality.ablations(ledger).collect():
        bit = 1 << next(b for b, name, _ in quality.RULES if name == a["rule"])
        assert a["n_failed"] == sum(bool(r["failed"] & bit) for r in rows)
        assert a["n_only"] == sum(r["failed"] & on == bit for r in rows)
        assert a["n_kept_without"] == sum(r["failed"] & on & ~bit == 0 for r in rows)


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_matches_the_published_algorithm(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *[(i * 0x9E3779B97F4A7C15 + 2**63) % 2**64 - 2**63 for i in range(300)]]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 40, 41, 1000):
        got = df.select("k", sharding.jump_hash(df["k"], n).alias("s")).collect()
        assert all(r["s"] == jump(r["k"] % 2**64, n) for r in got)


def test_shards(docs, texts, no_docs):
    rows = by_id(sharding.assign_shards(docs, 40).collect(), texts)
    assert len(rows) == len(texts) + 2
    slots = {}
    for r, t in rows:
        assert r["size"] == len(t.encode()) + 16 and r["text_crc32"] == zlib.crc32(t.encode()) and r["law"] == "key"
        assert r["grown_shard"] in (r["shard"], 40)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.assign_shards(no_docs, 40).count() == 0


def secret_spans(t):
    out = []
    for k, (kind, p, ok) in enumerate(
        (
            ("assign", r"((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 12),
            ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
            ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
        )
    ):
        out += [(m.start(), k, kind, m.end()) for m in re.finditer(p, t) if ok(m)]
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


#: Random strings from the system's source, of kinds that keys, tokens and passwords have; no keyword is near them.
PLANTED = """
NkdF17EyJs5yOOik h4lRFX2NkekbAz7R CxovicNu014F7r0HUuFY cipJJ2Qaob7KkJFtKSZL IOskyJ2to7NUI6P8lYjyYiJ1 UKBZ3BENCH5YXeFEbRDsbUPt
7LP7wxkHVqS4ZtYAwWBbLMMTnKSLA7cc Hv3IvhedQkkHXS3bFnDMTW9PPuD1gM4n YEUKhO5c8WVqpqpAslHrauzqG59qFTp3DjaRF3tj
fhf9Nue99POnggME9CLpET2ggQ3nBvl5v7yMlsUV 0z1lktpknv6ytimymb0g yzgujh15gy0hxz2ykk4d jnf1a3sz2lxkaa1dmlvf4oi40k27fiqf
9ptlos8reb75dc6u9b1v7me48gtuf5p8 015D922F65AA0EB61CEB70A156F23F70 DF98C92CE8DD550A83917EC88682FCA0
A94B409A05FD58B6430399DA1949C8F42838AACE ABD5A966549FF569084287D858BC2F00680252CE MC5DL5JAYW64ONJQA2G7ZEVFXR
MIFFCNYMIT3AP3WXPFF52JAUKL IQ44ZH4BYOPW2MSJIHNUCSDCBY4JJDKN THO2BORQO6BFPB6TMIQ7O6UDXCBFETA6 QPNt-gTqib15OR4nLMJofM
Y4Bi59LGFO_O_NxcPGcfM7 1_bwcCJ6cLsL0QWCtfvcQURhFntkMW5EweNxTqLnPYE QtXnd_97MQlFErbcxHSacOjfq35ku8HAKdLsBISClD1
/nnMWZ8oeddODqjWHAVZVTUleG3/AgqAp7wZla9C zGouTMbWHNkuksUpHbPhORgXkai3hS9svIvy7ckW
""".split()
#: Identifiers, names and addresses as they occur in code, logs and prose.
ORDINARY = """
java/util/concurrent/ConcurrentHashMap8 test_should_return_404_when_missing application_1700000000000_0001 IMG_20230405_174233
2024-01-15T10-22-33Z libstdc++6-10-dbgsym x86_64-unknown-linux-gnu org-apache-spark-sql-execution-3 py3-none-any-manylinux2014_x86_64
v1beta1_CustomResourceDefinition utf8_general_ci_index_0 sha256sum_check_results_v2 ISO8859-1_to_UTF8_table MAX_CONNECTIONS_PER_HOST_32
getElementsByClassName2 window_size_1920x1080 EC2_INSTANCE_m5_24xlarge customer_order_table_name_2024 src/main/resources/schema_v3
com/example/service/UserRepository2 node_modules/lodash4/fp/_mapping kube-system-coredns-5 release-notes-2023-11-07-final
Quarterly_Report_Q3_2022_final_v2 DSC00123_edited_copy_small backup-2021-12-31-full-weekly TestCase017_LoginWithWrongName
Windows-Server-2019-Datacenter error_code_0x80070005_access build-and-test-ubuntu-22 int32_to_float64_conversion
firmware-update-v10-stable Chapter12_The_Long_Road_Home usr/lib/python3/dist-packages user-agent-mozilla5-compatible
section-3-paragraph-14-of-law Boeing-747-400-freighter-plan H2O_and_CO2_measurements BERT-base-uncased-L12-H768
""".split()


def test_secret_models_on_written_lists(spark):
    """Neither list has to do with the rule that made the training samples."""
    model = secrets.train(secrets.labelled_samples(spark))
    df = spark.createDataFrame([(k, f"see {t} there") for k, t in enumerate(PLANTED + ORDINARY)], "doc_id long, text string")
    found = secrets.scan(df, model)
    said = {r["doc_id"] for r in found.select("doc_id", secrets.rendered(found["spans"]).alias("s")).collect() if r["s"].endswith(f":{4 + len((PLANTED + ORDINARY)[r['doc_id']])}")}
    hit = len([k for k in said if k < len(PLANTED)])
    missed = [t for k, t in enumerate(PLANTED) if k not in said], [t for k, t in enumerate(ORDINARY, len(PLANTED)) if k in said]
    assert hit / len(said) > 0.95 and hit / len(PLANTED) > 0.95, missed


def plain_model(rows):
    """The ratios of all steps, counted in Python."""
    code = lambda c: secrets.ALPHABET.find(c) if c in secrets.ALPHABET else len(secrets.ALPHABET)
    counts = {True: Counter(), False: Counter()}
    for token, random in rows:
        counts[random].update((code(a), code(b)) for a, b in zip(token, token[1:]))
    size = secrets.CLASSES
    total = {k: Counter() for k in counts}
    for k, c in counts.items():
        for (a, _), n in c.items():
            total[k][a] += n
    log = lambda k, a, b: math.log((counts[k][a, b] + 1) / (total[k][a] + size))
    return lambda token: sum(log(True, code(a), code(b)) - log(False, code(a), code(b)) for a, b in zip(token, token[1:])) / max(1, len(token) - 1)


def test_random_spans_against_a_plain_model(spark, docs, texts):
    samples = secrets.labelled_samples(spark)
    score = plain_model([tuple(r) for r in samples.collect()])
    found = secrets.scan(docs, secrets.train(samples))
    some = 0
    for r, t in by_id(found.withColumn("s", secrets.rendered(found["spans"])).collect(), texts):
        base = [(s, e) for _, s, e in secret_spans(t)]
        want, n = [], 0
        for m in re.finditer(secrets.TOKEN, t):
            value = score(m[0])
            if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]) and value > secrets.THRESHOLD:
                n += 1
                if any(not any(s <= k < e for s, e in base) for k in range(m.start(), m.end())):
                    want.append(f"random:{m.start()}:{m.end()}")
        assert [x for x in r["s"].split(",") if x.startswith("random")] == want and r["n_random"] == n
        some += len(want)
    assert some


def test_secrets(spark, docs, texts, no_docs):
    model = secrets.train(secrets.labelled_samples(spark))
    found = secrets.scan(docs, model)
    rows = by_id(found.withColumns({"base": secrets.rendered(found["base"]), "spans": secrets.rendered(found["spans"])}).collect(), texts)
    assert len(rows) == len(texts) + 2
    for r, t in rows:
        want = [f"{k}:{s}:{e}" for k, s, e in secret_spans(t)]
        assert r["base"] == ",".join(want), t[:80]
        got = r["spans"].split(",") if r["spans"] else []
        assert [x for x in got if not x.startswith("random")] == want
        for kind, s, e in (x.split(":") for x in got):
            if kind == "random":
                hit = t[int(s) : int(e)]
                assert re.fullmatch(secrets.TOKEN, hit) and re.search("[0-9]", hit)
    last = next(r for r, t in rows if t.startswith("k9QzLw"))
    assert "random:0:24" in last["spans"] and "random:25:55" not in last["spans"]
    assert secrets.scan(no_docs, model).count() == 0


def test_secret_models_on_held_out_samples(spark):
    samples = secrets.labelled_samples(spark, 2 * secrets.SAMPLES).withColumn("h", __import__("pyspark").sql.functions.xxhash64("token") % 2)
    model = secrets.train(samples.where("h = 0"))
    rest = samples.where("h <> 0")
    scored = rest.select("is_random", (secrets.randomness(rest["token"], model) > secrets.THRESHOLD).alias("said"))
    right, n = scored.selectExpr("count_if(is_random = said)", "count(*)").first()
    assert right / n > 0.97
    assert secrets.train(samples.limit(0)) == [0.0] * secrets.CLASSES**2


def test_redaction(spark, docs, texts):
    model = secrets.train(secrets.labelled_samples(spark, 512))
    found = secrets.scan(docs, model, keep=["text"])
    for r in found.select("text", "spans", secrets.redacted(found["text"], found["spans"]).alias("out")).collect():
        t, at, out = r["text"], 0, ""
        if t is None:
            continue
        for s in r["spans"]:
            if s["start"] >= at:
                out += t[at : s["start"]] + "[secret]"
            at = max(at, s["end"])
        assert r["out"] == out + t[at:]


def license_labels(text):
    """Labels and confidence of the method's own rules, plainly: every hit of every rule against every other."""
    marked = re.sub(licenses.DECLARATION, rf"\1 {licenses.DECLARED} ", text)
    padded = " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", marked.translate(str.maketrans(licenses.UPPER, licenses.LOWER)))) + " "
    hits = []
    for r in licenses.rules():
        if f" {r.keyword} " in padded:
            behind = re.fullmatch(r"\(\?<=(.*?) \[0-9a-z \]\{1,200\} (.*?) \)(.*)", r.pattern)
            # Python's re wants look-behinds of one length: the words before a hit are looked at apart.
            for m in re.finditer(rf"(?<= )(?:{behind[3] if behind else r.pattern})(?= )", padded):
                if not behind or re.search(rf"{behind[1]} [0-9a-z ]{{1,200}} {behind[2]} \Z", padded[: m.start()]):
                    hits.append((padded[: m.start()].count(" ") - 1, padded[: m.end()].count(" "), r))
    hidden = lambda h: any(o[0] <= h[0] and h[1] <= o[1] and (o[2].rank < h[2].rank or o[2].rank == h[2].rank and o[:2] != h[:2]) for o in hits)
    left = [h[2] for h in hits if not hidden(h)]
    return {r.label for r in left}, max((licenses.CONFIDENCE[r.rank] for r in left), default=0.0)


def test_licenses(docs, texts, no_docs):
    rows = by_id(licenses.scan(docs).collect(), texts)
    assert len(rows) == len(texts) + 2
    lower = str.maketrans(licenses.UPPER, licenses.LOWER)
    for r, t in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(lower))
        hits = sorted((i, x) for p, x in licenses.BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
        assert r["n_words"] == len(words) and r["n_base"] == len(hits), t[:60]
        assert r["first_word"] == (hits[0][0] if hits else None) and r["last_word"] == (hits[-1][0] if hits else None)
        more, score = license_labels(t)
        assert r["base_labels"] == sorted({x for _, x in hits}) and r["labels"] == sorted(more | {x for _, x in hits})
        assert r["score"] == max(score, 0.5 if hits else 0.0)
    labels = {t[:30]: r["labels"] for r, t in rows}
    first = labels["Licensed under the Apache Lice"]
    assert {"apache-2.0", "mit", "cc-by-nc-4.0", "apache", "cc-by"} == set(first)
    assert "gpl-3.0" in labels["This work is licensed under th"]
    assert labels["submit licenses; permit licens"] == ["cc-by", "mit"]
    assert licenses.scan(no_docs).count() == 0


def test_licenses_around_line_separators(spark):
    """U+0085, U+2028 and U+2029 are parts of words: they end no word and no search."""
    rows = [(k, f"apache license a{c} b mit license", f"see the apache license{c}") for k, c in enumerate("\x85\u2028\u2029")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tail string")
    for r in licenses.scan(df).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (6, 2, 0, 4)
    for r in licenses.scan(df, text_col="tail").collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["labels"]) == (4, 0, None, None, [])


def test_license_rules_are_many_and_have_their_keywords():
    rules = licenses.rules()
    assert len({r.pattern for r in rules}) == len(rules) > 250 and {r.rank for r in rules} == set(range(licenses.RANKS))
    for r in rules:
        assert r.keyword in re.split("[^a-z0-9]+", r.pattern) and " " in re.sub(r"\(\?:[^()]*\)\?", "", r.pattern), r
    assert len({r.keyword for r in rules}) == len(licenses.keywords())


#: Texts as people write them, with the labels that a reader gives them.
LABELLED = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining\n# a copy of this software and associated\n# documentation files", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "bsd"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software", "bsd-3-clause"),
    ("This is under the 2-Clause BSD License.", "bsd-2-clause"),
    ("Simplified BSD License", "bsd-2-clause"),
    ("New BSD License, see COPYING", "bsd-3-clause"),
    ("The BSD 3-Clause License", "bsd-3-clause"),
    ("BSD-style license", "bsd"),
    ("Copyright (c) 2010 The Authors. All rights reserved.", ""),
    ("Ich gehe mit dem Hund; er kommt mit. Mit 10 Jahren.", ""),
    ("mit freundlichen Grüßen, License to drive", ""),
    ("Ruby is a red stone. Python is a snake. zlib and libpng were updated", ""),
    ("The apache helicopter needs no license", ""),
    ("he had a license to fish in the public domain of the king's forest", ""),
    ("released into the public domain", "public-domain"),
    ("http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"),
    ("Apache 2.0 licence", "apache-2.0"),
    ("https://opensource.org/licenses/MIT", "mit"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0", "gpl-2.0"),
    ("under the terms of the GNU Lesser General Public License version 2.1", "lgpl-2.1"),
    ("GNU Affero General Public License v3.0", "agpl-3.0"),
    ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 3 of the License", "gpl,gpl-3.0"),
    ("licensed under the GPLv3", "gpl-3.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    ("Eclipse Public License 2.0", "epl-2.0"),
    ("Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("https://creativecommons.org/licenses/by-nc-nd/4.0/", "cc-by-nc-nd-4.0"),
    ("CC BY-SA 3.0", "cc-by,cc-by-sa-3.0"),
    ("cc by hand to the whole team, cc by default", "cc-by"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("Distributed under the Boost Software License, Version 1.0.", "boost-1.0"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "isc"),
    ("the ISC license and the zlib license", "isc,zlib"),
    ("This Font Software is licensed under the SIL Open Font License, Version 1.1.", "ofl-1.1"),
    ("available under the MIT No Attribution license", "mit-0"),
    ("Unauthorized copying of this file, via any medium is strictly prohibited", "proprietary"),
    ("the server side of the public house; business source of income", ""),
    # Hits that overlap: rank and containment decide, not which begins first.
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal with the Software without restriction", "ncsa"),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0)", "apache-2.0,mit"),
    ("SPDX-License-Identifier: Apache-2.0 AND (BSD-3-Clause OR MIT)", "apache-2.0,bsd-3-clause,mit"),
    ("License: MIT", "mit"),
    ("license = \"MIT\"", "mit"),
    ("\"license\": \"Apache-2.0\",", "apache-2.0"),
    ("Bring the license mit nach Hause; Lizenz mit Foto", ""),
]


def test_license_labels_of_written_texts(spark):
    rows = [(k, t) for k, (t, _) in enumerate(LABELLED)]
    got = {r["doc_id"]: set(r["labels"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = [set(filter(None, x.split(","))) for _, x in LABELLED]
    hit = sum(len(got[k] & w) for k, w in enumerate(want))
    wrong = {LABELLED[k][0]: got[k] for k, w in enumerate(want) if got[k] != w}
    assert hit / sum(map(len, got.values())) > 0.95 and hit / sum(map(len, want)) > 0.95, wrong


def test_overlapping_rules(spark):
    the, gpl = "GNU General Public License Version 3, 29 June 2007", "Licensed under GPL version 3"
    got = [r for r in licenses.scan(spark.createDataFrame(list(enumerate([the, f"The {the}", gpl])), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got[0]["score"] == got[1]["score"] == 0.95 and "gpl-3.0" in got[2]["labels"] and got[2]["score"] > 0.7


def test_suppression_hides_contained_hits(spark):
    from pyspark.sql import functions as F

    hits = [(0, -9, 1, 0.9, "a"), (2, -5, 3, 0.5, "b"), (2, -5, 1, 0.5, "c"), (8, -12, 3, 0.5, "d"), (20, -22, 3, 0.5, "e"), (20, -22, 3, 0.5, "f")]
    df = spark.createDataFrame([(hits,)], "h array<struct<start:long,less:long,rank:int,conf:double,label:string>>")
    got = df.select(licenses._surviving(F.col("h")).alias("s")).first()["s"]
    assert sorted(got["labels"]) == ["a", "d", "e", "f"] and got["conf"] == 0.9
