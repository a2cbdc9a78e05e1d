"""Merges of many words at once for tokenizers with word ends: NumPy over the symbols of all words.

In every round each word merges all places of its pair of lowest rank, which is what merging one pair at
a time comes to, as a merge never makes a pair of lower rank.
"""

from __future__ import annotations

import json
import re

import numpy as np

#: What the tables below can stand for: a lower-casing tokenizer that makes one pre-token of a run of letters.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
#: Words of letters below U+0300 (none of which normalization changes), and what may follow them.
LETTERS = re.compile("([a-zß-öø-ÿ]+)([.,;:!?*#$%&|<>]*)")
_NONE = np.int64(1) << 40


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    extra = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class WordMerger:
    """Merge tables of a tokenizer file; None from ``load`` if the file is of another kind."""

    def __init__(self, vocabulary: dict[str, int], merges: list, end: str):
        symbols = byte_symbols()
        self.inner = np.array([vocabulary[s] for s in symbols], dtype=np.int64)
        self.last = np.array([vocabulary[s + end] for s in symbols], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        keys = np.array([vocabulary[a] << 20 | vocabulary[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order, made

    @classmethod
    def load(cls, path: str) -> WordMerger | None:
        with open(path, encoding="utf-8") as f:
            d = json.load(f)
        model = d["model"]
        kinds = [n["type"] for n in (d.get("normalizer") or {}).get("normalizers", [])]
        steps = [p["type"] for p in (d.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        if model["type"] != "BPE" or kinds != NORMALIZERS or steps != ["Split", "ByteLevel"] or not model.get("end_of_word_suffix") or not plain:
            return None
        if r"[\p{L}]+" not in d["pre_tokenizer"]["pretokenizers"][0]["pattern"].get("Regex", ""):
            return None
        return cls(model["vocab"], model["merges"], model["end_of_word_suffix"])

    def _ranks(self, sym: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The rank of each symbol with the next one of its word; _NONE without a merge."""
        out = np.full(len(sym), _NONE)
        pair = np.flatnonzero(word[1:] == word[:-1])
        key = sym[pair] << 20 | sym[pair + 1]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        out[pair[hit]] = self.rank[at[hit]]
        return out

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and how many each has. Words are not empty."""
        raw = [w.encode() for w in words]
        sizes = np.array([len(w) for w in raw], dtype=np.int64)
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        word = np.repeat(np.arange(len(raw)), sizes)
        sym = self.inner[data]
        ends = np.cumsum(sizes) - 1
        sym[ends] = self.last[data[ends]]
        done_sym, done_word = [], []
        while len(sym):
            rank = self._ranks(sym, word)
            begins = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, begins)
            counts = np.diff(np.append(begins, len(sym)))
            least = np.repeat(least, counts)
            over = least == _NONE
            if over.any():
                done_sym.append(sym[over])
                done_word.append(word[over])
                sym, word, rank, least = sym[~over], word[~over], rank[~over], least[~over]
            hit = rank == least
            # Of neighbouring hits (the same symbol three times or more) every other one counts, from the left.
            at = np.flatnonzero(hit)
            if len(at) > 1 and (at[1:] == at[:-1] + 1).any():
                fresh = np.concatenate([[True], at[1:] != at[:-1] + 1])
                run = np.arange(len(at)) - np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
                at = at[run % 2 == 0]
            sym[at] = self.made[rank[at]]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            sym, word = sym[keep], word[keep]
        if not done_sym:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        return sym[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(raw))
