"""Whole texts to the tokenizers library's ids, each spelling encoded once per worker.

A unit is a run of white space with what follows it. The byte-level pre-tokenizer
never joins text across the start of such a run, so ids of units in order are
the ids of the text. Texts with white space outside ASCII take the library as they are.

New units of a byte-level file whose merges are numbered in order go through tiktoken,
which works on the same ranks and is several times faster; other files take the
library for them too. Tests hold both against the library.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import public_tokenizers
import tiktoken

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

UNIT = re.compile(r"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")
ODD_SPACE = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200b\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]")
CACHE_UNITS = 300_000
JOINED = 500

_loaded: dict[str, UnitEncoder] = {}


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves, the others for the characters from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _ranked(path: str, special: dict[str, int]):
    """The file as a tiktoken encoding, or None if its rules are others than ranks express."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    level = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not spec.get("normalizer")
    if not (plain and level and special and len(special) == len(spec["added_tokens"])):
        return None
    if any(model["vocab"].get(a + b) != 256 + k for k, (a, b) in enumerate(pairs)):
        return None
    byte = _byte_of()
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    if sorted(ranks.values()) != list(range(256 + len(pairs))):
        return None
    return tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


class UnitEncoder:
    """Ids of texts as little-endian 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # an added token splits a text: what stands on its sides is encoded as if alone
        marks = [(t.content, i) for i, t in self.tok.get_added_tokens_decoder().items() if not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.mark = marks[0] if marks else None
        self.ranked = _ranked(path, dict(marks))

    @classmethod
    def at(cls, path: str) -> UnitEncoder:
        if path not in _loaded:
            _loaded[path] = cls(path)
        return _loaded[path]

    def _batch(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _units(self, units: list[str]) -> list[bytes]:
        """Ids of each unit; many are encoded as one text with the added token between them."""
        if not self.mark:
            return self._batch(units)
        mark, mark_id = self.mark
        lone = [u for u in units if mark in u]
        own = dict(zip(lone, self._batch(lone)))
        plain = [u for u in units if u not in own] if lone else units
        rows = []
        joined = [mark.join(plain[k : k + JOINED]) for k in range(0, len(plain), JOINED)]
        if self.ranked:
            found = (self.ranked.encode(t, allowed_special="all") for t in joined)
        else:
            found = (e.ids for e in self.tok.encode_batch_fast(joined, add_special_tokens=False))
        for ids in found:
            ids = np.array(ids, "<u4")
            at = np.flatnonzero(ids == mark_id)
            raw = ids.tobytes()
            cut = [0, *(4 * at + 4).tolist(), len(raw) + 4]
            rows += [raw[a : b - 4] for a, b in zip(cut, cut[1:])]
        if not lone:
            return rows
        own.update(zip(plain, rows))
        return [own[u] for u in units]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) > CACHE_UNITS:  # what is still met moves over from the older half
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        units = [None if t is None or ODD_SPACE.search(t) else UNIT.findall(t) for t in texts]
        new = []
        for u in {u for row in units if row for u in row if u not in known}:
            if u in older:
                known[u] = older[u]
            else:
                new.append(u)
        for lo in range(0, len(new), 20_000):
            part = new[lo : lo + 20_000]
            known.update(zip(part, self._units(part)))
        odd = [t for t, row in zip(texts, units) if row is None and t]
        whole = iter(self._batch(odd))
        get = known.__getitem__
        return [b"".join(map(get, row)) if row is not None else (next(whole) if t else b"") for t, row in zip(texts, units)]
