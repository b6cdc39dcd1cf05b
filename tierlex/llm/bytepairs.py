"""Identifiers of byte-level byte-pair vocabularies, for many texts at a time.

Texts are cut into chunks by array operations over a batch's bytes, equal chunks are found by hashes and
compared byte by byte, and only chunks that weren't seen before are merged.  Texts with characters whose
kind the arrays don't know are encoded one by one.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa

from .textarrays import U64, flat, powers

#: Fixed value: how byte-level vocabularies cut a text into chunks.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANK, LETTER, DIGIT, OTHER = range(4)
KIND = np.full(256, OTHER, np.uint8)
KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = BLANK
KIND[0x30:0x3A] = DIGIT
KIND[0x41:0x5B] = KIND[0x61:0x7B] = KIND[0x80:] = LETTER
#: Lead bytes of U+00C0 to U+024F, which are letters but for the signs of multiplication and division.
LEADS, SIGNS = (0xC3, 0xC9), (0x97, 0xB7)
#: Chunks that a task remembers; when it is full, the memory starts anew.
MEMORY = 1_000_000


def load(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks (which are the identifiers) and special strings of a byte-level vocabulary file of the tokenizers library."""
    with open(path, encoding="utf-8") as f:
        kept = json.load(f)
    model, cut = kept["model"], kept["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not kept["normalizer"] and not model.get("ignore_merges")
    if not plain:
        raise ValueError("not a plain byte-level vocabulary")
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes written as themselves; the others follow from 256 on
    hidden = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"]: t["id"] for t in kept["added_tokens"]}
    ranks = {bytes(byte[c] for c in piece): i for piece, i in model["vocab"].items() if piece not in special}
    made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if made != sorted(made):
        raise ValueError("the vocabulary's identifiers don't follow its merges")
    return ranks, special


def chunk_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places where chunks of PATTERN begin in texts whose kinds of characters KIND knows; data ends with a text."""
    kind = KIND[data]
    n = len(data)
    start = np.ones(n + 1, bool)
    start[1:n] = kind[1:] != kind[:-1]
    ends = np.zeros(n + 1, bool)
    ends[at] = True
    start |= ends
    # the last blank before a word is the word's if it is a space, else a chunk of its own
    last = np.flatnonzero((kind[:-1] == BLANK) & (kind[1:] != BLANK) & ~ends[1:n])
    start[last] = True
    start[last[data[last] == 0x20] + 1] = False
    # an apostrophe that begins a chunk takes s, t, m, d, re, ve or ll with it
    quote = np.flatnonzero((data[:-1] == 0x27) & start[: n - 1] & ~ends[1:n])
    if len(quote):
        one = data[quote + 1]
        two = np.where((quote + 2 < n) & ~ends[np.minimum(quote + 2, n)], data[np.minimum(quote + 2, n - 1)], 0)
        short = np.isin(one, list(b"stmd"))
        long = np.isin(one, list(b"rv")) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)
        start[quote[short | long] + 1] = False
        start[quote[short] + 2] = True
        start[quote[long] + 3] = True
    return np.flatnonzero(start[:n])


class Encoder:
    """Identifiers of whole texts; special strings in a text become their identifiers."""

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int]):
        import tiktoken

        self.plain = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = [s.encode() for s in special]
        self.known: dict[bytes, int] = {}
        self.ids, self.begin = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64)  # of chunk i: ids[begin[i]:begin[i + 1]]

    def one(self, text: str) -> np.ndarray:
        return np.array(self.plain.encode(text, allowed_special="all"), np.uint32)

    def _learn(self, chunk: bytes) -> int:
        i, ids = len(self.known), self.plain.encode_ordinary(chunk.decode())
        a = int(self.begin[i])
        while a + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        if i + 2 > len(self.begin):
            self.begin = np.append(self.begin, np.zeros_like(self.begin))
        self.ids[a : a + len(ids)] = ids
        self.begin[i + 1] = a + len(ids)
        self.known[chunk] = i
        return i

    def _odd(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Texts that hold a character of unknown kind or a special string."""
        odd = (data >= 0xC0) & ((data < LEADS[0]) | (data > LEADS[1]))
        odd[:-1] |= (data[:-1] == LEADS[0]) & np.isin(data[1:], SIGNS)
        places = np.flatnonzero(odd).tolist()
        raw = data.tobytes()
        for s in self.special:
            p = raw.find(s)
            while p >= 0:
                places.append(p)
                p = raw.find(s, p + 1)
        out = np.zeros(len(at) - 1, bool)
        out[np.searchsorted(at, places, side="right") - 1] = True
        return out

    def many(self, column: pa.Array) -> list[np.ndarray]:
        """Identifiers of each text of an Arrow column, null being empty."""
        data, at = flat(column)
        n_texts = len(at) - 1
        data = data[at[0] : at[-1]]
        at = at - at[0]
        if len(data) < 2:
            return [self.one(t or "") for t in column.to_pylist()]
        odd = self._odd(data, at)
        if len(self.known) > MEMORY:
            self.known.clear()
        first = chunk_starts(data, at)
        size = np.diff(np.append(first, len(data)))
        up, down = powers(len(data) + 1)
        sums = np.append(U64(0), np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], dtype=U64))
        hashes = (sums[first + size] - sums[first]) * down[first]
        _, where, of = np.unique(hashes, return_index=True, return_inverse=True)
        twin = first[where][of]  # of each chunk the place of the one that stands for its hash
        same = (size == size[where][of]).all()
        place = np.arange(len(data))
        same = same and bool((data[np.repeat(twin - first, size) + place] == data).all())
        raw = data.tobytes()
        chunk_odd = odd[np.searchsorted(at, first, side="right") - 1]
        used = np.zeros(len(where), bool)
        used[of[~chunk_odd]] = True
        numbers = np.zeros(len(where), np.int64)
        if same:
            for u in np.flatnonzero(used).tolist():
                chunk = raw[(a := first[where[u]]) : a + size[where[u]]]
                i = self.known.get(chunk)
                numbers[u] = self._learn(chunk) if i is None else i
        else:  # two chunks with one hash
            odd[:] = True
        number = numbers[of]
        count = np.where(chunk_odd, 0, self.begin[number + 1] - self.begin[number])
        upto = np.append(0, np.cumsum(count))
        ids = self.ids[np.repeat(self.begin[number] - upto[:-1], count) + np.arange(upto[-1])]
        text_at = upto[np.searchsorted(first, at)]
        return [self.one(column[i].as_py()) if odd[i] else ids[text_at[i] : text_at[i + 1]] for i in range(n_texts)]
