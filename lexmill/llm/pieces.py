"""Token ids and token counts of whole texts through units that a byte-level BPE never joins.

With the public splitting pattern, a text is certainly cut before white space that follows another character, after a
single white-space byte other than a space, and between an ASCII letter or digit and ASCII punctuation. What lies between two
such cuts is a *unit* (mostly a word with the space before it); its ids do not depend on its surroundings. Units
are found, hashed and looked up for a slice of texts at once with array operations; only a unit not met before is
tokenized. Texts that hold a special string or white space outside ASCII go to the library whole, as do all texts
when the tokenizer is of another kind.

Where the ids of the file follow the order of its merges, they are also ranks, and a rank-based library gives the same
ids as the tokenizers library several times faster; special strings always go to the latter.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

from lexmill.llm.texts import range_hashes, raw_bytes

# Fixed value: the public pattern that byte-level BPE splits text with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The characters outside ASCII that count as white space.
WIDE_SPACES = tuple(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Units remembered in a worker, about 150 bytes each; all are forgotten beyond it.
MEMO_UNITS = 1_000_000

_SPACE, _ALNUM, _PUNCT = 1, 2, 3
_CLASS = np.zeros(256, np.uint8)
_CLASS[:128] = _PUNCT
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = _ALNUM


class Splitter:
    """What a tokenizer file says, and the library's ids for any text."""

    def __init__(self, path: str):
        # Spark's tasks are the parallelism; threads of the library would compete with them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.by_unit = has_public_splits(spec)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.whole = [s.encode() for s in (*self.special, *WIDE_SPACES)]
        ranks = merge_ranks(spec) if self.by_unit else None
        self.ranked = ranks and tiktoken.Encoding("units", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.ranked and not any(s in text for s in self.special):
            return self.ranked.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids


def has_public_splits(spec: dict) -> bool:
    """Whether the file describes a byte-level BPE with the public pattern and nothing that looks past a unit."""
    before = spec.get("pre_tokenizer") or {}
    return (
        before.get("type") == "ByteLevel"
        and before.get("use_regex") is True
        and before.get("add_prefix_space") is False
        and spec.get("normalizer") is None
        and (spec.get("model") or {}).get("type") == "BPE"
        and not (spec["model"].get("dropout") or 0)
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens") or [])
    )


def merge_ranks(spec: dict) -> dict[bytes, int] | None:
    """Bytes of each token with its id, if a lower id always means an earlier merge; else none."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte_of = {chr(b): b for b in shown}
    byte_of.update({chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))})
    vocab, added = spec["model"]["vocab"], {t["content"] for t in spec.get("added_tokens") or []}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    made = [vocab["".join(m)] for m in merges]
    single = [t for t in vocab if len(t) == 1]
    if made != sorted(made) or len(single) != 256 or len(made) + 256 != len(vocab.keys() - added):
        return None
    return {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in added}


class Units:
    """The units of a column of texts: byte borders, hash and row of each; ``whole`` marks rows left uncut."""

    def __init__(self, column: pa.Array, splitter: Splitter):
        self.data, self.offsets = raw_bytes(column)
        low, high = self.offsets[:-1], self.offsets[1:]
        self.whole = np.zeros(len(low), bool)
        if not splitter.by_unit:
            self.whole[:] = True
        else:
            plain = self.data.tobytes()
            for mark in splitter.whole:
                if mark in plain:
                    for i in np.flatnonzero(~self.whole):
                        self.whole[i] = mark in plain[low[i] : high[i]]
        kind = _CLASS[self.data]
        cut = np.zeros(len(kind), bool)
        if len(kind) > 1:
            space = kind == _SPACE
            before, here = kind[:-1], kind[1:]
            cut[1:] = space[1:] & ~space[:-1]
            cut[1:] |= (before == _ALNUM) & (here == _PUNCT)
            # After a lone white-space byte that is not a space.
            lone = (space & (self.data != 0x20))[:-1] & ~space[1:]
            lone[1:] &= ~space[:-2]
            cut[1:] |= lone
        full = high > low
        cut[low[full]] = True
        for i in np.flatnonzero(self.whole & full):
            cut[low[i] + 1 : high[i]] = False
        self.start = np.flatnonzero(cut)
        self.end = np.append(self.start[1:], len(kind)) if len(self.start) else self.start
        self.row = np.searchsorted(low, self.start, side="right") - 1
        self.hashes = range_hashes(self.data, self.start, self.end)
        self.hashes[self.hashes == 0] = 1

    def text(self, i: int) -> str:
        return self.data[self.start[i] : self.end[i]].tobytes().decode("utf-8", "replace")


class HashTable:
    """Numbers 64-bit keys (not 0) in the order they come, with array operations only."""

    def __init__(self, size: int = 1 << 16):
        self.keys, self.values, self.n = np.zeros(size, np.uint64), np.zeros(size, np.int32), 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each key, -1 if it is not there."""
        mask = np.uint64(len(self.keys) - 1)
        slot = (h & mask).astype(np.int64)
        got = self.keys[slot]
        out = np.where(got == h, self.values[slot], -1)
        left = np.flatnonzero((got != h) & (got != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & int(mask)
            got = self.keys[slot[left]]
            hit = got == h[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (got != 0)]
        return out

    def add(self, new: np.ndarray) -> None:
        """Distinct keys that are not there yet."""
        if 2 * (self.n + len(new)) > len(self.keys):
            kept = self.keys[self.keys != 0]
            order = np.argsort(self.values[self.keys != 0])
            size = len(self.keys)
            while size < 4 * (self.n + len(new)):
                size *= 2
            self.keys, self.values, self.n = np.zeros(size, np.uint64), np.zeros(size, np.int32), 0
            self.add(kept[order])
        mask = len(self.keys) - 1
        number = np.arange(self.n, self.n + len(new), dtype=np.int32)
        slot = (new & np.uint64(mask)).astype(np.int64)
        left = np.arange(len(new))
        while len(left):
            at = slot[left]
            free = self.keys[at] == 0
            self.keys[at[free]] = new[left[free]]  # of several for a slot, the last one stays
            won = self.keys[at] == new[left]
            self.values[at[won]] = number[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & mask
        self.n += len(new)


class IdMemo:
    """Ids of texts, a slice at a time."""

    def __init__(self, splitter: Splitter, limit: int = MEMO_UNITS):
        self.splitter, self.limit = splitter, limit
        self._forget()

    def _forget(self) -> None:
        self.table = HashTable()
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start, self.length, self.used = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows in one array, and the offset of each row's ids."""
        units = Units(column, self.splitter)
        number = self._numbers(units)
        lengths = self.length[number]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.start[number] - (ends - lengths), lengths) + np.arange(total)]
        offsets = np.zeros(len(units.whole) + 1, np.int64)
        np.cumsum(np.bincount(units.row, lengths, minlength=len(units.whole)).astype(np.int64), out=offsets[1:])
        return ids, offsets

    def _numbers(self, units: Units) -> np.ndarray:
        number = self.table.find(units.hashes)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new, first = np.unique(units.hashes[missing], return_index=True)
            if self.table.n + len(new) > self.limit:
                self._forget()
                new, first = np.unique(units.hashes, return_index=True)
                missing = np.arange(len(units.hashes))
            self._learn(new, [self.splitter.ids(units.text(i)) for i in missing[first]])
            number[missing] = self.table.find(units.hashes[missing])
        return number

    def _learn(self, keys: np.ndarray, ids: list[list[int]]) -> None:
        n, lengths = self.table.n, np.array([len(x) for x in ids], np.int64)
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(lengths.sum()))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(keys) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.flat[self.used : self.used + len(flat)] = flat
        self.start[n : n + len(keys)] = self.used + np.cumsum(lengths) - lengths
        self.length[n : n + len(keys)] = lengths
        self.used += len(flat)
        self.table.add(keys)
