"""Byte-pair merges over ragged numpy arrays: every sequence applies its lowest-rank pair at the same time."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex

#: Fixed value: the pattern that splits text before the merges of a byte-level vocabulary.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: the pattern of a vocabulary with word ends; white space is dropped.
WORD_END = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
NONE = np.int32(2**31 - 1)
#: Texts of characters below this one, Latin with its extensions, are split by the standard library's engine.
NEAR = 0x250


class Splitter:
    """Finds all matches of a pattern. Near texts take a form of it with classes spelt out, which splits alike in half the time."""

    def __init__(self, pattern: str):
        self.whole = regex.compile(pattern)
        self.near = re.compile(self._spelt(pattern))
        self.far = re.compile(f"[^\0-{chr(NEAR - 1)}]")

    @staticmethod
    def _spelt(pattern: str) -> str:
        """The pattern with the members below NEAR in place of each class: as they are inside brackets, else in brackets."""
        near = "".join(map(chr, range(NEAR)))

        def members(name: str) -> str:
            runs = regex.findall(f"{name}+", near)
            return "".join(re.escape(r[0]) + (f"-{re.escape(r[-1])}" if len(r) > 1 else "") for r in runs)

        out, inside = [], False
        for part in re.findall(r"\\[pP]\{\w+\}|\\.|[^\\]", pattern):
            if part in "[]":
                inside = part == "["
            if part[:2] in ("\\p", "\\P", "\\s", "\\S"):
                part = members(part) if inside else f"[{members(part)}]"
            out.append(part)
        return "".join(out)

    def findall(self, text: str) -> list[str]:
        return (self.whole if self.far.search(text) else self.near).findall(text)


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(rest)) for b in range(256)]


def split_texts(texts: list[str], cut: Callable[[str], list[str]]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """What ``cut`` makes of the texts, end to end, as places in a list of distinct strings, and how many each text gives."""
    found: list[str] = []
    ends = np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        found += cut(text)
        ends[i + 1] = len(found)
    coded = pa.array(found, pa.string()).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist(), np.diff(ends)


def ragged(values: list[bytes], which: np.ndarray, sizes: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit ids of ``values[which]`` end to end, and how many fall to each text, whose numbers of values are ``sizes``."""
    data = np.frombuffer(b"".join(values), kind)
    lengths = np.fromiter(map(len, values), np.int64, len(values)) // 4
    each = lengths[which]
    ends = np.concatenate([[0], np.cumsum(each)])
    ids = data[np.repeat((np.cumsum(lengths) - lengths)[which] - ends[:-1], each) + np.arange(ends[-1])]
    return ids, np.diff(ends[np.concatenate([[0], np.cumsum(sizes)])])


class ArrayMerges:
    """Merges by rank. ``encode`` takes the symbols of many sequences end to end and returns what survives."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.merged = merged.astype(np.int64)
        keys = left.astype(np.int64) << 20 | right
        self.bits = max(12, int(len(keys) * 8).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        todo = np.arange(len(keys), dtype=np.int64)
        slots = self._slot(keys)
        while len(todo):  # open addressing: of the keys that want a free slot, one gets it
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[todo[free]]
            placed = self.keys[slots] == keys[todo]
            self.ranks[slots[placed]] = todo[placed]
            todo, slots = todo[~placed], slots[~placed] + 1 & (1 << self.bits) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Each pair's rank, NONE where no merge has it."""
        keys = left << 20 | right
        slots = self._slot(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.ranks[slots], NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            slots[open_] = slots[open_] + 1 & (1 << self.bits) - 1
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out

    def encode(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all sequences end to end, and how many each has. No sequence may be empty."""
        t, n, who = symbols.astype(np.int64), lengths.astype(np.int64), np.arange(len(lengths))
        counts, done = np.zeros(len(lengths), np.int64), []
        ranks = np.full(len(t), NONE, np.int32)
        inner = np.ones(len(t), bool)
        inner[np.cumsum(n) - 1] = False
        at = np.flatnonzero(inner)
        ranks[at] = self.rank(t[at], t[at + 1])
        while len(n):
            starts = np.cumsum(n) - n
            least = np.minimum.reduceat(ranks, starts)
            ended = least == NONE
            if ended.any():
                counts[who[ended]] = n[ended]
                symbol_ended = np.repeat(ended, n)
                done.append((who[ended], n[ended], t[symbol_ended]))
                live = ~ended
                t, ranks, inner = t[~symbol_ended], ranks[~symbol_ended], inner[~symbol_ended]
                n, who, least = n[live], who[live], least[live]
                if not len(n):
                    break
            hit = np.flatnonzero(ranks == np.repeat(least, n))
            # Of pairs that overlap (a symbol repeated), the first, third, ... merge.
            run = np.cumsum(np.diff(hit, prepend=-2) != 1) - 1
            first = hit[np.searchsorted(run, np.arange(run[-1] + 1))]
            hit = hit[(hit - first[run]) % 2 == 0]
            t[hit] = self.merged[ranks[hit]]
            inner[hit] = inner[hit + 1]
            keep = np.ones(len(t), bool)
            keep[hit + 1] = False
            n -= np.bincount(np.searchsorted(np.cumsum(n), hit, side="right"), minlength=len(n))
            new = hit - np.arange(len(hit))  # where the merged symbols stand once the others are gone
            t, ranks, inner = t[keep], ranks[keep], inner[keep]
            ranks[new] = NONE
            own = new[inner[new]]
            before = new[new > 0] - 1
            marked = np.zeros(len(t), bool)
            marked[own] = marked[before[inner[before]]] = True
            touched = np.flatnonzero(marked)
            if len(touched):
                ranks[touched] = self.rank(t[touched], t[touched + 1])
        if not done:
            return np.zeros(0, np.int64), counts
        # Back in the order of the input.
        order = np.concatenate([d[0] for d in done])
        size = np.concatenate([d[1] for d in done])
        ids = np.concatenate([d[2] for d in done])
        target = (np.cumsum(counts) - counts)[order]
        out = np.empty(len(ids), np.int64)
        out[np.repeat(target - (np.cumsum(size) - size), size) + np.arange(len(ids))] = ids
        return out, counts


class Vocabulary:
    """A BPE vocabulary file of the tokenizers library, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs]) for i in (0, 1))
        self.merges = ArrayMerges(left, right, np.array([vocab[a + b] for a, b in pairs]))
        names = byte_characters()
        self.inner = np.array([vocab[c] for c in names])
        self.last = np.array([vocab[c + self.suffix] for c in names])
        self.split_special = regex.compile("|".join(f"({regex.escape(s)})" for s in self.special)) if self.special else None
        self.pattern = Splitter(WORD_END if self.suffix else BYTE_LEVEL)

    def split(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
        """The texts' pre-tokens and special strings end to end, as places in a list of distinct ones, and the number of each text's."""
        return split_texts(texts, lambda t: [x for part in self.split_at_special(t) for x in ([part] if part in self.special else self.pieces(part))] if self.has_special(t) else self.pieces(t))

    def has_special(self, text: str) -> bool:
        return any(map(text.__contains__, self.special))

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens, end to end, and the number of each."""
        raw = [p.encode() for p in pieces]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        if self.suffix:
            ends = np.cumsum(lengths) - 1
            symbols[ends] = self.last[data[ends]]
        return self.merges.encode(symbols, lengths)

    def split_at_special(self, text: str) -> list[str]:
        """The text's stretches between special strings, and those."""
        return [x for x in self.split_special.split(text) if x]

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a stretch of text without special strings."""
        if self.suffix:
            # Case folds character by character, so a final sigma is an ordinary one.
            text = text.lower() if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return self.pattern.findall(text)
