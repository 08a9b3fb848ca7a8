"""Byte-level BPE by dynamic programming over prefixes.

For each byte prefix of a pre-token the table holds the one token that the prefix's encoding ends with: the
token whose bytes end the prefix and which may follow the last token of what comes before it. Appends extend
the table; an edit keeps what lies before it and stops where the table has caught up with the old one.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustloom.llm.bpe_arrays import BYTE_LEVEL, Splitter, ragged, split_texts
from gustloom.llm.common import Lately, arrow_type, map_arrow, rows_of

#: Pre-tokens, and token pairs, that a worker keeps.
CACHE, PAIRS = 600_000, 2_000_000


class PrefixBPE:
    """A vocabulary of byte strings by rank; lower ranks merge first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str | None = None):
        self.ranks = ranks
        self.pattern = Splitter(pattern or BYTE_LEVEL)
        self.longest = max(map(len, ranks))
        # Tokens by their bytes from the last to the first: a walk back from a position meets all that end there.
        self.ends: dict = {}
        for b, r in ranks.items():
            node = self.ends
            for x in reversed(b):
                node = node.setdefault(x, {})
            node[-1] = r
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.parts: dict[int, tuple[int, int] | None] = {}  # the last merge that makes a token; None for a single byte
        self.single: set[int] = set()  # tokens that are their bytes' own encoding
        for b, r in ranks.items():
            self.parts[r] = self._last_merge(b)
            if self.parts[r] or len(b) == 1:
                self.single.add(r)
        self.pairs: dict[tuple[int, int], bool] = {}

    @classmethod
    def from_file(cls, path: str) -> PrefixBPE:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})

    def _last_merge(self, data: bytes) -> tuple[int, int] | None:
        """The two parts that merges of lower rank leave of a token's bytes."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 2:
            found = [(r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None]
            if not found:
                return None
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None

    def may_follow(self, a: int, b: int) -> bool:
        """Whether the bytes of a and b together encode as [a, b]."""
        if (known := self.pairs.get((a, b))) is not None:
            return known
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        self.pairs[a, b] = out = self._border_holds(a, b)
        return out

    def _border_holds(self, a: int, b: int) -> bool:
        """Undo the merges beside the border, latest first; no merge across it may come before the one undone."""
        before = len(self.ranks) + 1  # a merge across the border with a rank below this would have come first
        bytes_of, parts = self.bytes_of, self.parts
        while True:
            across = self.ranks.get(bytes_of[a] + bytes_of[b])
            if across is not None and across < before:
                return False
            pa_, pb = parts[a], parts[b]
            if pa_ is None and pb is None:
                return True
            if pb is None or pa_ is not None and a > b:
                before, a = a, pa_[1]  # of equal ranks the left one merges first: the one in a
            else:
                before, b = b + 1, pb[0]  # the one across the border is left of the one in b

    def extend(self, data: bytes, last: list[int], start: int, old: list[int] | None = None, shift: int = 0) -> None:
        """Fill last[i], the last token of data[:i], for i > start. With the table before an edit, stop once it agrees over the longest token."""
        ends, pairs, agreed = self.ends, self.pairs, 0
        for i in range(start + 1, len(data) + 1):
            node, j, found = ends, i, []
            while j:
                node = node.get(data[j - 1])
                if node is None:
                    break
                j -= 1
                if (t := node.get(-1)) is not None:
                    found.append((j, t))
            for j, t in reversed(found):  # the longest first: it's most often the one
                if j == 0:
                    if t in self.single:
                        last.append(t)
                        break
                    continue
                ok = pairs.get((last[j], t))
                if self.may_follow(last[j], t) if ok is None else ok:
                    last.append(t)
                    break
            if old is not None and i - shift > 0 and shift < i:
                agreed = agreed + 1 if i - shift < len(old) and old[i - shift] == last[i] else 0
                if agreed >= self.longest and i - self.longest >= start + max(0, shift):
                    last += old[i - shift + 1 :]
                    return

    def encode_piece(self, data: bytes) -> list[int]:
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        last = [-1]
        self.extend(data, last, 0)
        return self.walk(last)

    def walk(self, last: list[int]) -> list[int]:
        """The encoding of the whole, from its end."""
        out, i = [], len(last) - 1
        while i:
            out.append(last[i])
            i -= len(self.bytes_of[last[i]])
        return out[::-1]

    def encode(self, text: str) -> list[int]:
        return [t for piece in self.pattern.findall(text) for t in self.encode_piece(piece.encode())]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class EditablePiece:
    """The prefix table of one pre-token, for appends and edits."""

    def __init__(self, bpe: PrefixBPE, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        start, self.data = len(self.data), self.data + data
        self.bpe.extend(self.data, self.last, start)

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Put ``data`` in place of bytes start..end."""
        old, shift = self.last, len(data) - (end - start)
        self.data = self.data[:start] + data + self.data[end:]
        self.last = old[: start + 1]
        # Old entries up to the edit's end don't count as agreement: their bytes differ.
        self.bpe.extend(self.data, self.last, start, [-2] * (end + 1) + old[end + 1 :], shift)

    def ids(self) -> list[int]:
        return self.bpe.walk(self.last)


class Codec:
    """Encodes and decodes texts; keeps the pre-tokens that it has met lately."""

    def __init__(self, path: str, cache: int = CACHE):
        self.bpe, self.known = PrefixBPE.from_file(path), Lately(cache)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end (int32), and the number of each text's."""
        which, distinct, sizes = split_texts(texts, self.bpe.pattern.findall)
        return ragged(self.known.of(distinct, self._learn), which, sizes, "<i4")

    def _learn(self, new: list[str]) -> list[bytes]:
        bpe, known = self.bpe, {}
        # In byte order each pre-token's table extends the one before from where they part.
        last, before = [-1], b""
        for data in sorted(x.encode() for x in new):
            if (whole := bpe.ranks.get(data)) is not None:
                ids = [whole]
            else:
                same, most = 0, min(len(data), len(before))
                while same < most and data[same] == before[same]:
                    same += 1
                del last[same + 1 :]
                bpe.extend(data, last, same)
                ids, before = bpe.walk(last), data
            known[data] = array("i", ids).tobytes()
        return [known[x.encode()] for x in new]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes that the ids stand for, of each text."""
        own = np.split(ids, np.cumsum(counts)[:-1])
        return [self.bpe.decode(x.tolist()) for x in own]


_codecs: dict[str, Codec] = {}


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, token_ids (array of int), decoded (binary): the text's encoding and what that decodes to.

    ``path`` is a rank file that every worker can open. No special tokens. A null text counts as empty: no tokens,
    no bytes. Null and repeated ids pass through, each row by itself. Long texts are encoded whole; a worker holds one
    batch's tokens at a time. Other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_name = dict(rows.dtypes)["id"]
    id_type = arrow_type(rows, "id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _codecs:
            _codecs[path] = Codec(path)
        codec = _codecs[path]
        for keys, texts in rows_of(batches, "id", "text"):
            ids, counts = codec.encode(texts)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(keys, id_type), lists, pa.array(codec.decode(ids, counts), pa.binary())], ["id", "token_ids", "decoded"])

    return map_arrow(rows, run, f"id {id_name}, token_ids array<int>, decoded binary").withColumnRenamed("id", id_col)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, n_tokens, ids_sha256 (decimal ids joined by commas) and decoded_sha256 of round_trip()'s rows."""
    ids = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return encoded.select(id_col, F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
