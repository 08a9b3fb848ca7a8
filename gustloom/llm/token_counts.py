"""Token counts by rank-synchronous merging of batched pre-tokens."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustloom.llm.bpe_arrays import Vocabulary
from gustloom.llm.common import Lately, arrow_type, map_arrow, rows_of

#: Pre-tokens whose counts a worker keeps.
CACHE = 600_000


class Counter:
    """Counts tokens of texts; keeps the counts of pre-tokens it has met lately."""

    def __init__(self, path: str, cache: int = CACHE):
        self.vocabulary, self.known = Vocabulary(path), Lately(cache)

    def count(self, texts: list[str]) -> list[int]:
        """Special strings inside a text are special tokens, one each."""
        which, distinct, sizes = self.vocabulary.split(texts)
        ends = np.concatenate([[0], np.cumsum(np.array(self.known.of(distinct, self._learn), np.int64)[which])]) if len(which) else np.zeros(1, np.int64)
        return np.diff(ends[np.concatenate([[0], np.cumsum(sizes)])]).tolist()

    def _learn(self, new: list[str]) -> list[int]:
        plain = [x for x in new if x not in self.vocabulary.special]
        counts = dict(zip(plain, self.vocabulary.encode_pieces(plain)[1].tolist())) if plain else {}
        return [counts.get(x, 1) for x in new]


_counters: dict[str, Counter] = {}


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    ``path`` is a byte-level BPE file of the tokenizers library that every worker can open. A null text counts as
    empty and has no tokens. Null and repeated ids pass through, each row by itself. Long texts are counted whole; a
    worker holds one batch's pre-tokens at a time. Other columns are not read. An empty table gives no rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = Counter(path)
        for ids, texts in rows_of(batches, "id", "text"):
            counts = _counters[path].count(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts])],
                ["id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = arrow_type(rows, "id")
    return map_arrow(rows, run, f"id {dict(rows.dtypes)['id']}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)
