"""Token counts by heap-and-linked-list byte-pair merging; no token ids are produced."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import BoundedCache, map_batches, worker_cache
from tidemark.llm.pieces import PieceTable


def _counter(model_path: str) -> tuple[PieceTable, BoundedCache]:
    pieces = PieceTable(model_path)
    return pieces, BoundedCache(pieces.count)


def token_counts(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """Per row: the id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (n_tokens > limit).

    Map-only: no shuffle and no driver state; a Python worker keeps the counts of parts between its tasks.  Null and
    empty texts have 0 bytes and 0 tokens; a very long text is counted part by part; repeated rows are counted each; an empty table gives an empty result; columns other than the two named are not read.
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, known = worker_cache(("token counts", model_path), lambda: _counter(model_path))
        for batch in batches:
            n_bytes, n_tokens = [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                n_bytes.append(len(text.encode()))
                n_tokens.append(sum(map(known.__getitem__, pieces.parts(pieces.normalise(text)))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    return map_batches(df.select(id_col, text_col), count, f"`{id_col}` {id_type}, n_bytes long, n_tokens long, over_limit boolean")
