"""Token counts: a map-side, two-tier lookup of pre-token lengths.

Tier one is a broadcast table of frequent pieces and their token counts, fitted on a bounded sample. Tier
two is each worker's own cache: a piece in neither is merged there once. Texts never leave their task and
pieces are never shuffled, so the cost is one scan. The tables only save work; counts are the library's.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated rows and null ids give a row
each; columns other than the id and the text are ignored, whatever their names; an empty table gives an
empty result. A text is encoded whole, whatever its length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tripmill.llm.pieces import WorkerCache, load
from tripmill.llm.shared import ship_code

#: Sample for the frequent-piece table: texts read from a partition, and entries kept (its size bound).
SAMPLE_TEXTS, TABLE_ENTRIES, TABLE_PIECE_CHARS = 2048, 32_768, 32

_CACHES: dict[tuple[str, int], WorkerCache] = {}


def frequent_lengths(docs: DataFrame, path: str, text: str = "text") -> dict[str, int]:
    """Token counts of frequent pieces, from the first texts of as few partitions as fill the table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, seen, pieces = load(path), 0, Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                pieces.update(tokenizer.pieces(value or "") or ())
            seen += batch.num_rows
            if seen >= SAMPLE_TEXTS:
                break
        top = [p for p, n in pieces.most_common(TABLE_ENTRIES) if n > 1 and len(p) <= TABLE_PIECE_CHARS]
        lengths = [len(tokenizer.piece_ids(p)) for p in top]
        yield pa.RecordBatch.from_arrays([pa.array(top, pa.string()), pa.array(lengths, pa.int32())], ["piece", "n"])

    rows = docs.select(text).mapInArrow(count, "piece string, n int").take(TABLE_ENTRIES)
    return {row.piece: row.n for row in rows}


def token_counts(
    docs: DataFrame, path: str, limit: int = 1024, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every text, for the tokenizer file at ``path``."""
    ship_code(docs.sparkSession)
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, key = load(path), (path, id(frequent.value))
        if key not in _CACHES:
            _CACHES.clear()
            _CACHES[key] = WorkerCache(frequent.value, lambda piece: len(tokenizer.piece_ids(piece)))
        length_of = _CACHES[key].__getitem__
        for batch in batches:
            n_bytes, n_tokens = [], []
            for value in batch.column(1):
                value = value.as_py() or ""
                pieces = tokenizer.pieces(value)
                n_tokens.append(len(tokenizer.text_ids(value)) if pieces is None else sum(map(length_of, pieces)))
                n_bytes.append(len(value.encode()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_bytes, pa.int64()),
                    pa.array(n_tokens, pa.int64()),
                    pa.array([n > limit for n in n_tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    id_type = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text).mapInArrow(
        count, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
