"""Line dedup: lines found in several documents stay in one of them.

Texts are split at line feeds and each line gets a key: white space stripped at both ends, A-Z lower-cased.
The keys of a text are exploded as 128-bit hashes with the positions they stand at, aggregated map-side
and then by hash to a document count and the keeper (the largest id). Hashes over the threshold go back to
the documents by a join, whose hot keys adaptive execution splits, and the texts are reassembled by position.

Shuffles: one small row a line for the counts, one for the join, and each text once to meet its positions.

Defined results: a null or empty text is one empty line; rows with one id are one document when
documents are counted, and all rows that carry the keeper's id keep the line; rows with a null id count as one
document, whose id is smaller than every other id; columns besides id and text ride along in ``rest`` and may have any name; an empty table
gives an empty result. Lines shorter than ``min_chars`` code points always stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import ship_code, stage

_BLANK = b" \t\n\x0b\x0c\r"


def line_keys(text: str, min_chars: int) -> dict[bytes, list[int]]:
    """Hash of each long key of the text → the positions of its lines."""
    positions: dict[bytes, list[int]] = {}
    for position, line in enumerate(text.encode().split(b"\n")):
        key = line.strip(_BLANK).lower()
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
            positions.setdefault(xxhash.xxh3_128_digest(key), []).append(position)
    return positions


def _exploded(docs: DataFrame, min_chars: int) -> DataFrame:
    """A row for each document and distinct long key."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, positions, rows = [], [], []
            for row, value in enumerate(batch.column(2)):
                found = line_keys(value.as_py() or "", min_chars)
                hashes += found.keys()
                positions += found.values()
                rows += [row] * len(found)
            halves = np.frombuffer(b"".join(hashes), dtype="<i8").reshape(-1, 2)
            at = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array(np.ascontiguousarray(halves[:, 0])),
                    pa.array(np.ascontiguousarray(halves[:, 1])),
                    pa.array(positions, pa.list_(pa.int32())),
                ],
                ["doc_id", "text_hash", "h1", "h2", "positions"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text_hash", "text").mapInArrow(
        explode, f"doc_id {id_type}, text_hash bigint, h1 bigint, h2 bigint, positions array<int>"
    )


def line_dedup(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, text`` (what stays), ``n_lines, n_dropped, rest`` (a struct of the other columns)."""
    ship_code(docs.sparkSession)
    others = [docs[name] for name in docs.columns if name not in (doc_id, text)]
    keyed = docs.select(
        docs[doc_id].alias("doc_id"),
        docs[text].alias("text"),
        F.xxhash64(docs[text]).alias("text_hash"),
        F.struct(*others or [F.lit(None).cast("int").alias("none")]).alias("rest"),
    )
    lines = stage(_exploded(keyed, min_chars), "lines")
    # Staged, so that the join below has an exchange of its own on both sides and hot lines can be split.
    repeated = stage(
        lines.groupBy("h1", "h2")
        .agg(
            (F.count_distinct("doc_id") + F.max(F.col("doc_id").isNull().cast("bigint"))).alias("n_docs"),
            F.max("doc_id").alias("keeper"),
        )
        .filter(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "keeper"),
        "repeated",
    )
    dropped = (
        lines.join(repeated, ["h1", "h2"])
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "text_hash")
        .agg(F.array_distinct(F.flatten(F.collect_list("positions"))).alias("dropped"))
        .withColumnsRenamed({"doc_id": "at_id", "text_hash": "at_hash"})
    )
    joined = keyed.join(
        dropped,
        keyed.doc_id.eqNullSafe(dropped.at_id) & keyed.text_hash.eqNullSafe(dropped.at_hash),
        "left",
    ).select("doc_id", "text", "dropped", "rest")

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for value, gone in zip(batch.column(1), batch.column(2)):
                lines_of = (value.as_py() or "").split("\n")
                drop = set(gone.as_py() or ())
                n_lines.append(len(lines_of))
                n_dropped.append(len(drop))
                texts.append("\n".join(x for n, x in enumerate(lines_of) if n not in drop) if drop else value.as_py() or "")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(texts, pa.string()),
                    pa.array(n_lines, pa.int64()),
                    pa.array(n_dropped, pa.int64()),
                    batch.column(3),
                ],
                ["doc_id", "text", "n_lines", "n_dropped", "rest"],
            )

    types = {field.name: field.dataType.simpleString() for field in keyed.schema}
    return joined.mapInArrow(
        reassemble,
        f"doc_id {types['doc_id']}, text string, n_lines bigint, n_dropped bigint, rest {keyed.schema['rest'].dataType.simpleString()}",
    )
