"""Hard-negative mining: exact integer scores by Strassen multiplication, and mergeable heaps.

Anchors are dealt to blocks and candidates to chunks of bounded size; a cell holds one block and one chunk.
Inside a cell the scores are products of int64 tiles (anchors by components by candidates), multiplied by
Strassen's recursion with zero padding, and each anchor keeps heaps:

1. positives: the first rows of the anchor's label; only candidates of that label are multiplied,
2. windows: for each of its positives, the first rows of other labels whose score lies within the window.

Heaps of cells merge, since the first k of a union are among the first k of its parts: within a task as sorted
runs, across cells by a rank-one-to-k window that prunes each task before its shuffle. Rows, not pairs, are
exchanged: every candidate once for each block of ``BLOCK`` anchors, every anchor once for each chunk.
Nothing is broadcast or collected but two counts; no cell depends on how many rows share a label or a vector.

Scores are exact. Strassen's sums may wrap around 64 bits on the way, which arithmetic modulo 2**64 undoes;
tiles whose products could leave 64 bits are multiplied as Python integers, and such scores are cut to the range of
bigint before they are compared.

Defined results: rows with a null id, label or vector, or a null or non-finite component, take no part;
shorter vectors count as padded with zeros; equal rows count once; rows that share an id but differ are
different candidates, and none is a partner of an anchor with that id; equal scores are ordered by id (then by
label and content of the row); other columns are ignored; an empty table, or one without anchors, gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from tripmill.llm.shared import partitions, ship_code, stage

#: Most anchors in a block, candidates in a chunk and in a tile; where Strassen's recursion ends.
BLOCK, CHUNK, TILE, LEAF = 2048, 65_536, 2048, 32
_TOP, _LOW = (1 << 63) - 1, -(1 << 63)


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b``: seven products of quarters for eight, zero-padded to even sides, down to ``LEAF``."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    r, s, t = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b12, b21, b22 = b[:s, :t], b[:s, t:], b[s:, :t], b[s:, t:]
    m1 = strassen(a11 + a22, b11 + b22)
    m2 = strassen(a21 + a22, b11)
    m3 = strassen(a11, b12 - b22)
    m4 = strassen(a22, b21 - b11)
    m5 = strassen(a11 + a12, b22)
    m6 = strassen(a21 - a11, b11 + b12)
    m7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * r, 2 * t), dtype=a.dtype)
    out[:r, :t] = m1 + m4 - m5 + m7
    out[:r, t:] = m3 + m5
    out[r:, :t] = m2 + m4
    out[r:, t:] = m1 - m2 + m3 + m6
    return out[:m, :n]


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices of whole doubles, as int64."""
    width = max(a.shape[1], b.shape[1], 1)
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * width < 2.0**62:
        return strassen(a.astype(np.int64), np.ascontiguousarray(b.astype(np.int64).T))
    whole = np.vectorize(int, otypes=[object])
    return np.clip(strassen(whole(a), whole(b).T), _LOW, _TOP).astype(np.int64)


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Components times 256, rounded down; short vectors are padded with zeros."""
    column = vectors.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(256 * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(lengths), lengths.max(initial=0)))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def window_of(positive: int, low_percent: int, high_percent: int) -> tuple[int, int]:
    """The least and the greatest score n with ``low * p <= 100 * n <= high * p``."""
    return -(-low_percent * positive // 100), high_percent * positive // 100


def _first(keys: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest, in order; equal ones by position."""
    if len(keys) > 8 * k:  # everything above the k-th value, and what ties with it
        bar = np.partition(keys, len(keys) - k)[len(keys) - k]
        near = np.flatnonzero(keys >= bar)
    else:
        near = np.arange(len(keys))
    return near[np.argsort(-keys[near], kind="stable")][:k]


def _dealt(anchors: DataFrame, rows: DataFrame, anchor_blocks: int, chunks: int, own: list[str]) -> DataFrame:
    """Anchors and candidates in cells: both with ``cell``, the columns ``own`` null for candidates."""
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(anchor_blocks))
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), "vec_id", "label", "vector"), F.lit(chunks))
    kept = ["vec_id", "label", "vector", "tie"]
    one = anchors.withColumn("block", block).select(*kept, *own, "block", each(chunks).alias("chunk"))
    two = rows.withColumn("chunk", chunk).select(
        *kept, *(F.lit(None).cast(anchors.schema[name].dataType).alias(name) for name in own),
        each(anchor_blocks).alias("block"), "chunk",
    )
    return one.withColumn("is_anchor", F.lit(True)).unionByName(two.withColumn("is_anchor", F.lit(False)))


def _sides(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """A cell's anchors, and its candidates by id and tie-break."""
    anchors = table.filter(table["is_anchor"])
    rest = table.filter(pa.compute.invert(table["is_anchor"]))
    return anchors, rest.sort_by([("vec_id", "ascending"), ("tie", "ascending")])


def _rows(parts: list[tuple], names: dict[str, pa.DataType]) -> pa.Table:
    columns = list(zip(*parts)) if parts else [[] for _ in names]
    return pa.table([pa.array(column, kind) for column, kind in zip(columns, names.values())], list(names))


def _merged(parts: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The heaps of all cells merged: the first k of each key, ranked."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other_id", "other_tie")
    return parts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low_percent: int = 80,
    high_percent: int = 100,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` is a condition on the column ``vec_id``. ``rank`` counts the negatives of a pair from 1.
    """
    spark = rows.sparkSession
    ship_code(spark)
    read = rows.select(rows[vec_id].alias("vec_id"), rows[label].alias("label"), rows[vector].alias("vector"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    usable = (
        read.filter("vec_id is not null and label is not null and vector is not null")
        .filter(~F.exists("vector", odd))
        .dropDuplicates(["vec_id", "label", "vector"])
        .withColumn("tie", F.xxhash64("label", "vector"))
    )
    usable = stage(usable, "vectors")
    n_rows, n_anchors = usable.agg(F.count("*"), F.count_if(is_anchor)).first()
    blocks = max(1, -(-n_anchors // BLOCK))
    # Chunks of a tile or more, as many as give every core some; their number has no effect on the result.
    chunks = max(1, -(-n_rows // CHUNK), min(-(-n_rows // TILE), partitions(spark) * 2 // blocks))
    id_type = usable.schema["vec_id"].dataType.simpleString()
    id_arrow = to_arrow_type(usable.schema["vec_id"].dataType)
    anchors = usable.filter(is_anchor)

    heap = {"anchor_id": id_arrow, "anchor_tie": pa.int64(), "other_id": id_arrow, "other_tie": pa.int64(), "score": pa.int64()}

    def nearest(table: pa.Table) -> pa.Table:
        """A cell's first rows of each anchor's label."""
        queries, others = _sides(table)
        q_ids, q_ties, q_labels = (queries[x].to_numpy() for x in ("vec_id", "tie", "label"))
        o_ids, o_ties, o_labels = (others[x].to_numpy() for x in ("vec_id", "tie", "label"))
        q, o, out = _matrix(queries["vector"]), _matrix(others["vector"]), []
        for value in np.unique(q_labels):
            mine, theirs = np.flatnonzero(q_labels == value), np.flatnonzero(o_labels == value)
            held: list[list] = [[] for _ in mine]
            for at in range(0, len(theirs), TILE):
                tile = theirs[at : at + TILE]
                found = scores(q[mine], o[tile])
                for n, row in enumerate(mine):
                    use = np.flatnonzero(o_ids[tile] != q_ids[row])
                    held[n] += [(-int(found[n, x]), at + int(x)) for x in use[_first(found[n, use], positives)]]
                    held[n] = sorted(held[n])[:positives]
            for n, row in enumerate(mine):
                out += [(q_ids[row], q_ties[row], o_ids[theirs[x]], o_ties[theirs[x]], -s) for s, x in held[n]]
        return _rows(out, heap)

    cells = _dealt(anchors, usable, blocks, chunks, [])
    first = cells.groupBy("block", "chunk").applyInArrow(
        nearest, f"anchor_id {id_type}, anchor_tie bigint, other_id {id_type}, other_tie bigint, score bigint"
    )
    found = _merged(first, ["anchor_id", "anchor_tie"], positives)
    chosen = stage(
        found.groupBy("anchor_id", "anchor_tie").agg(
            F.sort_array(F.collect_list(F.struct("rank", F.col("other_id").alias("id"), "score"))).alias("positives")
        ),
        "positives",
    )
    armed = stage(
        anchors.join(chosen, (F.col("vec_id") == F.col("anchor_id")) & (F.col("tie") == F.col("anchor_tie")))
        .select("vec_id", "label", "vector", "tie", F.col("positives.score").alias("levels")),
        "anchors",
    )

    windows = {"anchor_id": id_arrow, "anchor_tie": pa.int64(), "place": pa.int32(), "other_id": id_arrow,
               "other_tie": pa.int64(), "score": pa.int64()}

    def hardest(table: pa.Table) -> pa.Table:
        """A cell's first rows of other labels in the window of each positive."""
        queries, others = _sides(table)
        q_ids, q_ties, q_labels = (queries[x].to_numpy() for x in ("vec_id", "tie", "label"))
        o_ids, o_ties, o_labels = (others[x].to_numpy() for x in ("vec_id", "tie", "label"))
        levels = queries["levels"].to_pylist()
        q, o, out = _matrix(queries["vector"]), _matrix(others["vector"]), []
        for value in np.unique(q_labels):
            mine, theirs = np.flatnonzero(q_labels == value), np.flatnonzero(o_labels != value)
            held: dict[tuple[int, int], list] = {}
            for at in range(0, len(theirs), TILE):
                tile = theirs[at : at + TILE]
                found = scores(q[mine], o[tile])
                for n, row in enumerate(mine):
                    ranges = [window_of(level, low_percent, high_percent) for level in levels[row]]
                    floor, top = min(r[0] for r in ranges), max(r[1] for r in ranges)
                    use = np.flatnonzero((found[n] >= floor) & (found[n] <= top) & (o_ids[tile] != q_ids[row]))
                    falling = use[np.argsort(-found[n, use], kind="stable")]
                    depths = -found[n, falling]
                    for place, (low, high) in enumerate(ranges):
                        start = np.searchsorted(depths, -high)
                        end = min(start + negatives, np.searchsorted(depths, -low, side="right"))
                        if start < end:
                            own = held.get((n, place), []) + [(-int(found[n, x]), at + int(x)) for x in falling[start:end]]
                            held[n, place] = sorted(own)[:negatives]
            for (n, place), best in held.items():
                row = mine[n]
                out += [(q_ids[row], q_ties[row], place, o_ids[theirs[x]], o_ties[theirs[x]], -s) for s, x in best]
        return _rows(out, windows)

    cells = _dealt(armed, usable, blocks, chunks, ["levels"])
    parts = cells.groupBy("block", "chunk").applyInArrow(
        hardest,
        f"anchor_id {id_type}, anchor_tie bigint, place int, other_id {id_type}, other_tie bigint, score bigint",
    )
    last = _merged(parts, ["anchor_id", "anchor_tie", "place"], negatives)
    partner = F.element_at("positives", F.col("place") + 1)
    return last.join(chosen, ["anchor_id", "anchor_tie"]).select(
        "anchor_id",
        partner["id"].alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("other_id").alias("negative_id"),
        partner["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
