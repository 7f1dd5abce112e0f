"""Sharding by sampled splitters: ranges of a key with nearly equal bytes, cut into shards.

1. Each record gets a narrow entry: id, size, checksum and the order of records: a hash of the text, then
   a hash of the id. Equal texts are neighbours. The entries are written once; texts are read once.
2. Keys are drawn with a chance proportional to size, and quantiles of the draw become range boundaries,
   so the ranges hold nearly equal bytes. A boundary drawn twice is a hot key: it gets a range of its own.
3. Exact bytes of each range follow from an aggregate. Overfull ranges are subdivided by the id's hash, so
   a group of copies, or a bad draw, never lands in one task.
4. Running sums inside the ranges, plus the ranges' offsets, give each record its place in all bytes, and
   equal cuts of that place give the shards: sizes differ by less than one record.

The draw only sets how the work is split; the result depends on the entries alone. What reaches the
driver or is broadcast is one row a range, and ranges follow ``rows_per_range``.

Defined results: a null text has no bytes (size 1, checksum 0); null ids and repeated rows are records
like others (equal entries are interchangeable); other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.shared import stage

#: Rows wanted in a range, draws for a range, and the least number of ranges.
ROWS_PER_RANGE, DRAWS_PER_RANGE, LEAST_RANGES = 1_000_000, 32, 256
#: A range with more than this many times its share is subdivided.
OVERFULL = 1.5


def entries(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32`` and the sort keys ``k1`` (text) and ``k2`` (id) of every record."""
    bytes_of = F.encode(docs[text], "UTF-8")
    return docs.select(
        docs[doc_id].alias("doc_id"),
        (F.coalesce(F.octet_length(docs[text]), F.lit(0)).cast("bigint") + 1).alias("size"),
        F.coalesce(F.crc32(bytes_of), F.lit(0)).alias("text_crc32"),
        F.coalesce(F.xxhash64(docs[text]), F.lit(0)).alias("k1"),
        F.xxhash64(docs[doc_id], F.lit("place")).alias("k2"),
    )


def _boundaries(records: DataFrame, total: int, ranges: int) -> list[int]:
    """Sorted range starts from a size-weighted draw of keys; a hot key starts and ends its own range."""
    chance = F.col("size") * F.lit(float(ranges * DRAWS_PER_RANGE) / total)
    # A draw by a hash of the record is the same in every attempt of a task.
    uniform = F.pmod(F.xxhash64("k1", "k2", F.lit("draw")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    steps = [n / ranges for n in range(1, ranges)]
    drawn = (
        records.filter(uniform < chance)
        .agg(F.percentile_approx("k1", steps, 100 * ranges).alias("cuts"))
        .first()
        .cuts
        or []
    )
    hot = {a for a, b in zip(drawn, drawn[1:]) if a == b}
    return sorted(set(drawn) | {key + 1 for key in hot if key < (1 << 63) - 1})


def _ranges(records: DataFrame, starts: list[int], ranges: int) -> DataFrame:
    """Add ``range``: an equality join on the key's leading bits, then the bounds."""
    spark = records.sparkSession
    shift = 64 - max(1, (2 * ranges).bit_length())
    bounds = list(zip([-(1 << 63), *starts], [*(s - 1 for s in starts), (1 << 63) - 1]))
    table = (
        spark.createDataFrame([(n, lo, hi) for n, (lo, hi) in enumerate(bounds)], "range int, lo bigint, hi bigint")
        .select("*", F.explode(F.sequence(F.shiftright("lo", shift), F.shiftright("hi", shift))).alias("cell"))
    )
    # One row for each range and each of its cells: bounded by the parameters, not by the records.
    return records.withColumn("cell", F.shiftright("k1", shift)).join(F.broadcast(table), "cell").filter(
        (F.col("k1") >= F.col("lo")) & (F.col("k1") <= F.col("hi"))
    ).drop("cell", "lo", "hi")


def shard(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` under the law ``bytes``."""
    records = stage(entries(docs, doc_id, text), "entries")
    total, rows = records.agg(F.coalesce(F.sum("size"), F.lit(1)), F.count("*")).first()
    ranges = max(LEAST_RANGES, -(-rows // ROWS_PER_RANGE))
    ranged = _ranges(records, _boundaries(records, total, ranges), ranges)

    share = total / ranges
    parts = ranged.groupBy("range").agg(F.sum("size").alias("bytes")).select(
        "range",
        F.when(F.col("bytes") > OVERFULL * share, F.ceil(F.col("bytes") / F.lit(share))).otherwise(1).alias("parts"),
    )
    parts = parts.filter("parts > 1")
    # At most as many overfull ranges as there are shares of the bytes: bounded by ``ranges``.
    units = ranged.join(F.broadcast(parts), "range", "left").withColumn(
        "unit",
        F.floor(
            F.pmod(F.shiftright("k2", 24), F.lit(1 << 32)) / F.lit(float(1 << 32)) * F.coalesce("parts", F.lit(1))
        ).cast("int"),
    )
    sums = units.groupBy("range", "unit").agg(F.sum("size").alias("unit_bytes"), F.count("*").alias("unit_rows"))
    before = Window.orderBy("range", "unit").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(  # one row a unit
        "range",
        "unit",
        F.coalesce(F.sum("unit_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("unit_rows").over(before), F.lit(0)).alias("rows_before"),
    )
    inside = Window.partitionBy("range", "unit").orderBy("k1", "k2", "doc_id", "size", "text_crc32")
    place = F.col("bytes_before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = stage(
        units.join(F.broadcast(offsets), ["range", "unit"]).select(
            "doc_id",
            "size",
            "text_crc32",
            F.floor((place * 2 + F.col("size")) * shards / F.lit(2 * total)).cast("int").alias("shard"),
            (F.col("rows_before") + F.row_number().over(inside) - 1).alias("rank"),
        ),
        "placed",
    )
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the records as one folder a shard, each split over several tasks."""
    placed = shard(docs, shards, doc_id, text).select(F.col("doc_id").alias("placed_id"), "shard", "slot")
    docs.join(placed, docs[doc_id].eqNullSafe(placed.placed_id)).drop("placed_id").hint("rebalance", "shard").write.partitionBy(
        "shard"
    ).parquet(path)
