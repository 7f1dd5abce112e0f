"""Benchmark decontamination: a broadcast hash set of benchmark n-grams against all training windows.

Words are runs of digits, letters and characters beyond ASCII, with A-Z lower-cased. Each item gives its
windows of ``window`` words; an item of fewer words is one window of its own length. Any run of L words in
a document contains one of the blocks of (L + 1) // 2 words that the document is cut into, so a scan hashes
the blocks and probes the broadcast table of the items' n-grams of that size at all offsets; no window can
be missed. Windows around a hit are verified word by word in the same stage. Only verified windows are
shuffled, reduced by document to merged spans and item ids.

The table is broadcast while it has at most ``MAX_BROADCAST`` n-grams, and joined by a shuffle beyond that;
both give the same rows. A scan serves all items with blocks of one size; sizes are at most ``window`` / 2.

Defined results: a null or empty text has no words and no hits; null or empty items give no windows; a
null item id counts as an empty string; repeated items count once; rows that repeat id and text get the
same result each; columns other than the named ones are ignored; empty tables on either side give no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import LOWER, UPPER, ascii_lower, stage

#: Word separators: all ASCII but digits and letters (fixed value; case is handled apart).
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
MAX_BROADCAST = 200_000


def words_of(text: Column) -> Column:
    """The words as written; A-Z are lower-cased where words are compared."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATOR + "+"), "")


def _block_hashes(words: Column, size: int | Column, step: int | Column) -> Column:
    """Hashes of the runs of ``size`` words at every ``step``. Words that agree but for A-Z hash alike."""
    last = F.size(words) - F.lit(size) + 1
    hashed = lambda n: F.xxhash64(F.lower(F.array_join(F.slice(words, n, size), " ")))
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last, F.lit(step)), hashed)).otherwise(
        F.array().cast("array<bigint>")
    )


def benchmark_grams(benchmark: DataFrame, window: int, item_id: str, text: str) -> DataFrame:
    """``hash, at, item_words, length, block, items``: the n-grams of each distinct item at all offsets."""
    items = benchmark.select(
        F.coalesce(benchmark[item_id].cast("string"), F.lit("")).alias("item"),
        words_of(ascii_lower(benchmark[text])).alias("item_words"),
    ).filter(F.size("item_words") > 0)
    sized = (
        items.groupBy("item_words")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .withColumn("length", F.least(F.lit(window), F.size("item_words")))
        .withColumn("block", F.floor((F.col("length") + 1) / 2).cast("int"))
    )
    return sized.select("*", F.posexplode(_block_hashes(F.col("item_words"), F.col("block"), 1)).alias("at", "hash"))


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``doc_id, text_hash, spans, n_hit, items`` of the documents with hits; spans: merged word ranges."""
    grams = stage(benchmark_grams(benchmark, window, item_id, item_text), "grams")
    sizes = grams.groupBy("block").agg(F.count("*").alias("n")).collect()  # at most ``window`` / 2 rows
    read = read_words(docs, doc_id, text)
    if sum(row.n for row in sizes) <= MAX_BROADCAST:
        found = None
        for block in sorted(row.block for row in sizes) or [1]:
            blocks = F.posexplode(_block_hashes(F.col("words"), block, block)).alias("n", "hash")
            hits = scanned_hits(read.select("*", blocks), F.broadcast(grams).filter(F.col("block") == block), block)
            found = hits if found is None else found.unionByName(hits)
    else:
        found = shuffled_hits(read, grams, sorted(row.block for row in sizes))

    def merge(spans: Column, span: Column) -> Column:
        last = F.element_at(spans, -1)
        joined = F.struct(last["at"].alias("at"), F.greatest(last["end"], span["end"]).alias("end"))
        apart = F.concat(spans, F.array(span))
        return F.when((F.size(spans) > 0) & (F.get(spans, F.size(spans) - 1)["end"] >= span["at"]),
                      F.concat(F.slice(spans, 1, F.size(spans) - 1), F.array(joined))).otherwise(apart)

    return (
        found.groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_set("span")).alias("places"), F.collect_set("items").alias("sets"))
        .select(
            "doc_id",
            "text_hash",
            F.aggregate("places", F.array().cast("array<struct<at:int,end:int>>"), merge).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten("sets"))).alias("items"),
        )
        .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["at"]))
    )


def read_words(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("text_hash"), words_of(docs[text]).alias("words")
    )


def probes(read: DataFrame, blocks: list[int]) -> DataFrame:
    """``doc_id, text_hash, block, n, hash`` of the aligned blocks of all sizes: one scan, no words."""

    def placed(size: int) -> Column:
        row = lambda h, n: F.struct(F.lit(size).alias("block"), n.alias("n"), h.alias("hash"))
        return F.transform(_block_hashes(F.col("words"), size, size), row)

    return read.select("doc_id", "text_hash", F.inline(F.concat(*map(placed, blocks))))


def shuffled_hits(read: DataFrame, grams: DataFrame, blocks: list[int]) -> DataFrame:
    """Verified windows where the table is too large to broadcast.

    Only hashes and places of blocks meet the table. What they find, as windows of at most ``length`` words, is
    gathered by document and meets the document's words once.
    """
    first = F.greatest(F.lit(0), F.col("at") + F.col("block") - F.col("length"))
    last = F.least(F.col("at"), F.size("item_words") - F.col("length"))
    windows = (
        probes(read, blocks).join(grams, ["block", "hash"])
        .select("*", F.explode(F.sequence(first, last)).alias("from"))
        .withColumn("start", F.col("n") * F.col("block") - F.col("at") + F.col("from"))
        .filter("start >= 0")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("start", "length", F.slice("item_words", F.col("from") + 1, F.col("length")).alias("gram"), "items")).alias("windows"))
        .withColumnsRenamed({"doc_id": "at_id", "text_hash": "at_hash"})
    )
    here = lambda w: F.transform(
        F.slice("words", w["start"] + 1, w["length"]), lambda x: F.translate(x, UPPER, LOWER)
    )
    same = F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("text_hash") == F.col("at_hash"))
    held = F.filter("windows", lambda w: (w["start"] + w["length"] <= F.size("words")) & (here(w) == w["gram"]))
    return (
        read.join(windows, same).select("doc_id", "text_hash", F.explode(held).alias("w"))
        .select("doc_id", "text_hash", F.struct(F.col("w.start").alias("at"), (F.col("w.start") + F.col("w.length")).alias("end")).alias("span"), F.col("w.items").alias("items"))
    )


def scanned_hits(blocks: DataFrame, table: DataFrame, block: int) -> DataFrame:
    """Verified windows around the blocks whose hash is in the table."""
    # Item windows that contain the n-gram at ``at``, and where they would start in the document.
    first = F.greatest(F.lit(0), F.col("at") + block - F.col("length"))
    last = F.least(F.col("at"), F.size("item_words") - F.col("length"))
    start = F.col("n") * block - F.col("at") + F.col("from")
    place = F.greatest(F.col("start"), F.lit(0)) + 1
    here = F.transform(F.slice("words", place, F.col("length")), lambda w: F.translate(w, UPPER, LOWER))
    return (
        blocks.join(table, "hash")
        .select("*", F.explode(F.sequence(first, last)).alias("from"))
        .withColumn("start", start)
        .filter((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.size("words")))
        .filter(here == F.slice("item_words", F.col("from") + 1, F.col("length")))
        .select("doc_id", "text_hash", F.struct(F.col("start").alias("at"), (F.col("start") + F.col("length")).alias("end")).alias("span"), "items")
    )


def decontamination_report(docs: DataFrame, benchmark: DataFrame, window: int = 10, doc_id: str = "doc_id",
                           text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, items, contaminated`` of every document."""
    hits = find_hits(docs, benchmark, window, doc_id, text, item_id, item_text).select(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "n_hit", "items"
    )
    counted = docs.select(
        docs[doc_id].alias("doc_id"),
        F.xxhash64(docs[text]).alias("text_hash"),
        F.size(words_of(docs[text])).cast("bigint").alias("n_words"),
    )
    same = counted.doc_id.eqNullSafe(hits.hit_id) & (counted.text_hash == hits.hit_hash)
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return counted.join(hits, same, "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (n_hit > 0).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10, doc_id: str = "doc_id",
                     text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents without any hit, with all their columns."""
    hits = find_hits(docs, benchmark, window, doc_id, text, item_id, item_text).select(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")
    )
    same = docs[doc_id].eqNullSafe(hits.hit_id) & (F.xxhash64(docs[text]) == hits.hit_hash)
    return docs.join(hits, same, "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = 10, doc_id: str = "doc_id",
                 text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, text``: every document, without its hit words and what separates them from the next word."""
    hits = find_hits(docs, benchmark, window, doc_id, text, item_id, item_text).select(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "spans"
    )
    read = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("text_hash"))
    joined = read.join(hits, read.doc_id.eqNullSafe(hits.hit_id) & (read.text_hash == hits.hit_hash), "left")
    lead = F.regexp_extract("text", f"^{SEPARATOR}*", 0)
    pieces = F.regexp_extract_all("text", F.lit(f"{WORD}+{SEPARATOR}*"), F.lit(0))
    clear = F.filter(pieces, lambda _, n: ~F.exists("spans", lambda s: (s["at"] <= n) & (n < s["end"])))
    return joined.select(
        "doc_id", F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.concat(lead, F.array_join(clear, ""))).alias("text")
    )
