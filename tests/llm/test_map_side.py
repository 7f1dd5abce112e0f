"""Line dedup, decontamination, quality rules, token counts and sharding against plain Python."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from tests.llm.conftest import rows_of
from tripmill.llm.decontaminate import decontamination_report, remove_documents, remove_spans
from tripmill.llm.line_dedup import line_dedup
from tripmill.llm.quality_rules import quality_rules
from tripmill.llm.sharding import shard, write_shards
from tripmill.llm.token_counts import token_counts

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def expect(rows):
    return sorted(rows, key=repr)


def lined(frame):
    return rows_of(line_dedup(frame).withColumn("sha", F.sha2("text", 256)), "doc_id", "n_lines", "n_dropped", "sha")


def test_line_dedup(edges, edge_docs, small_docs):
    assert lined(edge_docs) == expect(brute.op1(edges))
    assert lined(small_docs[1]) == expect(brute.op1(small_docs[0]))


def test_line_dedup_carries_other_columns(edge_docs):
    out = line_dedup(edge_docs).select("doc_id", "rest.*")
    assert rows_of(out, "doc_id", "kept", "n_lines") == rows_of(edge_docs, "doc_id", "kept", "n_lines")


def test_line_dedup_counts_ids_and_not_rows(spark):
    line = "a line that is long enough to count"
    rows = [(7, line), (7, line), (None, line + "\nother")]
    out = lined(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert [r[:3] for r in out] == [(7, 1, 0), (7, 1, 0), (None, 2, 0)]
    rows = [(7, line), (7, line), (9, line)]
    assert [r[:3] for r in lined(spark.createDataFrame(rows, "doc_id bigint, text string"))] == [(7, 1, 0), (7, 1, 0), (9, 1, 0)]
    rows = [(7, line), (7, line), (9, line), (None, line)]
    out = lined(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert [r[:3] for r in out] == [(7, 1, 1), (7, 1, 1), (9, 1, 0), (None, 1, 1)]


def hits(frame, items):
    out = decontamination_report(frame, items)
    return rows_of(
        out.select("*", F.size("items").alias("n"), F.sha2(F.array_join("items", ","), 256).alias("sha")),
        "doc_id", "n_words", "n_hit", "n", "sha", "contaminated",
    )


def test_decontamination(spark, edges, edge_docs, small_docs):
    items = [(1, "it runs FAR away from the old mill by the river now"), (2, None), (3, ""), (4, "one two"), (5, "ÉTUDE"),
             (None, "w5x5 w6x6 w7x7 w8x8 w9x9 w10x10 w11x11 w12x12 w13x13 w14x14 w15x15"), (4, "one two")]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    assert hits(edge_docs, table) == expect(brute.op6(edges, items))
    frame = spark.read.parquet(small_docs[1].inputFiles()[0].replace("documents", "benchmark"))
    whole = [(r.item_id, r.text) for r in frame.collect()]
    assert hits(small_docs[1], frame) == expect(brute.op6(small_docs[0], whole))
    assert sum(r[-1] for r in hits(small_docs[1], frame)) > 0


def test_decontamination_without_broadcast(spark, edges, edge_docs, monkeypatch):
    items = [(1, "it runs far away from the old mill by the river now"), (4, "one two")]
    monkeypatch.setattr("tripmill.llm.decontaminate.MAX_BROADCAST", 0)
    table = spark.createDataFrame(items, "item_id bigint, text string")
    assert hits(edge_docs, table) == expect(brute.op6(edges, items))


def test_removal_of_documents_and_spans(spark):
    docs = spark.createDataFrame([(1, "-- Keep this; one  TWO, three!"), (2, "clean"), (3, None)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "one two")], "item_id bigint, text string")
    assert rows_of(remove_documents(docs, items), "doc_id", "text") == [(2, "clean"), (3, None)]
    assert rows_of(remove_spans(docs, items), "doc_id", "text") == [(1, "-- Keep this; three!"), (2, "clean"), (3, None)]


BASE = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality_base(edges, edge_docs, small_docs):
    assert rows_of(quality_rules(edge_docs), *BASE) == expect(brute.op7_base(edges))
    assert rows_of(quality_rules(small_docs[1]), *BASE) == expect(brute.op7_base(small_docs[0]))


def test_quality_verdict(spark):
    prose = "The quick brown fox jumps over the lazy dog and then it runs far away from the old mill by the river."
    menu = "\n".join(["Home", "Menu", "a | b | c | d", "Click here to read more about our other fine products today."])
    rows = [(1, prose), (2, f"Home\n{prose}\nSkip to content"), (3, f"{menu}\n{menu.upper()}\nNews\n{prose[:60]}"),
            (4, " ".join(f"w{n}!!" for n in range(40))), (5, " ".join(f"w{n} ###" for n in range(40)))]
    out = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [out[i].kept for i in range(1, 6)] == [True, True, False, False, False]
    assert not any(out[i].base_failed for i in (1, 2, 4, 5))
    assert out[2].text == prose and out[2].n_lines_removed == 2


def test_quality_removes_read_more_and_long_short_lines(spark):
    prose = "The quick brown fox jumps over the lazy dog and then it runs far away from the old mill by the river."
    link = "https://example.org/" + "section/" * 10
    gone = ["Read more...", "Read more »", "Read more at our site today.", link, f"News {link} x{'y' * 70} more", "Home" + " " * 70,
            "one two three four" + " " * 70]
    stay = ["They read moreover a book today.", f"see the page {link} now then", f"See {link}.", " " * 80, "one two three four five"]
    rows = [(n, f"{prose}\n{line}\n{prose} Again.") for n, line in enumerate(gone + stay)]
    out = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [out[n].n_lines_removed for n, _ in rows] == [1] * len(gone) + [0] * len(stay)
    assert all(out[n].text == f"{prose}\n{prose} Again." for n in range(len(gone)))


def test_quality_agrees_with_labels(spark, small_docs):
    labels = spark.read.parquet(small_docs[1].inputFiles()[0].replace("documents", "labels"))
    out = quality_rules(small_docs[1]).filter("n_words >= 20")
    out = out.join(labels, "doc_id").filter("quality = 0 or not base_failed").groupBy("quality", "kept").count().collect()
    counts = {(r.quality, r.kept): r["count"] for r in out}
    good, bad = counts.get((1, True), 0), counts.get((0, False), 0)
    assert good >= 0.98 * (good + counts.get((1, False), 0))
    assert bad >= 0.95 * (bad + counts.get((0, True), 0))


def test_token_counts(edges, edge_docs, small_docs):
    library = Tokenizer.from_file(BYTE_BPE)
    for rows, frame in ((edges, edge_docs), small_docs):
        texts = [t or "" for _, t in rows]
        counts = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
        want = [(i, len(t.encode()), n, n > 1024) for (i, _), t, n in zip(rows, texts, counts)]
        assert rows_of(token_counts(frame, BYTE_BPE), "doc_id", "n_bytes", "n_tokens", "over_limit") == expect(want)


def laws(rows, out, shards=16):
    assert expect([(r.doc_id, r["size"], r.text_crc32) for r in out]) == expect(brute.op10_sizes(rows))
    slots, sizes = {}, [0] * shards
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
        sizes[r.shard] += r["size"]
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max((r["size"] for r in out), default=0)
    assert max(sizes) - min(sizes) <= 2 * largest
    return sizes


def test_shards(edges, edge_docs, small_docs):
    laws(edges, shard(edge_docs).collect())
    sizes = laws(small_docs[0], shard(small_docs[1]).collect())
    assert max(sizes) < 1.5 * min(sizes)


def test_shards_split_a_hot_text(spark):
    rows = [(n, "the same text everywhere" if n % 3 else f"text {n}") for n in range(6000)]
    out = shard(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    sizes = laws(rows, out)
    assert max(sizes) - min(sizes) < 100
    hot = {r.shard for r in out if r["size"] == 25}
    assert 9 <= len(hot) <= 14  # neighbours, not spread over all shards


def test_written_shards(small_docs, spark, tmp_path):
    write_shards(small_docs[1], str(tmp_path / "shards"), shards=4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == len(small_docs[0]) and back.select("shard").distinct().count() == 4


@pytest.mark.parametrize("run", [line_dedup, quality_rules, shard, lambda d: token_counts(d, BYTE_BPE)])
def test_empty_table(run, empty_docs):
    assert run(empty_docs).collect() == []


def test_empty_tables_of_benchmark(spark, empty_docs, edge_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination_report(empty_docs, none).collect() == []
    assert not any(r.contaminated for r in decontamination_report(edge_docs, none).collect())


def test_decontamination_without_broadcast(spark, edges, edge_docs, small_docs, monkeypatch):
    """A benchmark beyond the bound is joined by a shuffle: same rows, and no text or words in it."""
    from tripmill.llm import decontaminate

    frame = spark.read.parquet(small_docs[1].inputFiles()[0].replace("documents", "benchmark"))
    items = [(1, "it runs FAR away from the old mill by the river now"), (4, "one two"), (5, "ÉTUDE"),
             (None, "w5x5 w6x6 w7x7 w8x8 w9x9 w10x10 w11x11 w12x12 w13x13 w14x14 w15x15")]
    short = spark.createDataFrame(items, "item_id bigint, text string")
    want = hits(small_docs[1], frame)
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST", 0)
    assert hits(small_docs[1], frame) == want
    assert hits(edge_docs, short) == expect(brute.op6(edges, items))
    # What is exchanged by hash:
    probes = decontaminate.probes(decontaminate.read_words(small_docs[1], "doc_id", "text"), [5])
    assert probes.columns == ["doc_id", "text_hash", "block", "n", "hash"]
