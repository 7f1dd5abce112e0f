"""Repeated strings against plain Python; the index against naive search."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import rows_of
from tripmill.llm import run_index_dedup as R


def run(frame):
    out = R.dedup_strings(frame).withColumn("sha", F.sha2("kept", 256))
    return rows_of(out, "doc_id", "n_bytes", "n_removed", "n_spans", "sha")


def test_edges_and_table(edges, edge_docs, small_docs):
    assert run(edge_docs) == sorted(brute.op4(edges), key=repr)
    want = sorted(brute.op4(small_docs[0]), key=repr)
    assert run(small_docs[1]) == want and any(r[2] for r in want)


def pieces(seed, n=120):
    """Texts that share passages of 40 to 120 bytes at all alignments, with runs and non-ASCII bytes."""
    random.seed(seed)
    letters = "ab cdéf" if seed % 2 else "ab"
    pool = ["".join(random.choices(letters, k=random.randint(40, 120))) for _ in range(12)] + ["z" * 70]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(random.randint(1, 4)):
            p = random.choice(pool)
            cut = random.randint(0, 8)
            parts.append(p[cut : len(p) - random.randint(0, 8)])
            parts.append("".join(random.choices("uvwxy", k=random.randint(0, 30))))
        rows.append((random.randint(0, 10**6), "".join(parts)))
    return list(dict(rows).items())


@pytest.mark.parametrize("seed", range(3))
def test_shared_passages(spark, seed):
    rows = pieces(seed)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert run(frame) == sorted(brute.op4(rows), key=repr)


def test_null_and_repeated_ids(spark):
    text = "a passage that is certainly longer than fifty bytes in all, and more"
    rows = [(3, text), (3, text), (None, text), (9, text)]
    out = run(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert [(r[0], r[2]) for r in out] == [(3, 0), (3, 0), (9, len(text)), (None, 0)]


def test_long_texts_are_cut_in_chunks(monkeypatch):
    monkeypatch.setattr(R, "CHUNK", 300)
    random.seed(5)
    text = "".join(random.choices("abc", k=2000)).encode()
    whole, _ = R.anchors(np.frombuffer(text, dtype=np.uint8), np.array([len(text)]))
    _, places, _ = R.batch_anchors([text, b"", b"x" * 10])
    assert set(places) == set(whole)
    for start in range(len(text) - R.WIDTH + 1):  # every string holds an anchor
        assert any(start <= p <= start + R.SLIDE for p in whole)


def padded(texts):
    lengths = np.array([len(t) for t in texts])
    contents = np.zeros((len(texts), R.SNIPPET), dtype=np.uint8)
    for n, t in enumerate(texts):
        contents[n, : len(t)] = np.frombuffer(t, dtype=np.uint8)
    return contents, lengths


def snippets(letters, seed, n=40):
    """Contents of 50 to 76 bytes, some that share most of another, one long run and some bytes of value 0 and 255."""
    random.seed(seed)
    texts = ["".join(random.choices(letters, k=random.randint(50, 76))).encode("latin-1") for _ in range(n)]
    texts += [(b"q" * (k % 9) + texts[k][: 50 + k % 9] + b"r" * 17)[:76] for k in range(n)] + [b"a" * 76, b"a" * 60, b"\xff\x00" * 30]
    random.shuffle(texts)
    return texts


@pytest.mark.parametrize("letters", ["ab", "abcdefgh ", "a"])
def test_index_steps_and_matching_statistics(letters):
    texts = snippets(letters, 6)
    held, streamed = texts[:40], texts[40:]
    index, order, _, ends = R.build_index(*padded(held))
    text = b"\x01".join(held)  # what no pattern holds parts the contents here
    where = {p: row for row, p in enumerate(order)}
    for row, position in enumerate(order):
        assert index.step(np.array([row]))[0] == where[(position - 1) % len(order)]
    assert len(index.run_starts) < len(order)
    for run, (first, n) in enumerate(zip(index.run_starts, index.run_lengths)):
        assert index.first_samples[run] == order[first] and index.last_samples[run] == order[first + n - 1]
    contents, lengths = padded(streamed)
    for active, read, matched, places in R.matching_statistics(index, contents, lengths):
        for n, length, place in zip(active, matched, places):
            rest = streamed[n][len(streamed[n]) - read :]
            assert rest[:length] in text and (length == len(rest) or rest[: length + 1] not in text)
            assert text[place : place + length] == rest[:length]


def test_samples_at_run_ends_decide(monkeypatch):
    """Streamed marks come from the sampled positions: with wrong samples they change."""
    texts = snippets("ab", 8)
    held, streamed = padded(texts[:40]), padded(texts[40:])
    index = R.build_index(*held)[0]
    right = R.held_strings(index, *streamed)
    assert right.any()
    index.first_samples[1:] = index.first_samples[0]
    index.last_samples[1:] = index.first_samples[0]
    assert (R.held_strings(index, *streamed) != right).any()


@pytest.mark.parametrize("letters, ids", [("ab", 1000), ("a", 1000), ("abc", 7), ("ab", 1)])
def test_marks(letters, ids):
    texts = snippets(letters, 9)
    contents, lengths = padded(texts)
    docs = np.array([random.randrange(ids) for _ in texts])
    bits = R.repeated_strings(contents, lengths, docs)
    for n, t in enumerate(texts):
        for start in range(len(t) - R.WIDTH + 1):
            want = any(t[start : start + R.WIDTH] in u and docs[m] < docs[n] for m, u in enumerate(texts))
            assert bool(bits[n] >> start & 1) == want


def around(gram, sides, seed):
    """Snippets of texts that hold ``gram``, some at their start, as padded contents with the anchor's hash."""
    random.seed(seed)
    texts = [left[len(left) - random.choice([R.SLIDE, R.SLIDE, 15, 3]) :] + gram + right for left, right in sides]
    contents, lengths = padded(texts)
    return texts, contents, lengths, np.repeat(R._row_hashes(np.frombuffer(gram, dtype=np.uint8)[None]), len(texts))


@pytest.mark.parametrize("letters, gram", [("ab", b"a" * R.GRAM), ("abc", b"abcbacbacabcacbbcabcaabc"), ("a", b"a" * R.GRAM)])
def test_only_what_may_repeat_is_indexed(monkeypatch, letters, gram):
    """Contents around one anchor: with their sides the same strings are found through smaller indexes."""
    random.seed(5)
    draw = lambda n: "".join(random.choices(letters, k=n)).encode()
    sides = [(draw(R.SLIDE), draw(R.SLIDE)) for _ in range(60)]
    sides += [(draw(R.SLIDE - k) + left[R.SLIDE - k :], right[: R.SLIDE - k] + draw(k)) for left, right in sides[:20] for k in (0, 5, 13, 20)]
    texts, contents, lengths, hashes = around(gram, sides, 5)
    docs = np.array([random.randrange(1000) for _ in texts])
    indexed, build = [], R.build_index
    monkeypatch.setattr(R, "build_index", lambda c, n: indexed.append(len(c)) or build(c, n))
    bits = R.repeated_strings(contents, lengths, docs, R.anchor_sides(contents, lengths, hashes))
    narrow, indexed[:] = sum(indexed), []
    every = R.repeated_strings(contents, lengths, docs)
    assert narrow <= sum(indexed) and (letters != "abc" or narrow < sum(indexed))
    at = np.array([t.rindex(gram, 0, R.SLIDE + R.GRAM) for t in texts])
    for n, t in enumerate(texts):
        for start in range(len(t) - R.WIDTH + 1):
            string, place = t[start : start + R.WIDTH], start - at[n]
            aligned = any(docs[m] < docs[n] and 0 <= at[m] + place and u[at[m] + place :].startswith(string) for m, u in enumerate(texts))
            assert every[n] >> start & 1 >= bits[n] >> start & 1 >= aligned


def test_a_match_that_ends_too_early_is_given_up():
    texts = snippets("abcdefgh ", 6)
    index = R.build_index(*padded(texts[:40]))[0]
    streamed = padded(texts[40:])
    steps = [sum(len(active) for active, *_ in R.matching_statistics(index, *streamed, reach)) for reach in (0, R.WIDTH)]
    assert steps[1] < 0.8 * steps[0]
    bits = np.zeros(len(streamed[1]), dtype=np.int64)
    for active, read, matched, _ in R.matching_statistics(index, *streamed):
        hit = active[matched >= R.WIDTH]
        bits[hit] |= np.int64(1) << (streamed[1][hit] - read)
    assert bits.any() and (bits == R.held_strings(index, *streamed)).all()


@pytest.mark.parametrize("kind", ["string", "int", "decimal(20,0)"])
def test_ids_keep_their_type(spark, kind):
    rows = [(i, t) for i, t in pieces(4, 60)] + [(None, "n" * 60)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame = frame.withColumn("doc_id", F.col("doc_id").cast(kind)).repartition(5)
    assert R.dedup_strings(frame).schema["doc_id"].dataType == frame.schema["doc_id"].dataType
    named = sorted(((str(i), t) for i, t in rows if i is not None)) if kind == "string" else sorted(rows[:-1])
    number = {i: n for n, (i, _) in enumerate(named)}
    want = sorted(brute.op4([(n, t) for n, (_, t) in enumerate(named)]))
    out = [r for r in run(frame) if r[0] is not None]
    assert sorted((number[r[0] if kind == "string" else int(r[0])], *r[1:]) for r in out) == want


def test_empty(empty_docs):
    assert R.dedup_strings(empty_docs).collect() == []


def test_different_texts_under_one_id_do_not_crash(spark):
    rows = [(1, "p" * 30 + "a passage that is certainly longer than fifty bytes in all"), (2, "short"),
            (2, "a passage that is certainly longer than fifty bytes in all, and more")]
    out = run(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert [r[:2] for r in out] == [(1, 88), (2, 5), (2, 68)] and out[0][2] == 0 and out[1][2] == 0


def test_texts_are_exchanged_once(spark, small_docs):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as large marks are
    try:
        frame = R.dedup_strings(small_docs[1])
        frame.collect()
        assert "ReusedExchange" in frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_frequent_anchors_leave_the_buckets(spark, monkeypatch):
    """A short line in changing surroundings, and a passage's edges: one content a document, no common bucket."""
    random.seed(7)
    noise = lambda n: "".join(random.choices("uvwxyz ", k=n))
    line, passage = "Licensed for anyone to read, 2024", "a passage that is certainly longer than fifty bytes in all, é and more"
    rows = [(n, f"{noise(60)}{line}{noise(60)}{passage if n % 2 else passage[5:]}{noise(40 + n % 9)}") for n in range(300)]
    rows += [(1000 + n, rows[n][1][20:150]) for n in range(40)] + [(2000, "q" * 60), (2001, "q" * 55)]
    random.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    monkeypatch.setattr(R, "FREQUENT", 50)
    monkeypatch.setattr(R, "SAMPLE", 1)
    seen, most = [], []
    find, pack = R._frequent_anchors, R._packed_snippets

    def packed(*given):
        out = pack(*given)
        most.extend(len(h) // 8 for h, n in ((r.hashes, r.bucket) for r in out.collect()) if n >= 0)
        return out

    monkeypatch.setattr(R, "_frequent_anchors", lambda placed: seen.append(find(placed)) or seen[-1])
    monkeypatch.setattr(R, "_packed_snippets", packed)
    assert run(frame) == sorted(brute.op4(rows), key=repr)
    assert len(seen[0]) >= 2 and max(most) < 50


def test_map_tasks_hold_a_part_of_a_batch(monkeypatch):
    monkeypatch.setattr(R, "PART_BYTES", 100)
    texts = ["a" * 60, None, "b" * 30, "", "c" * 250, "d" * 10, "é" * 20]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], ["doc_id", "text"])
    parts = [part.column(1).to_pylist() for part in R._parts(iter([batch, batch.slice(0, 0)]))]
    assert sum(parts, []) == texts and [len(p) for p in parts] == [4, 3]
