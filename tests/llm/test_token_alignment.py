"""Token alignment against the tokenizers' own output and plain set operations."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.conftest import rows_of
from tripmill.llm.pieces import PLAIN_LIMIT
from tripmill.llm.token_alignment import (
    align_tokens,
    common_ends,
    gallop,
    group_texts,
    possible_pairs,
    vocabularies,
    weigh_links,
)

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Inverse of the public byte alphabet.
BYTE_OF = {chr(b): b for b in PRINTABLE} | {chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(PRINTABLE)))}


def memo(function):
    known = {}

    def run(side):
        if id(side) not in known:
            known[id(side)] = (side, function(side))
        return known[id(side)][1]

    return run


@memo
def ends_at(side):
    out = {}
    for token, end in side:
        out.setdefault(end, []).append(token)
    return out


@pytest.fixture(scope="module")
def brute():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])

    def tokens(text):
        one = a.encode(" " + text, add_special_tokens=False)
        two = b.encode(text)
        one_bytes = [bytes(map(BYTE_OF.__getitem__, t)) for t in one.tokens]
        pieces = [b.id_to_piece(i) for i in two]
        two_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(two, pieces)]
        if not text or b"".join(one_bytes) != (" " + text).encode() or b"".join(two_bytes) != (" " + text).encode():
            return [], []
        ends = lambda parts: accumulate(map(len, parts))
        return list(zip(one.ids, ends(one_bytes))), list(zip(two, ends(two_bytes)))

    def run(docs):
        parts = []
        for i, text in docs:
            x, y = tokens(text or "")
            cuts = sorted({e for _, e in x} & {e for _, e in y})
            links = [(p, q) for e in cuts for p in ends_at(x)[e] for q in ends_at(y)[e]]
            one, two = ([bisect_left(cuts, e) for _, e in side] for side in (x, y))
            members = [([], []) for _ in cuts]
            for side, places, k in ((x, one, 0), (y, two, 1)):
                for (t, _), place in zip(side, places):
                    members[place][k].append(str(t))
            text_of = ";".join(f"{','.join(p)}|{','.join(q)}" for p, q in members)
            parts.append((i, len(x), len(y), len(cuts), links, hashlib.sha256(text_of.encode()).hexdigest() if cuts else ""))
        counts = Counter(link for *_, links, _ in parts for link in links)
        best = {}
        for (_, q), n in counts.items():
            best[q] = max(best.get(q, 0), n)
        return [
            (i, na, nb, ng, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest)
            for i, na, nb, ng, links, digest in parts
        ]

    return run


def run(docs):
    from pyspark.sql import functions as F

    from tripmill.llm.shared import stage

    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    aligned = align_tokens(docs, *PATHS)
    aligned = aligned.select("doc_id", "n_a", "n_b", F.size("links").cast("bigint").alias("n_groups"), digest.alias("groups_sha256"), "links")
    return rows_of(weigh_links(stage(aligned, "links"), 32_000), *COLUMNS)


def test_edges(edges, edge_docs, brute):
    assert run(edge_docs) == sorted(brute(edges), key=repr)


def test_special_strings_and_odd_characters(spark, brute):
    texts = ["<|endoftext|>", "a<|endoftext|> b", "<s>x</s> <unk>", "▁low line", "a\x00b", "ﬁ Ａ　z", "tab\tnew\nline  two   three",
             "👩‍👩‍👧 emoji", "퟿", "<0x41>", " lead", "trail ", "é é", None, "", "e" * 5000, "<|" * 300, "\t \n" * 200, "it's 'RE 's 12 ½", "a\u02ffb\u0300c"]
    docs = list(enumerate(texts)) + [(None, "null id"), (3, "repeated"), (3, "repeated")]
    assert run(spark.createDataFrame(docs, "doc_id bigint, text string")) == sorted(brute(docs), key=repr)


def test_table(small_docs, brute):
    assert run(small_docs[1]) == sorted(brute(small_docs[0]), key=repr)


def test_ids_keep_their_type(spark):
    docs = [(i, "flush this row " * i) for i in range(1, 40)]
    frame = spark.createDataFrame(docs, "doc_id string, text string").coalesce(1)
    parts = align_tokens(frame, *PATHS)
    assert parts.schema["doc_id"].dataType.simpleString() == "string" and parts.count() == 39


def test_small_flush(monkeypatch, spark):
    from tripmill.llm import token_alignment

    monkeypatch.setattr(token_alignment, "FLUSH", 10)
    docs = [(i, "word " * (i % 7)) for i in range(50)]
    out = align_tokens(spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1), *PATHS).collect()
    assert [r.doc_id for r in out] == list(range(50))


def test_gallop_finds_what_bisection_finds():
    random.seed(3)
    for size in (0, 1, 2, 7, 1000, 5000):
        ends = np.cumsum(np.random.default_rng(size).integers(1, 9, size)) if size else np.empty(0, dtype=np.int64)
        targets = np.array(sorted(random.sample(range(30_000), 3000)), dtype=np.int64)
        assert (gallop(ends, targets) == np.searchsorted(ends, targets)).all()
        one, two = common_ends(ends, targets)
        assert ends[one].tolist() == sorted(set(ends.tolist()) & set(targets.tolist())) == targets[two].tolist()


def test_groups_of_ranges():
    ints = lambda *x: np.array(x, dtype=np.int64)
    found = group_texts(ints(1, 20, 300, 7), ints(4, 50, 6, 48000), ints(1, 2, 3), ints(0, 2, 3), ints(0, 2, 0, 1, 0))
    assert found.to_pylist() == ["", "1,20|4;300|50,6", "", "7|48000", ""]
    assert group_texts(ints(), ints(), ints(), ints(), ints(0, 0)).to_pylist() == ["", ""]


def test_broadcast_bound():
    a, b = vocabularies(*PATHS)
    bound = possible_pairs(a.token_bytes, b.token_bytes)
    assert 50_000 < bound < 1_000_000
    assert possible_pairs([b"ab", b"b"], [b"b", b"cb", b"x"]) == 3


def test_plain_merges_are_the_librarys():
    a, _ = vocabularies(*PATHS)
    assert a.plain is not None
    plain = [chr(c) for c in range(PLAIN_LIMIT)] + ["\u2010", "\u2027"]
    rng = random.Random(8)
    for text in [f"a{c}b {c}{c} {c}" for c in plain] + ["".join(rng.choices(plain, k=60)) for _ in range(2000)]:
        assert a.encode(text)[0] == a.whole.encode(text, add_special_tokens=False).ids


def test_other_operators_keep_their_special_tokens(spark):
    from tripmill.llm.pieces import load

    vocabularies(*PATHS)
    assert load(PATHS[0]).text_ids("<|endoftext|>") == [50256]


def test_empty(empty_docs):
    assert run(empty_docs) == []
