"""The grammar's machine, the fit on labels, held-out accuracy and edge cases."""

import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import TESTDATA, rows_of
from tripmill.llm import toxicity
from tripmill.llm.toxicity import MARKS, Grammar, clause_sums, known_grammar, score_toxicity

GRAMMAR = Grammar(*known_grammar())


def marks(text):
    return {m for m, v in zip(MARKS, clause_sums(text, GRAMMAR.terminal)) if v}


@pytest.mark.parametrize(
    "text, found",
    [
        ("what an idiot", {"insult_plain"}),
        ("you are an idiot", {"insult_targeted"}),
        ("an idiot, that is you", {"insult_plain", "insult_targeted"}),
        ("this is not stupid", {"insult_negated"}),
        ("the paper wrote stupid things", {"insult_reported"}),
        ('the "idiot" chapter', {"insult_reported"}),
        ("not here. what an idiot", {"insult_plain"}),
        ("they will kill", {"threat_targeted"}),
        ("kill you", {"threat_plain", "threat_targeted"}),
        ("we never kill", {"threat_negated"}),
        ("a quiet day", set()),
        ("", set()),
    ],
)
def test_machine(text, found):
    assert marks(text) == found


def remainder(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_scores_of_edges(spark, edges, edge_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = {r.doc_id: r for r in score_toxicity(edge_docs, none).collect()}
    assert sorted(out) == [i for i, _ in edges]
    assert all(out[i].held_out == remainder(i) and 0 <= out[i].score <= 1 for i in out)
    assert out[1].score == out[2].score and all(r.predicted == (r.score >= 0.5) for r in out.values())


def learned_rows():
    """A made-up language whose insults share a stem; clean words, copies and a null label besides."""
    rows, labels = [], []
    for n in range(600):
        words = [f"la{(n * k) % 211}".translate(str.maketrans("0123456789", "abcdefghij")) for k in range(1, 40)]
        toxic = n % 4 == 0
        if toxic:
            words[n % 30] = "grumpf" + "abcdefgh"[n % 8] * 2
        rows.append((n, " ".join(words) + ("." if n % 2 else "")))
        labels.append((n, 1, None if n == 7 else int(toxic)))
    return rows, labels


def test_learned_stems(spark):
    rows, labels = learned_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    truth = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    out = {r.doc_id: r for r in score_toxicity(docs, truth).collect()}
    assert all(out[i].predicted == int(i % 4 == 0) for i, _ in rows if remainder(i))


def test_learned_threats(spark, monkeypatch):
    """A made-up verb that stands before its target is a threat, one that stands elsewhere an insult."""
    rows, labels = learned_rows()
    rows = [(i, f"{t} we will " + ("go" if i % 8 else f"zwolk{'abcd'[i // 8 % 4]}") + " you") for i, t in rows]
    learned = []
    learn = toxicity.learn_grammar
    monkeypatch.setattr(toxicity, "learn_grammar", lambda *given: learned.append(learn(*given)) or learned[-1])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    truth = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    out = {r.doc_id: r for r in score_toxicity(docs, truth).collect()}
    assert learned[0].terminal("zwolka")[0] == toxicity.THREAT and learned[0].terminal("grumpfaa")[0] == toxicity.INSULT
    assert "threat_targeted" in {m for m, v in zip(MARKS, clause_sums("we will zwolkb you", learned[0].terminal)) if v}
    assert all(out[i].predicted == int(i % 4 == 0) for i, _ in rows if remainder(i))


def test_survivors_do_not_depend_on_the_layout(spark):
    rows = [(f"{w} b c d e f", n % 2) for n, w in enumerate("aaaaxxyyzz")] * 3
    frame = spark.createDataFrame(rows, "text string, toxic int")
    kept = [rows_of(toxicity.without_copies(f), "text", "toxic") for f in (frame.coalesce(1), frame.repartition(5), frame.orderBy(F.desc("toxic")))]
    assert kept[0] == kept[1] == kept[2] and kept[0]


def clause_marks(clause, terminal_of):
    """Marks of a clause by looking around each match, without a machine."""
    tokens = [(toxicity.QUOTE, 0.0) if t in '"“”„«»' else terminal_of(t) for t in toxicity._TOKEN.findall(clause)]
    kinds, out = [kind for kind, _ in tokens], {}
    after_target = -1  # where a target behind a match may still claim it
    for n, (kind, weight) in enumerate(tokens):
        mark = None
        if kind in (toxicity.INSULT, toxicity.THREAT):
            negated = toxicity.NEGATION in kinds[max(0, n - 3) : n]
            reported = toxicity.REPORT in kinds[:n] or kinds[:n].count(toxicity.QUOTE) % 2
            targeted = toxicity.TARGET in kinds[max(0, n - 4) : n]
            mark = "reported" if reported else "negated" if negated else "targeted" if targeted else "plain"
            mark = ("insult_" if kind == toxicity.INSULT else "threat_") + mark
            after_target = n if not targeted else -1
        elif kind == toxicity.TARGET:
            if 0 <= after_target and n - after_target <= 4:
                mark = "insult_targeted" if kinds[after_target] == toxicity.INSULT else "threat_targeted"
            after_target = -1
        if mark:
            out[mark] = out.get(mark, 0.0) + (weight or 1.0)
    return out


def test_machine_against_looking_around():
    random.seed(3)
    words = ["idiot", "kill", "you", "not", "said", '"', "tree", "house", "they", "never", "stupid"]
    for _ in range(3000):
        clauses = [" ".join(random.choices(words, k=random.randint(0, 12))) for _ in range(random.randint(1, 3))]
        want = dict.fromkeys(MARKS, 0.0)
        for clause in clauses:
            for mark, weight in clause_marks(clause, GRAMMAR.terminal).items():
                want[mark] += math.log1p(weight)
        got = clause_sums(". ".join(clauses), GRAMMAR.terminal)
        assert got == pytest.approx([math.log1p(want[m]) for m in MARKS])


def test_held_out_toxic_documents_are_found(spark):
    """Of those that hold a match at all, nine in ten; labels also mark texts without any."""
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    labels = spark.read.parquet(f"{TESTDATA}/labels.parquet")
    out = score_toxicity(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id")
    rows = [r for r in out.filter("toxic = 1 and held_out").collect() if marks(r.text)]
    assert rows and sum(r.predicted for r in rows) >= 0.9 * len(rows)


def test_labels_of_held_out_rows_do_not_matter(spark):
    rows, labels = learned_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    flipped = [(i, q, t if t is None or not remainder(i) else 1 - t) for i, q, t in labels]
    scores = [
        {r.doc_id: r.score for r in score_toxicity(docs, spark.createDataFrame(x, "doc_id bigint, quality int, toxic int")).collect()}
        for x in (labels, flipped)
    ]
    assert scores[0] == pytest.approx(scores[1], abs=1e-12)


def test_clean_labelled_documents_stay_clean(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    labels = spark.read.parquet(f"{TESTDATA}/labels.parquet")
    out = score_toxicity(docs, labels).join(labels, "doc_id").filter("toxic = 0")
    assert out.filter("predicted = 1").count() <= 0.02 * out.count()


def test_empty_tables(spark, empty_docs):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert score_toxicity(empty_docs, labels).collect() == []
