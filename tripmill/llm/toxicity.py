"""Toxicity by a weighted finite-state pattern grammar.

Words map to terminals: insult and threat stems with weights, targets, negations, verbs of reported speech,
quotes. Small transducers rewrite a clause's terminals one after the other: negation marks what stands in
its scope, reported speech marks what stands behind a reporting verb or between quotes, the target
transducer marks what is aimed at someone before or after it. Their composition is one deterministic
machine that reads a clause once and emits each match with its marks; the weights of a clause's matches
add up by mark, and a logistic model over the clause sums gives the score.

Fitted on labels: the stems (words and prefixes that separate the classes beyond chance) and the model's
weights, on a deterministic sample of about ``SAMPLE_ROWS`` labelled documents that are not held out, one of
each group of copies. Scoring is map-side over whole texts; stems and weights are bounded broadcast data.

Held out are the rows whose crc32 of the id as text is a multiple of 5; a null id counts as empty text.

Defined results: null and empty texts have no clauses and get the score of none; null labels and labels
without a document are ignored; without labels of both classes the fixed stems and weights hold; repeated
rows and null ids give a row each; columns other than the named ones are never read; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.pieces import WorkerCache
from tripmill.llm.shared import ship_code, stage

#: Bounds: labelled rows in the sample, stems in the grammar.
SAMPLE_ROWS, MAX_STEMS = 20_000, 4_000
PREFIX_CHARS, MAX_WORD_CHARS = (4, 5, 6, 7, 8), 24
#: A stem must separate the classes this clearly: likelihood ratio statistic, log odds.
MIN_EVIDENCE, MIN_ODDS = 30.0, 2.5
HELD_OUT_ONE_IN = 5

#: Terminals known without labels.
INSULTS = (
    "idiot moron stupid loser pathetic worthless disgusting trash scum clown dumb imbecile fool filthy vermin "
    "dummkopf trottel abschaum widerlich wertlos versager crétin imbécile abruti ordure minable "
    "estúpido estúpida imbécil basura asqueroso inútil"
).split()
THREATS = "kill hurt destroy punch stab shoot strangle töten umbringen vernichten tuer frapper matar golpear".split()
TARGETS = (
    "you your yours he him his she her they them their du dich dir dein deine ihr euch sie er tu toi te vous votre "
    "il elle ils tú ti usted ustedes él ella ellos"
).split()
_TARGETS = frozenset(TARGETS)
NEGATIONS = "not no never isn aren wasn don doesn nobody nicht kein keine nie ne pas jamais nunca jamás".split()
REPORTS = (
    "said says called calls wrote writes claimed claims quoted reported alleged sagte nannte schrieb behauptete "
    "dit disait écrit dijo llamó escribió"
).split()
#: Fixed weights without labels: log odds of a known stem, model over the eight marks, and its bias.
KNOWN_ODDS, BIAS = 4.0, -3.0
MODEL = {"plain": 1.0, "targeted": 1.2, "negated": 0.4, "reported": 0.3}

MARKS = tuple(f"{kind}_{mark}" for kind in ("insult", "threat") for mark in ("plain", "targeted", "negated", "reported"))
_TOKEN = re.compile(r"[^\W\d_]+|[\"“”„«»]|[.!?;:\n]")
_WORD = re.compile(r"[^\W\d_]+")

# Terminals.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE = range(7)
NEGATION_SCOPE, TARGET_SCOPE = 3, 4


def negation_step(state: int, symbol: tuple) -> tuple[int, tuple]:
    """State: words left in scope."""
    if symbol[0] == NEGATION:
        return NEGATION_SCOPE, symbol
    marked = (*symbol, "negated") if symbol[0] in (INSULT, THREAT) and state else symbol
    return max(0, state - 1), marked


def report_step(state: tuple[bool, bool], symbol: tuple) -> tuple[tuple[bool, bool], tuple]:
    """State: (behind a reporting verb, between quotes)."""
    said, quoted = state
    if symbol[0] == REPORT:
        return (True, quoted), symbol
    if symbol[0] == QUOTE:
        return (said, not quoted), symbol
    marked = (*symbol, "reported") if symbol[0] in (INSULT, THREAT) and (said or quoted) else symbol
    return state, marked


def target_step(state: tuple[int, int, int], symbol: tuple) -> tuple[tuple[int, int, int], tuple]:
    """State: words left in the scope of a target before, of a match before, and what that match is.

    A late target emits a mark of its own, of the match's kind.
    """
    aimed, matched, kind = state
    after = max(0, aimed - 1), max(0, matched - 1)
    if symbol[0] == TARGET:
        return (TARGET_SCOPE, 0, OTHER), ((kind, "targeted") if matched else symbol)
    if symbol[0] in (INSULT, THREAT):
        if aimed:
            return (after[0], 0, OTHER), (*symbol, "targeted")
        return (after[0], TARGET_SCOPE, symbol[0]), symbol
    return (*after, kind if after[1] else OTHER), symbol


TRANSDUCERS = ((0, negation_step), ((False, False), report_step), ((0, 0, OTHER), target_step))


def compose() -> tuple[list[list[int]], list[list[int]]]:
    """Tables of the composed machine: next state and emitted mark (-1: none) by state and terminal."""
    start = tuple(state for state, _ in TRANSDUCERS)
    numbers, todo, following, emitted = {start: 0}, [start], [], []
    for states in todo:
        nexts, marks = [], []
        for terminal in range(QUOTE + 1):
            symbol, after = (terminal,), []
            for state, (_, step) in zip(states, TRANSDUCERS):
                state, symbol = step(state, symbol)
                after.append(state)
            after = tuple(after)
            if after not in numbers:
                numbers[after] = len(numbers)
                todo.append(after)
            nexts.append(numbers[after])
            if symbol[0] in (INSULT, THREAT):
                mark = next((m for m in ("reported", "negated", "targeted") if m in symbol[1:]), "plain")
                marks.append(MARKS.index(("insult_" if symbol[0] == INSULT else "threat_") + mark))
            else:
                marks.append(-1)
        following.append(nexts)
        emitted.append(marks)
    return following, emitted


NEXT, EMIT = compose()


@dataclass(frozen=True)
class Grammar:
    """Stem → (terminal, weight), for whole words and for prefixes."""

    words: dict[str, tuple[int, float]]
    prefixes: dict[str, tuple[int, float]]

    def terminal(self, word: str) -> tuple[int, float]:
        if word in self.words:
            return self.words[word]
        for size in PREFIX_CHARS:
            if len(word) > size and word[:size] in self.prefixes:
                return self.prefixes[word[:size]]
        return OTHER, 0.0


def clause_sums(text: str, terminal_of) -> list[float]:
    """By mark: the sum over clauses of what the clause's matches weigh, damped within the clause."""
    text = text.lower()
    totals = [0.0] * len(MARKS)
    if not any(terminal_of(word)[0] in (INSULT, THREAT) for word in set(_WORD.findall(text))):
        return totals
    state, clause = 0, {}
    for token in [*_TOKEN.findall(text), "."]:
        if token in ".!?;:\n":
            for mark, weight in clause.items():
                totals[mark] += math.log1p(weight)
            state, clause = 0, {}
            continue
        terminal, weight = (QUOTE, 0.0) if token in "\"“”„«»" else terminal_of(token)
        mark = EMIT[state][terminal]
        if mark >= 0:
            clause[mark] = clause.get(mark, 0.0) + (weight or 1.0)
        state = NEXT[state][terminal]
    return [math.log1p(total) for total in totals]


def known_grammar(odds: dict[str, float] | None = None) -> tuple[dict, dict]:
    """The fixed terminals; ``odds``: what labels say about known stems, which may rule them out."""
    words = {}
    for terminal, listed in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
        words |= dict.fromkeys(listed, (terminal, 0.0))
    for terminal, listed in ((INSULT, INSULTS), (THREAT, THREATS)):
        for word in listed:
            weight = KNOWN_ODDS if odds is None or word not in odds else odds[word]
            if weight >= 1.0:
                words[word] = (terminal, weight)
    return words, {}


def stems_of(text: str) -> set[str]:
    """A text's words, and its prefixes with a trailing dash."""
    words = {w for w in _WORD.findall(text.lower()) if len(w) <= MAX_WORD_CHARS}
    return words | {f"{w[:n]}-" for w in words for n in PREFIX_CHARS if len(w) > n}


def aimed_stems_of(text: str) -> set[str]:
    """Stems of the words that stand right before a target, as the verb of a threat does."""
    words = _WORD.findall(text.lower())
    return set().union(*(stems_of(word) for word, after in zip(words, words[1:]) if after in _TARGETS))


def evidence(toxic: int, clean: int, n_toxic: int, n_clean: int) -> tuple[float, float]:
    """Likelihood ratio statistic and log odds of a stem seen in so many documents of each class."""
    prior, seen = n_toxic / (n_toxic + n_clean), toxic + clean
    g = sum(2 * n * math.log(n / (seen * p)) for n, p in ((toxic, prior), (clean, 1 - prior)) if n)
    return g, math.log((toxic + 0.5) / (n_toxic + 1) * (n_clean + 1) / (clean + 0.5))


def sample_of(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, toxic: str) -> DataFrame:
    """``text, toxic``: about ``SAMPLE_ROWS`` labelled documents that are not held out."""
    marked = labels.select(labels[doc_id].alias("label_id"), labels[toxic].cast("int").alias("toxic")).filter(
        F.col("label_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("label_id"))
    )
    share = min(1.0, SAMPLE_ROWS / max(1, marked.count()))
    drawn = marked.filter(F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).distinct()
    # About SAMPLE_ROWS ids at most.
    return docs.select(docs[doc_id].alias("label_id"), docs[text].alias("text")).join(
        F.broadcast(drawn), "label_id"
    ).filter(F.length("text") > 0).select("text", "toxic")


def held_out(doc_id):
    as_text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(as_text, "UTF-8")), F.lit(HELD_OUT_ONE_IN)) == 0


def without_copies(sample: DataFrame) -> DataFrame:
    """One of each group of near copies: texts that share the least shingle hash, twice over. The least row stays."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = [[], []]
            for value in batch.column(0):
                words = value.as_py().split()
                shingles = [" ".join(words[n : n + 3]).encode() for n in range(max(1, len(words) - 2))]
                for seed, out in enumerate(least):
                    out.append(min(zlib.crc32(s, seed * 7919) ^ (seed * 0x5BD1E995) for s in shingles))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(x, pa.int64()) for x in least)], ["text", "toxic", "k0", "k1"]
            )

    keyed = sample.mapInArrow(keys, "text string, toxic int, k0 bigint, k1 bigint")
    for key, other in (("k0", "k1"), ("k1", "k0")):
        keyed = keyed.groupBy(key).agg(F.min(F.struct(other, "text", "toxic")).alias("least")).select(key, "least.*")
    return keyed.select("text", "toxic")


def learn_grammar(sample: DataFrame, counts: dict[int, int]) -> Grammar:
    """Stems that separate the classes; the shortest one stands for those it covers.

    A stem that stands right before a target in more than half of the toxic texts that hold it is a threat's verb
    ("we will ... you"), any other an insult.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Counter(), Counter(), Counter()]
        for batch in batches:
            for value, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[label].update(stems_of(value))
                if label:
                    found[2].update(aimed_stems_of(value))
        stems = list(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(stems, pa.string()), *(pa.array([c[s] for s in stems], pa.int64()) for c in found)],
            ["stem", "clean", "toxic", "aimed"],
        )

    table = (
        sample.mapInArrow(count, "stem string, clean bigint, toxic bigint, aimed bigint")
        .groupBy("stem")
        .agg(*(F.sum(name).alias(name) for name in ("clean", "toxic", "aimed")))
    )
    n_clean, n_toxic = counts[0], counts[1]
    known = table.filter(F.col("stem").isin(*INSULTS, *THREATS)).collect()
    # A stem seen as often among clean texts as its share allows cannot pass; the rest is few rows.
    able = F.col("toxic") * n_clean > F.col("clean") * n_toxic * math.exp(MIN_ODDS - 1)
    rows = table.filter((F.col("toxic") >= 4) & able).orderBy(F.desc("toxic"), "stem").limit(4 * MAX_STEMS).collect()
    words, prefixes = known_grammar(
        {r.stem: max(evidence(r.toxic, r.clean, n_toxic, n_clean)[1], 0.0) for r in known if r.toxic + r.clean >= 4}
    )
    taken = 0
    for row in sorted(rows, key=lambda r: (len(r.stem.rstrip("-")), r.stem)):
        g, odds = evidence(row.toxic, row.clean, n_toxic, n_clean)
        stem = row.stem.rstrip("-")
        covered = any(stem[:n] in prefixes for n in PREFIX_CHARS if len(stem) >= n) or stem in words
        if g >= MIN_EVIDENCE and odds >= MIN_ODDS and not covered and taken < MAX_STEMS:
            taken += 1
            terminal = THREAT if 2 * row.aimed > row.toxic else INSULT
            (prefixes if row.stem.endswith("-") else words)[stem] = (terminal, odds)
            if row.stem.endswith("-"):
                words.setdefault(stem, (terminal, odds))
    return Grammar(words, prefixes)


def fit_model(features: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps, no weight below zero."""
    x = np.column_stack([features, np.ones(len(features))])
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], 1.0)
    ridge[-1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (labels - p) - ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    w[:-1] = np.maximum(w[:-1], 0.0)
    return w[:-1], float(w[-1])


_CACHES: dict[int, WorkerCache] = {}


def _featurised(rows: DataFrame, shared, first: str, first_type: str, model=None) -> DataFrame:
    """Each row's first column with its clause sums, or with its score under ``model``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = shared.value
        if id(grammar) not in _CACHES:
            _CACHES.clear()
            _CACHES[id(grammar)] = WorkerCache({}, grammar.terminal)
        terminal_of = _CACHES[id(grammar)].__getitem__
        for batch in batches:
            sums = [clause_sums(value.as_py() or "", terminal_of) for value in batch.column(1)]
            matrix = np.array(sums, dtype="float64").reshape(-1, len(MARKS))
            if model is None:
                out = pa.FixedSizeListArray.from_arrays(pa.array(matrix.ravel()), len(MARKS)).cast(pa.list_(pa.float64()))
            else:
                out = pa.array(1 / (1 + np.exp(-np.clip(matrix @ model[0] + model[1], -30, 30))))
            yield pa.RecordBatch.from_arrays([batch.column(0), out], [first, "out"])

    kind = "array<double>" if model is None else "double"
    return rows.mapInArrow(run, f"{first} {first_type}, out {kind}")


def score_toxicity(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic"
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    spark = docs.sparkSession
    ship_code(spark)
    sample = stage(without_copies(sample_of(docs, labels, doc_id, text, toxic)), "labelled")
    counts = {0: 0, 1: 0} | {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if counts[0] and counts[1]:
        shared = spark.sparkContext.broadcast(learn_grammar(sample, counts))
        fitted = _featurised(sample.select("toxic", "text"), shared, "toxic", "int").collect()  # SAMPLE_ROWS rows
        model = fit_model(np.array([r.out for r in fitted]), np.array([r.toxic for r in fitted], dtype="float64"))
    else:
        shared = spark.sparkContext.broadcast(Grammar(*known_grammar()))
        model = np.array([MODEL[mark.split("_")[1]] * 2 for mark in MARKS]), BIAS
    read = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    id_type = read.schema["doc_id"].dataType.simpleString()
    return _featurised(read, shared, "doc_id", id_type, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("out").alias("score"),
        (F.col("out") >= 0.5).cast("int").alias("predicted"),
    )
