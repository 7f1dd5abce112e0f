import sys

import pytest

from tests.conftest import REPO, TESTDATA  # noqa: F401

sys.path.insert(0, REPO)

#: Nulls, empty and blank texts, repeated rows, ties, mixed scripts, short and long texts.
SENTENCE = "The quick brown fox jumps over the lazy dog and then it runs far away from the old mill by the river"
EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n\n \x0b\x0c\r"),
    (4, SENTENCE + ".\n" + SENTENCE.upper() + "\nshort"),
    (5, "  " + SENTENCE + ".  \nÉtude ÉTUDE étude " + SENTENCE),
    (6, SENTENCE + ".\n" + SENTENCE + ".\n" + SENTENCE + "."),
    (7, SENTENCE + ".\n" + SENTENCE + ".\n" + SENTENCE + "."),
    (8, "one two"),
    (9, "one two"),
    (10, "One TWO three"),
    (11, "<|endoftext|> naïve Ωμέγα Σ ς 漢字 it's 're 12345 ½ ́e <|startoftext|> x"),
    (12, " ".join(f"w{n % 97}x{n % 89}" for n in range(30_000))),
    (13, " ".join(f"w{n % 97}x{n % 89}" for n in range(30_000)) + " tail"),
    (14, "and " * 400),
    (15, "Home\nMenu\nLogin\n" + SENTENCE + ".\nClick here to read more.\n" + SENTENCE + " again."),
    (16, "a | b | c | d\nx | y | z | w\n" + "word!! " * 40),
    (17, " line para\x1cfs\x1dgs\x85nel\xa0nbsp　wide"),
    (18, "q" * 49),
    (19, "q" * 50),
    (20, "q" * 120),
]


@pytest.fixture(scope="session")
def edges():
    return EDGES


@pytest.fixture(scope="session")
def edge_docs(spark):
    """The edge rows with extra columns whose names operators use themselves."""
    rows = [(i, t, f"k{i % 3}", i, None) for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id bigint, text string, kept string, n_lines int, rest string").repartition(4)


@pytest.fixture(scope="session")
def small_docs(spark):
    """(doc_id, text) rows and frame of the test table."""
    frame = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()], frame


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")


def rows_of(frame, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
