"""Quality rules, line first: lines are judged, failing lines go, and texts that lose too much are rejected.

Everything is built-in expressions over one scan, without a shuffle. Base measures are exact over the whole
text; repeated words come from the hashes of its 8-word windows, which are sorted only in texts where two
windows agree (64-bit hashes within one text: a chance agreement is out of reach).

Line rules (an empty line never fails):
  symbols      more than a tenth of the characters are ``#*$%&|<>``
  punctuation  more than half of the words end in ``!!`` or ``??``
  navigation   at least three menu separators, one for every three words; or a menu entry by name; or at
               most four words, however long, without closing punctuation next to other lines
  boilerplate  a stock phrase of web pages
  stutter      more than half of the words repeat the word before them
What a rule looks for is first sought in the whole text, so most lines are judged by a flag.
A text is rejected if the base fails (fewer than 20 words, or more than 30 % of its words in repeated
windows) or if failing lines held more than half of its word characters.

Defined results: a null text has no words and fails the base; empty texts too; repeated rows and null ids
give a row each; columns besides id and text ride along in ``rest``; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import SPACE_CLASS, let

#: Fixed values; the phrases are sought in lower case.
SYMBOLS = r"[#*$%&|<>]"
BOILERPLATE = (
    "all rights reserved", "privacy policy", "cookie policy", "terms of use", "terms of service", "click here",
    r"read more\b", "subscribe to our", "subscribe to the", "sign up for", "enable javascript", "lorem ipsum",
    "share this page", "share this article", "share this post", "skip to content", "skip to main content", "back to top",
)
MENU = r"(?i)^(?:home|menu|login|log ?in|log ?out|sign in|register|contact(?: us)?|about(?: us)?|next|previous|search|sitemap|faq)$"
SEPARATOR_CHARS, SEPARATORS = "|»›•·>", r"[|»›•·>]"
#: One to four words; menu entries have at most two.
FEW_WORDS = r"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++(?:[\x20\x09-\x0D]++|$)){1,4}+$"
CLOSING = r"[.!?…:;\"')\]»]$"
BLANKS = " \t\n\x0b\x0c\r"
STUTTER = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]+)(?=[\x20\x09-\x0D]+\1(?:[\x20\x09-\x0D]|$))"

MIN_WORDS, WINDOW = 20, 8
MAX_REPEAT, MAX_LOST, MAX_SYMBOLS, MAX_EMPHASIS, MAX_STUTTER = 0.3, 0.5, 0.1, 0.5, 0.5


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")


def repeated_words(words: Column) -> Column:
    """How many words lie in 8-word windows that occur at least twice in the text."""

    def covered(windows: Column) -> Column:
        places = F.sort_array(F.transform(windows, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))

        def starts(s: Column) -> Column:
            last = F.size(s) - 1
            same = lambda x, n: x["h"] == F.get(s, n)["h"]
            twice = F.filter(
                s, lambda x, n: ((n > 0) & same(x, n - 1)) | ((n < last) & same(x, n + 1))
            )
            return F.sort_array(F.transform(twice, lambda x: x["at"]))

        def lengths(at: Column) -> Column:
            gap = lambda p, n: F.coalesce(F.get(at, n + 1) - p, F.lit(WINDOW))
            return F.transform(at, lambda p, n: F.least(F.lit(WINDOW), gap(p, n)).cast("bigint"))

        total = lambda xs: F.aggregate(xs, F.lit(0).cast("bigint"), lambda a, b: a + b)
        return let(places, lambda s: let(starts(s), lambda at: total(lengths(at))))

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)), lambda n: F.xxhash64(F.slice(hashes, n, WINDOW))
        )

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    counted = let(
        hashes,
        lambda h: let(
            windows(h),
            lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")).otherwise(covered(w)),
        ),
    )
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("bigint")).otherwise(counted)


def rule_flags(text: Column, lines: Column, words: Column, n_symbols: Column) -> Column:
    """What the whole text holds: a rule whose flag is unset fails no line of it."""
    lowered = F.lower(text)
    any_of = lambda where, parts: functools.reduce(operator.or_, (F.contains(where, F.lit(x)) for x in parts))
    repeats = F.filter(words, lambda w, n: (n > 0) & (w == F.get(words, n - 1)))
    return F.struct(
        (F.size(lines) > 1).alias("others"),
        (n_symbols > 0).alias("symbols"),
        any_of(text, ("!!", "??")).alias("emphasis"),
        any_of(text, SEPARATOR_CHARS).alias("separators"),
        any_of(lowered, [x.removesuffix(r"\b") for x in BOILERPLATE]).alias("boilerplate"),
        (F.size(repeats) > 1).alias("stutter"),
    )


def line_fails(line: Column, flags: Column) -> Column:
    """Whether a line fails a rule."""
    bare = F.btrim(line, F.lit(BLANKS))
    n_words = F.size(F.split(bare, SPACE_CLASS + "+"))
    count = lambda pattern: F.regexp_count(bare, F.lit(pattern))
    symbols = F.length(line) - F.length(F.regexp_replace(line, SYMBOLS, ""))
    return (
        (flags["symbols"] & (symbols > F.lit(MAX_SYMBOLS) * F.length(line)))
        | (flags["emphasis"] & (count(r"(?:!!|\?\?)(?=[\x20\x09-\x0D]|$)") > F.lit(MAX_EMPHASIS) * n_words))
        | (flags["separators"] & (count(SEPARATORS) >= 3) & (count(SEPARATORS) * 3 >= n_words))
        | (flags["stutter"] & (count(STUTTER) > F.lit(MAX_STUTTER) * n_words))
        | (line.rlike(FEW_WORDS) & (bare.rlike(MENU) | (flags["others"] & ~bare.rlike(CLOSING))))
        | (flags["boilerplate"] & F.lower(line).rlike("|".join(BOILERPLATE)))
    )


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Measures and verdict of every text, its cleaned ``text`` and ``rest`` (a struct of the other columns)."""
    others = [docs[name] for name in docs.columns if name not in (doc_id, text)]
    read = docs.select(
        docs[doc_id].alias("doc_id"),
        F.coalesce(docs[text], F.lit("")).alias("text"),
        F.struct(*others or [F.lit(None).cast("int").alias("none")]).alias("rest"),
    )
    split = read.select("*", words_of(F.col("text")).alias("words"), F.split("text", "\n").alias("lines"))
    lines = F.col("lines")
    worded = F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    chars = lambda xs: F.length(F.regexp_replace(F.array_join(xs, " "), SPACE_CLASS + "+", ""))
    n_symbols = F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))
    measured = split.select(
        "doc_id",
        "text",
        "rest",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        n_symbols.cast("bigint").alias("n_symbols"),
        let(worded, lambda w: F.size(w) - F.size(F.array_distinct(w))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        let(
            rule_flags(F.col("text"), lines, F.col("words"), n_symbols),
            lambda flags: F.transform(lines, lambda x: line_fails(x, flags)),
        ).alias("fails"),
        lines.alias("lines"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.lit(int(MAX_REPEAT * 100)) * F.col("n_words"))
    some = F.exists("fails", lambda x: x)
    pick = lambda wanted: F.filter(lines, lambda _, n: F.get(F.col("fails"), n) == wanted)
    judged = measured.select(
        "*",
        F.size(F.filter("fails", lambda x: x)).cast("bigint").alias("n_lines_removed"),
        F.when(some, chars(pick(True)).cast("bigint")).otherwise(F.lit(0).cast("bigint")).alias("chars_removed"),
        F.when(some, F.array_join(pick(False), "\n")).otherwise(F.col("text")).alias("cleaned"),
        failed.alias("base_failed"),
    )
    kept = ~F.col("base_failed") & (F.col("chars_removed") <= F.lit(MAX_LOST) * F.col("word_chars"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept.alias("kept"), "n_lines", "n_lines_removed", "chars_removed", F.col("cleaned").alias("text"), "rest",
    )
