"""Cross-tokenizer alignment: the tokens of two tokenizers over the same bytes, cut where both end.

1. A scan encodes each text, preceded by a space, with a byte-level vocabulary (A) and a piece vocabulary (B,
   which adds that space itself). Token lengths give the ascending end offsets of both.
2. The shorter end list drives an exponential-plus-binary ("galloping") search into the longer; the indices of
   ends found in both cut the tokens into groups, and the differences of consecutive indices are the ranges
   of A and of B tokens that cover the same bytes.
3. A link is an A token and a B token that end together. Links are counted per pair of ids over the corpus:
   map-side partial sums, then one shuffle of at most as many rows a task as there are possible pairs.
4. A second scan of the staged links looks the counts up and sums them by document.

Texts are encoded once and never shuffled. The broadcast table of pair counts has a bound that no corpus
can exceed: of two tokens that end together one ends with the other's bytes, so ``possible_pairs`` of the
vocabularies is the most there can be (a few hundred thousand).

Defined results: null and empty texts, and texts whose tokens do not spell the space and the text (a piece
normalizer may change characters), have no tokens: zeros and an empty ``groups``. Repeated rows count as
often as they stand there; null ids give a row each; columns other than id and text are ignored, whatever their
names; an empty table gives an empty result. Texts are encoded whole. Tokens have at least one byte each.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripmill.llm.pieces import _ALPHABET, PLAIN_LIMIT
from tripmill.llm.shared import ship_code

#: Driving ends that gallop side by side; tokens, and links, that a task handles at a time.
LANES, FLUSH = 8192, 500_000
#: The public piece pattern of byte-level vocabularies (fixed value), and what it is trusted with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NOT_PLAIN = re.compile(rf"[^\x00-{chr(PLAIN_LIMIT - 1)}‐-‧]")


class ByteVocabulary:
    """A byte-level BPE file; strings of special tokens in a text are plain text.

    Where ids follow the order of merges, tiktoken merges plain texts; the tokenizer's own library, which is
    slower, encodes texts with characters on which Unicode tables could disagree.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.whole.encode_special_tokens = True
        back = {char: byte for byte, char in _ALPHABET.items()}
        tokens = {number: token for token, number in self.whole.get_vocab(with_added_tokens=True).items()}
        self.token_bytes = [
            bytes(map(back.__getitem__, token)) if set(token) <= back.keys() else token.encode()
            for token in (tokens.get(number, "") for number in range(max(tokens) + 1))
        ]
        self.lengths = np.array([len(token) for token in self.token_bytes], dtype=np.int64)
        self.plain = self._ranked(json.loads(self.whole.to_str()))

    def _ranked(self, file: dict) -> tiktoken.Encoding | None:
        vocabulary = file["model"]["vocab"]
        merges = [x if isinstance(x, list) else x.split(" ") for x in file["model"]["merges"]]
        kind = file["pre_tokenizer"] or {}
        if (
            file["normalizer"] is not None or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space")
            or [vocabulary[one + two] for one, two in merges] != list(range(256, 256 + len(merges)))
        ):
            return None
        ranks = {self.token_bytes[number]: number for number in vocabulary.values() if number < 256 + len(merges)}
        return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> tuple[list[int], bool]:
        """The ids, and whether they are merges of the text's own bytes, which spell it."""
        if self.plain is None or _NOT_PLAIN.search(text):
            return self.whole.encode(text, add_special_tokens=False).ids, False
        return self.plain.encode_ordinary(text), True


class PieceVocabulary:
    """A sentencepiece file that puts a space before the text."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.token_bytes = [
            bytes([int(self.model.id_to_piece(n)[3:5], 16)])
            if self.model.is_byte(n)
            else self.model.id_to_piece(n).replace("▁", " ").encode()
            for n in range(self.model.vocab_size())
        ]
        self.lengths = np.array([len(token) for token in self.token_bytes], dtype=np.int64)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


@lru_cache(maxsize=2)
def vocabularies(path_a: str, path_b: str) -> tuple[ByteVocabulary, PieceVocabulary]:
    """Both vocabularies, once in each worker process."""
    return ByteVocabulary(path_a), PieceVocabulary(path_b)


def possible_pairs(a: list[bytes], b: list[bytes]) -> int:
    """How many pairs of ids can end together: one token's bytes end with the other's."""
    count = 0
    for ones, others, proper in ((a, b, 0), (b, a, 1)):  # equal bytes count once
        held: dict[bytes, int] = {}
        for token in others:
            held[token] = held.get(token, 0) + 1
        for token in ones:
            count += sum(held.get(token[cut:], 0) for cut in range(proper, len(token)))
    return count


def gallop(ends: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """For ascending targets: the index of the first end that is not smaller.

    Lanes of targets start where the lane before them stopped; a doubling step leaves each target
    between two probes, and a binary search between those finds it.
    """
    found, base, size = np.empty(len(targets), dtype=np.int64), 0, len(ends)
    for at in range(0, len(targets), LANES):
        lane = targets[at : at + LANES]
        low = np.full(len(lane), base, dtype=np.int64)
        high = np.full(len(lane), size, dtype=np.int64)
        first, step = 0, 1  # targets ascend, so those beyond a probe are the rest of the lane
        while first < len(lane) and base + step - 1 < size:
            probe = base + step - 1
            beyond = first + int(np.count_nonzero(lane[first:] <= ends[probe]))
            high[first:beyond] = probe
            low[beyond:] = probe + 1
            first, step = beyond, step * 2
        while (low < high).any():
            middle = (low + high) >> 1
            less = (low < high) & (ends[np.minimum(middle, size - 1)] < lane)
            high = np.where(less | (low >= high), high, middle)
            low = np.where(less, middle + 1, low)
        found[at : at + LANES] = low
        base = int(low[-1])
    return found


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices in both ascending lists of the ends that they share."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not len(short):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    at = gallop(long, short)
    shared = np.flatnonzero((at < len(long)) & (long[np.minimum(at, len(long) - 1)] == short))
    return (shared, at[shared]) if short is a else (at[shared], shared)


@lru_cache(maxsize=4)
def _decimals(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of the numbers below ``size``, from the left, and how many there are."""
    numbers = np.arange(size)
    sizes = np.array([len(str(n)) for n in range(size)], dtype=np.int64)
    places = np.maximum(sizes[:, None] - 1 - np.arange(sizes.max(initial=1)), 0)
    return (numbers[:, None] // 10**places % 10 + 48).astype(np.uint8), sizes


def group_texts(
    a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray, groups: np.ndarray
) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` for each document.

    ``a_last`` and ``b_last`` hold the common indices, ``groups`` how many of them each document has.
    """
    a_sizes, b_sizes = np.diff(a_last, prepend=-1), np.diff(b_last, prepend=-1)
    place = np.empty(len(a) + len(b), dtype=np.int64)  # a group's A tokens come before its B tokens
    place[np.arange(len(a)) + np.repeat(b_last + 1 - b_sizes, a_sizes)] = np.arange(len(a))
    place[np.arange(len(b)) + np.repeat(a_last + 1, b_sizes)] = len(a) + np.arange(len(b))
    marks = np.full(len(place), ord(","), dtype=np.uint8)
    marks[a_last] = ord("|")
    marks[len(a) + b_last] = ord(";")
    ends = np.cumsum(groups)
    last = len(a) + b_last[ends[groups > 0] - 1]
    ids = np.concatenate([a, b])[place]
    digits, sizes = (x[ids] for x in _decimals(1 << int(ids.max(initial=0)).bit_length()))
    marks, closed = marks[place], np.ones(len(place), dtype=np.int64)
    closed[(a_last + b_last + 1)[ends[groups > 0] - 1]] = 0  # no mark behind a document's last group
    assert (place[closed == 0] == last).all()
    starts = np.concatenate([[0], np.cumsum(sizes + closed)])
    out = np.empty(starts[-1], dtype=np.uint8)
    for digit in range(digits.shape[1]):
        held = np.flatnonzero(sizes > digit)
        out[starts[held] + digit] = digits[held, digit]
    held = np.flatnonzero(closed)
    out[starts[held] + sizes[held]] = marks[held]
    tokens = np.concatenate([[0], (a_last + b_last + 2)])[np.concatenate([[0], ends])]
    return pa.StringArray.from_buffers(
        len(groups), pa.py_buffer(starts[tokens].astype(np.int32)), pa.py_buffer(out)
    )


def align_tokens(
    docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_a, n_b, groups, links``: the groups as text, and each link as ``a * size of B + b``."""
    ship_code(docs.sparkSession)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = vocabularies(path_a, path_b)

        def rows(ids: pa.Array, a_lists: list[list[int]], b_lists: list[list[int]]) -> pa.RecordBatch:
            # The documents' tokens one behind the other: as both spell the same bytes, ends of different
            # documents never meet, and each document's last ends do.
            n_a, n_b = (np.array(list(map(len, lists)), dtype=np.int64) for lists in (a_lists, b_lists))
            a_ids, b_ids = (
                np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(n.sum()))
                for lists, n in ((a_lists, n_a), (b_lists, n_b))
            )
            a_last, b_last = common_ends(np.cumsum(a.lengths[a_ids]), np.cumsum(b.lengths[b_ids]))
            upto = np.searchsorted(a_last, np.cumsum(n_a))
            groups = np.diff(upto, prepend=0)
            links = a_ids[a_last] * len(b.token_bytes) + b_ids[b_last]
            offsets = np.concatenate([[0], upto]).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [ids, pa.array(n_a), pa.array(n_b), group_texts(a_ids, b_ids, a_last, b_last, groups),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(links))],
                ["doc_id", "n_a", "n_b", "groups", "links"],
            )

        for batch in batches:
            a_lists, b_lists, since, tokens = [], [], 0, 0
            for row, value in enumerate(batch.column(1)):
                a_ids, b_ids = _spelled(a, b, value.as_py() or "")
                a_lists.append(a_ids)
                b_lists.append(b_ids)
                tokens += len(a_ids) + len(b_ids)
                if tokens >= FLUSH:
                    yield rows(batch.column(0).slice(since, row + 1 - since), a_lists, b_lists)
                    a_lists, b_lists, since, tokens = [], [], row + 1, 0
            if since < batch.num_rows:
                yield rows(batch.column(0).slice(since), a_lists, b_lists)

    read = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    id_type = read.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(
        align, f"doc_id {id_type}, n_a bigint, n_b bigint, groups string, links array<bigint>"
    )


def _spelled(a: ByteVocabulary, b: PieceVocabulary, text: str) -> tuple[list[int], list[int]]:
    """The ids of both; none where the tokens do not spell the space and the text."""
    if not text:
        return [], []
    spelled, b_ids = (" " + text).encode(), b.encode(text)
    if b"".join(map(b.token_bytes.__getitem__, b_ids)) != spelled:
        return [], []
    a_ids, exact = a.encode(" " + text)
    if not exact and b"".join(map(a.token_bytes.__getitem__, a_ids)) != spelled:
        return [], []
    return a_ids, b_ids


def weigh_links(aligned: DataFrame, size_b: int) -> DataFrame:
    """Replaces ``links`` of a stored table by ``n_links, n_best, count_sum``.

    A link's count is how many links of the whole table hold its pair of ids; it is best if no other
    pair with its B id has a higher count. The table is read twice.
    """
    counted = aligned.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    table = counted.toArrow()  # at most possible_pairs rows, whatever the corpus
    pairs, n = (table[name].to_numpy() for name in ("pair", "n"))
    order = np.argsort(pairs)
    pairs, n = pairs[order], n[order]
    highest = np.zeros(size_b, dtype=np.int64)
    np.maximum.at(highest, pairs % size_b, n)
    known = aligned.sparkSession.sparkContext.broadcast((pairs, n, n == highest[pairs % size_b]))

    kept = [name for name in aligned.columns if name != "links"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = known.value
        for whole in batches:
            upto = np.cumsum(whole.column(len(kept)).value_lengths().to_numpy(zero_copy_only=False))
            cuts = np.unique(np.concatenate([np.flatnonzero(np.diff(upto // FLUSH, append=-1)) + 1, [whole.num_rows]]))
            for since, end in zip([0, *cuts], cuts):
                batch = whole.slice(since, end - since)
                links = batch.column(len(kept))
                sizes = links.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                at = np.searchsorted(pairs, links.flatten().to_numpy(zero_copy_only=False))
                ends = np.cumsum(sizes)
                sums = [np.concatenate([[0], np.cumsum(values[at], dtype=np.int64)]) for values in (best, n)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k) for k in range(len(kept))), pa.array(sizes),
                     *(pa.array(total[ends] - total[ends - sizes]) for total in sums)],
                    [*kept, "n_links", "n_best", "count_sum"],
                )

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema if f.name != "links")
    return aligned.select(*kept, "links").mapInArrow(
        weigh, f"{types}, n_links bigint, n_best bigint, count_sum bigint"
    )
