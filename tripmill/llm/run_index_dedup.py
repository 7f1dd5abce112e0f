"""Removal of repeated byte strings with a run-length index.

1. Anchors. In each string of ``WIDTH`` bytes the ``GRAM``-byte gram of least hash is its anchor, so two
   copies of a string have the same anchor at the same place. Anchors go to buckets by hash; one that stands
   in a single document rules out every string that it anchors.
2. Snippets. For the anchors that several documents share, the bytes that strings around the anchor can
   cover (at most ``2 * WIDTH - GRAM``) go to the anchor's bucket; equal snippets are one content.
3. Index. Of a bucket's contents, those of the smaller half of its documents make a text whose Burrows-Wheeler
   transform is kept as runs, with suffix positions sampled at both ends of each. The others are streamed
   through it backwards, all in lockstep, for their matching statistics: a step of the last-to-first mapping
   finds its run by binary search; where the symbol differs, the next run of the symbol above or below goes on,
   whichever sampled suffix shares more. A match of ``WIDTH`` bytes marks a repeat, as every indexed document
   is smaller. Contents with an unmatched string go on to another round alike, so rounds together cost about
   one pass. Repeats among the indexed contents themselves are read off the suffix array of the build.
   Contents of one anchor that share a string agree on ``SIDE`` bytes before the anchor or on as many behind it;
   what agrees with no other content is neither indexed nor streamed, and a match that ends too early for any
   string is followed no further.
4. Frequent anchors. An anchor whose contents differ from document to document (the edge of a passage, a short
   line in changing surroundings) would make one bucket as large as the corpus. Anchors of ``FREQUENT`` contents
   or more, as a sample of the documents shows, go another way: each of their strings is keyed by 128 bits of
   hash, and the least document of a key decides. Both ways give the same marks.
5. Marks come back to their documents, where covered bytes are cut out.

Map tasks collapse what they can decide alone: of the copies of an anchor or of a content in one batch only
the least id travels to the bucket, so the inside of a passage in a third of all documents costs a bucket one
row a batch, and so does each string of a frequent anchor that many documents share.
Buckets follow the bytes of the corpus. Exchanged are about 6 % of the positions as packed hashes, the snippets
of shared anchors, and each text once.

Defined results: a null text has no bytes; texts shorter than ``WIDTH`` lose nothing; a row with a null id is
never cut and never a source; rows with one id are no sources for each other (ids are expected to be unique up
to repeated rows: different texts under one id are each cut at the places of both); other columns are
ignored; an empty table gives an empty result. Ids of any type that sorts: "smaller" is Spark's order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tripmill.llm.shared import ship_code, stage

WIDTH, GRAM = 50, 24
SLIDE = WIDTH - GRAM  # bytes that a string can reach beyond its anchor on either side
SNIPPET = WIDTH + SLIDE
SIDE = SLIDE // 2  # bytes on one side of the anchor, at least, of every string around it
#: Bytes hashed at a time, so few that the hashes stay in the processor's cache, and bytes of text behind a bucket of anchors.
CHUNK, BUCKET_BYTES = 1 << 17, 4 << 20
#: Bytes of text whose anchors a map task holds at a time.
PART_BYTES = 8 << 20
#: Contents from which an anchor counts as frequent, and one document in how many is looked at for that.
FREQUENT, SAMPLE = 1 << 14, 64
_TABLE = np.random.default_rng(4).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]
#: Where a packed word of seven symbols of nine bits begins to differ in its last symbol but 1, 2, ... 6.
_WORD_STEPS = np.uint64(1) << np.arange(9, 63, 9, dtype=np.uint64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each position on, by doubling: 1, 2, 4, 8, 16, then 16 + 8."""
    h, eight = _TABLE[data], None
    for step, multiplier in zip((1, 2, 4, 8), _MULTIPLIERS):
        if step == 8:
            eight = h
        h = (h[:-step] * multiplier) ^ (h[step:] + (h[step:] >> np.uint64(31)))
    h = (h[: len(eight) - 16] * _MULTIPLIERS[0]) ^ eight[16:]
    return (h ^ (h >> np.uint64(32))) * _MULTIPLIERS[2]


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over each run of ``width`` values, by doubling."""
    span, out = 1, values
    while span * 2 <= width:
        out = pick(out[:-span], out[span:])
        span *= 2
    return pick(out[: len(values) - width + 1], out[width - span : width - span + len(values) - width + 1])


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchor positions and hashes of the texts that ``data`` joins; ``ends``: where each text ends."""
    if len(data) < WIDTH:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    hashes = gram_hashes(data)
    least = _sliding(hashes, SLIDE + 1, np.minimum)  # by start of the string
    for end in ends[:-1]:  # strings must not cross texts
        least[max(0, end - WIDTH + 1) : end] = 0
    padded = np.concatenate([np.zeros(SLIDE, dtype=np.uint64), least, np.zeros(SLIDE, dtype=np.uint64)])
    at = np.flatnonzero((_sliding(padded, SLIDE + 1, np.maximum) == hashes) & (hashes != 0))
    return at, hashes[at]


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """Groups of (row, offset, bytes) of about ``CHUNK`` bytes; long texts overlap by a string less a byte."""
    group, size = [], 0
    for row, text in enumerate(texts):
        for start in range(0, max(1, len(text) - WIDTH + 1), CHUNK):
            part = text[start : start + CHUNK + WIDTH - 1]
            group.append((row, start, part))
            size += len(part)
            if size >= CHUNK:
                yield group
                group, size = [], 0
    if group:
        yield group


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``PART_BYTES`` of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64)
        cuts = _groups(np.cumsum(sizes) // PART_BYTES)
        for start, stop in zip(cuts, [*cuts[1:], len(sizes)]):
            yield batch.slice(start, stop - start)


def batch_anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, position and hash of every anchor of the texts."""
    rows, places, hashes = [], [], []
    for group in _chunks(texts):
        lengths = np.array([len(part) for *_, part in group])
        ends = np.cumsum(lengths)
        at, found = anchors(np.frombuffer(b"".join(part for *_, part in group), dtype=np.uint8), ends)
        which = np.searchsorted(ends, at, side="right")
        rows.append(np.array([row for row, *_ in group])[which])
        places.append(at - (ends - lengths)[which] + np.array([start for _, start, _ in group])[which])
        hashes.append(found)
    empty = np.empty(0, dtype=np.int64)
    return (
        np.concatenate([empty, *rows]),
        np.concatenate([empty, *places]),
        np.concatenate([empty.astype(np.uint64), *hashes]),
    )


def _groups(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts."""
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(sorted_keys) else np.empty(0, dtype=np.int64)


def _least_of(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order by key; for each sorted entry its group's number; the groups' least and largest doc."""
    order = np.argsort(keys)
    starts = _groups(keys[order])
    numbers = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
    held = docs[order]
    if not len(starts):
        return order, numbers, held, held
    return order, numbers, np.minimum.reduceat(held, starts), np.maximum.reduceat(held, starts)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Numbers of buckets, narrow ones if they can be: a stable sort of these takes one pass."""
    return (hashes % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.uint64)


def _five(hashes: np.ndarray) -> bytes:
    """The low five bytes of each hash: with the bucket, enough to tell anchors apart."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _packed_anchors(docs: DataFrame, buckets: int) -> DataFrame:
    """``bucket, hashes, docs, places``: packed anchors; those already known as shared are in buckets below 0."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            texts = [(value.as_py() or "").encode() for value in batch.column(1)]
            rows, places, hashes = batch_anchors(texts)
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)[rows]
            order, group, first, last = _least_of(hashes, ids)
            # Of a shared anchor only one place of its least id asks the bucket; of others, every place does.
            shared, asks = np.empty(len(ids), dtype=bool), np.empty(len(ids), dtype=bool)
            shared[order] = (first < last)[group]
            asks[order] = ~shared[order]
            least = np.flatnonzero(ids[order] == first[group])
            asks[order[least[_groups(group[least])]]] = True
            bucket = _bucket(hashes >> np.uint64(40), buckets)
            out = [[], [], [], []]

            def emit(number: int, where: np.ndarray) -> None:  # by row, then by place, as they were found
                out[0].append(number)
                out[1].append(_five(hashes[where]))
                out[2].append(ids[where].astype("<i8").tobytes())
                out[3].append(places[where].astype("<u4").tobytes())

            asking = np.flatnonzero(asks)
            by_bucket = asking[np.argsort(bucket[asking], kind="stable")]
            cuts = _groups(bucket[by_bucket])
            for part in np.split(by_bucket, cuts[1:]) if len(by_bucket) else []:
                emit(int(bucket[part[0]]), part)
            known = np.flatnonzero(shared)
            if len(known):
                emit(-1 - int(hashes[known[0]] % np.uint64(buckets)), known)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])],
                ["bucket", "hashes", "docs", "places"],
            )

    return docs.mapInArrow(pack, "bucket int, hashes binary, docs binary, places binary")


def _shared_places(packed: DataFrame) -> DataFrame:
    """``doc_id, place`` of the anchors that stand in several documents."""

    def reduce(table: pa.Table) -> pa.Table:
        ids = np.frombuffer(b"".join(table["docs"].to_pylist()), dtype="<i8")
        places = np.frombuffer(b"".join(table["places"].to_pylist()), dtype="<u4").astype(np.int64)
        if table["bucket"][0].as_py() >= 0:
            raw = np.frombuffer(b"".join(table["hashes"].to_pylist()), dtype=np.uint8).reshape(-1, 5)
            keys = np.zeros((len(raw), 8), dtype=np.uint8)
            keys[:, :5] = raw
            order, group, first, last = _least_of(keys.view("<u8").ravel(), ids)
            where = order[(first < last)[group]]
            ids, places = ids[where], places[where]
        return pa.table([pa.array(ids), pa.array(places, pa.int32())], ["doc_id", "place"])

    return packed.groupBy("bucket").applyInArrow(reduce, "doc_id bigint, place int")


@dataclass
class RunIndex:
    """A run-compressed Burrows-Wheeler transform with suffix positions sampled at both ends of each run."""

    words: np.ndarray  # the seven symbols from each position of the text on, packed
    run_starts: np.ndarray  # row where each run begins
    run_numbers: np.ndarray  # run of each row
    run_symbols: np.ndarray
    run_heads: np.ndarray  # row that the run's first row maps to
    run_lengths: np.ndarray
    first_samples: np.ndarray  # suffix position at the first row of each run
    last_samples: np.ndarray  # and at the last one
    by_symbol: np.ndarray  # runs by symbol, then by place
    symbol_keys: np.ndarray  # symbol and place of these, as one sorted number

    def run_of(self, rows: np.ndarray) -> np.ndarray:
        return self.run_numbers[rows]

    def step(self, rows: np.ndarray) -> np.ndarray:
        """Last-to-first mapping: the rows of the suffixes one byte longer."""
        run = self.run_of(rows)
        return self.run_heads[run] + rows - self.run_starts[run]

    def shared(self, one: np.ndarray, two: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Symbols that the suffixes at ``one`` and ``two``, which differ, have in common, up to ``limit``."""
        out, todo = np.zeros(len(one), dtype=np.int64), np.flatnonzero(limit > 0)
        while len(todo):
            apart = self.words[one[todo] + out[todo]] ^ self.words[two[todo] + out[todo]]
            same = np.where(apart == 0, 7, 6 - np.searchsorted(_WORD_STEPS, apart, side="right"))
            out[todo] += same
            todo = todo[(same == 7) & (out[todo] < limit[todo])]
        return np.minimum(out, limit)


def packed_words(symbols: np.ndarray) -> np.ndarray:
    """The seven symbols from each position on as one number; behind the text come zeros."""
    padded = np.concatenate([symbols.astype(np.uint64), np.zeros(7, dtype=np.uint64)])
    words = np.zeros(len(symbols), dtype=np.uint64)
    for at in range(7):
        words = (words << np.uint64(9)) | padded[at : at + len(symbols)]
    return words


def suffix_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array, and ranks by the first 28 symbols, by doubling from 7 symbols on. The last symbol is unique."""
    n = len(words)
    order = np.argsort(words)
    places, keys = np.arange(n), words[order]
    rank = np.empty(n, dtype=np.int64)  # the row where a suffix's class of equals begins
    span, by_28 = 7, None
    while True:
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        rank[order[places]] = np.maximum.accumulate(np.where(fresh, places, 0))
        if span == 28:
            by_28 = rank.copy()
        # Only suffixes that still equal a neighbour are sorted again.
        alone = fresh & np.concatenate([fresh[1:], [True]])
        places = places[~alone]
        if not len(places):
            return order, rank if by_28 is None else by_28
        tied = order[places]
        ahead = tied + span
        behind = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        keys = rank[tied].astype(np.uint64) * np.uint64(n + 1) + behind.astype(np.uint64)
        by_key = np.argsort(keys)
        order[places], keys = tied[by_key], keys[by_key]
        span *= 2


def build_index(contents: np.ndarray, lengths: np.ndarray) -> tuple[RunIndex, np.ndarray, np.ndarray, np.ndarray]:
    """Index of the contents (rows padded to one width); the suffix array and the ranks by 28 symbols of its build,
    and where each content ends.

    Bytes count from 2 on, a 1 closes each content and a 0 the text.
    """
    width = contents.shape[1] + 1
    framed = np.ones((len(contents), width), dtype=np.int16)
    framed[:, :-1] = contents.astype(np.int16) + 2
    inside = np.arange(width) <= lengths[:, None]
    framed[np.arange(len(contents)), lengths] = 1
    symbols = np.append(framed[inside], 0)
    words = packed_words(symbols)
    order, by_28 = suffix_order(words)

    last = symbols[order - 1].astype(np.int64)
    run_starts = _groups(last)
    run_lengths = np.diff(np.append(run_starts, len(last)))
    run_symbols = last[run_starts]
    by_symbol = np.argsort(run_symbols, kind="stable")
    run_heads = np.empty(len(run_starts), dtype=np.int64)
    run_heads[by_symbol] = np.cumsum(run_lengths[by_symbol]) - run_lengths[by_symbol]
    index = RunIndex(
        words,
        run_starts,
        np.repeat(np.arange(len(run_starts)), run_lengths),
        run_symbols,
        run_heads,
        run_lengths,
        order[run_starts],
        order[run_starts + run_lengths - 1],
        by_symbol,
        run_symbols[by_symbol] * len(run_starts) + by_symbol,
    )
    return index, order, by_28, np.cumsum(lengths + 1) - 1


def own_repeats(order: np.ndarray, by_28: np.ndarray, ends: np.ndarray, lengths: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """By content of an index: a bit for each string in it that a content of a smaller document in it also holds."""
    # Neighbours agree on WIDTH symbols if they agree on the first and the last 28 of them.
    later = np.minimum(order + WIDTH - 28, len(order) - 1)
    same = (by_28[order][1:] == by_28[order][:-1]) & (by_28[later][1:] == by_28[later][:-1])
    rows = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
    owner = np.searchsorted(ends, order[rows])
    at = order[rows] - (ends[np.minimum(owner, len(ends) - 1)] - lengths[np.minimum(owner, len(ends) - 1)])
    # A string ends inside its content; neighbours that agree do so together.
    whole = (owner < len(ends)) & (at + WIDTH <= lengths[np.minimum(owner, len(ends) - 1)])
    rows, owner, at = rows[whole], owner[whole], at[whole]
    if not len(rows):
        return np.zeros(len(docs), dtype=np.int64)
    firsts = np.flatnonzero(~np.concatenate([[False], same])[rows])
    least = np.repeat(np.minimum.reduceat(docs[owner], firsts), np.diff(np.append(firsts, len(rows))))
    hit = least < docs[owner]
    # Each place comes once, so that sums of powers of two (below 2 ** 27) are unions.
    return np.bincount(owner[hit], weights=2.0 ** at[hit], minlength=len(docs)).astype(np.int64)


def matching_statistics(
    index: RunIndex, contents: np.ndarray, lengths: np.ndarray, reach: int = 0
) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """Stream the contents backwards through the index, all in lockstep.

    Each step yields the contents that are long enough, how many of their last bytes have been read, and for what
    begins there the longest match in the index and its position. A row whose run has another symbol goes on
    from the next run of the symbol above or below, whichever suffix, as sampled at the end of that run, shares more.
    Matches that begin earlier end no later, so a content whose match ends before byte ``reach`` is given up.
    """
    n_runs = len(index.run_starts)
    nowhere = int(index.first_samples[0])  # row 0: the end of the text
    active = np.arange(len(lengths))
    rows, matched = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    places, left = np.full(len(lengths), nowhere, dtype=np.int64), lengths.astype(np.int64)
    for read in range(1, int(lengths.max()) + 1):
        going = (left > 0) & (left + matched >= reach)
        if not going.all():
            active, rows, matched, places, left = (x[going] for x in (active, rows, matched, places, left))
            if not len(active):
                return
        left = left - 1
        symbol = contents[active, left].astype(np.int64) + 2
        run = index.run_of(rows)
        off = np.flatnonzero(index.run_symbols[run] != symbol)
        below = np.searchsorted(index.symbol_keys, symbol[off] * n_runs + run[off])
        best = np.full(len(off), -1, dtype=np.int64)
        was, limit = places[off], matched[off]  # both ends are weighed against the suffix before the jump
        for spot, sampled, at_end in ((below - 1, index.last_samples, True), (below, index.first_samples, False)):
            other = index.by_symbol[np.clip(spot, 0, n_runs - 1)]
            able = np.flatnonzero((spot >= 0) & (spot < n_runs) & (index.run_symbols[other] == symbol[off]))
            to = other[able]
            share = index.shared(was[able], sampled[to], limit[able])
            better = share > best[able]
            found, to, share = off[able[better]], to[better], share[better]
            best[able[better]] = share
            run[found], rows[found] = to, index.run_starts[to] + (index.run_lengths[to] - 1 if at_end else 0)
            places[found], matched[found] = sampled[to], share
        rows = index.run_heads[run] + rows - index.run_starts[run]
        places, matched = places - 1, matched + 1
        lost = off[best < 0]
        rows[lost], places[lost], matched[lost] = 0, nowhere, 0
        yield active, read, matched, places


def held_strings(index: RunIndex, contents: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """By content: a bit for each string in it that the index holds."""
    bits = np.zeros(len(lengths), dtype=np.int64)
    for active, read, matched, _ in matching_statistics(index, contents, lengths, WIDTH):
        hit = active[matched >= WIDTH]
        bits[hit] |= np.int64(1) << (lengths[hit] - read)
    return bits


def anchor_sides(contents: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Two rows of numbers by content, for its anchor with ``SIDE`` bytes before it and behind it; 0: not so many.

    The anchor stands ``SLIDE`` bytes from the start, or nearer in what opens a text; then its last place up to there
    counts, as each string of the content holds that one too.
    """
    at = np.full(len(lengths), -1)
    for offset in range(SLIDE, -1, -1):
        unknown = np.flatnonzero(at < 0)
        grams = np.ascontiguousarray(contents[unknown, offset : offset + GRAM])
        at[unknown[_row_hashes(grams) == hashes[unknown]]] = offset
    sides = np.zeros((2, len(lengths)), dtype=np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(contents, SIDE, axis=1)
    for side, start in zip(sides, (at - SIDE, at + GRAM)):
        has = np.flatnonzero((at >= 0) & (start >= 0) & (start + SIDE <= lengths))
        keys = _row_hashes(windows[has, start[has]]) ^ (hashes[has] * _MULTIPLIERS[1])
        side[has] = np.unique(keys, return_inverse=True)[1] + 1
    return sides


def _agree(sides: np.ndarray, asking: np.ndarray, others: np.ndarray, least: int) -> np.ndarray:
    """Which of the contents ``asking`` agree on a side with ``least`` of the ``others``."""
    out = np.zeros(len(asking), dtype=bool)
    for side in sides:
        counts = np.bincount(side[others], minlength=int(side.max(initial=0)) + 1)
        counts[0] = 0
        out |= counts[side[asking]] >= least
    return out


def repeated_strings(contents: np.ndarray, lengths: np.ndarray, docs: np.ndarray, sides: np.ndarray | None = None) -> np.ndarray:
    """By content: a bit for each string in it that a content of a smaller document also holds.

    The contents of the smaller half of the documents are indexed, those of the larger documents are streamed
    through it: any match of ``WIDTH`` bytes is a repeat. What still has an unmatched string goes on alike, so
    that all rounds together index and stream each content once or so. With ``sides`` only strings around the same
    anchor count, and contents that agree with no other one on a side have none of them in common.
    """
    bits = np.zeros(len(docs), dtype=np.int64)
    whole = (np.int64(1) << np.maximum(0, lengths - WIDTH + 1)) - 1
    left = np.argsort(docs, kind="stable")
    while len(left):
        if sides is not None:
            left = left[_agree(sides, left, left, 2)]
            if not len(left):
                break
        cut = np.searchsorted(docs[left], docs[left[(len(left) - 1) // 2]], side="right")  # documents stay whole
        held, later = left[:cut], left[cut:]
        index, order, by_28, ends = build_index(contents[held], lengths[held])
        bits[held] |= own_repeats(order, by_28, ends, lengths[held], docs[held])
        streamed = later if sides is None else later[_agree(sides, later, held, 1)]
        if len(streamed):
            bits[streamed] |= held_strings(index, contents[streamed], lengths[streamed])
        left = later[bits[later] != whole[later]]
    return bits


def _snippets(batch: pa.RecordBatch, wanted: Callable[[np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, ...]:
    """Document, anchor hash, base, length and padded bytes of the snippet around each place of the batch.

    ``wanted`` tells by the anchors' hashes which snippets are cut.
    """
    texts = [(value.as_py() or "").encode() for value in batch.column(1)]
    sizes = np.array([len(text) for text in texts], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join([*texts, bytes(SNIPPET)]), dtype=np.uint8)
    owner = pc.list_parent_indices(batch.column(2)).to_numpy()
    at = pc.list_flatten(batch.column(2)).to_numpy().astype(np.int64)
    inside = at + GRAM <= sizes[owner]
    spots = np.unique(starts[owner[inside]] + at[inside])
    hashes = _row_hashes(np.lib.stride_tricks.sliding_window_view(data, GRAM)[spots])
    if wanted is not None:
        some = wanted(hashes)
        spots, hashes = spots[some], hashes[some]
    owner = np.searchsorted(starts + sizes, spots, side="right")
    at = spots - starts[owner]
    bases = np.maximum(0, at - SLIDE)
    lengths = np.minimum(sizes[owner], at + WIDTH) - bases
    rows = np.lib.stride_tricks.sliding_window_view(data, SNIPPET)[starts[owner] + bases]
    short = np.flatnonzero(lengths < SNIPPET)
    rows[short] *= np.arange(SNIPPET) < lengths[short, None]
    # Ids are null in rows without places only.
    ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return ids[owner], hashes, bases, lengths, rows


def _frequent_anchors(placed: DataFrame) -> np.ndarray:
    """Hashes of the anchors that have about ``FREQUENT`` contents or more, from the documents of a sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, hashes, _, lengths, parts = _snippets(batch)
            content = _row_hashes(parts) ^ lengths.astype(np.uint64) ^ (hashes * _MULTIPLIERS[1])
            _, one = np.unique(content, return_index=True)
            anchor, n = np.unique(hashes[one], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(n, pa.int64())], ["anchor", "n"])

    sampled = placed.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0).filter("places is not null")
    counted = sampled.mapInArrow(count, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n"))
    rows = counted.filter(F.col("n") * SAMPLE >= FREQUENT).select("anchor").collect()
    return np.array(sorted(r.anchor for r in rows), dtype=np.int64).view(np.uint64)


def _frequent_marks(placed: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``doc_id, base, bits`` for the strings of frequent anchors, by the least document of each string.

    Of the copies of a string in a batch only those of the least document ask; the others are known repeats.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, _, bases, lengths, parts = _snippets(batch, lambda hashes: np.isin(hashes, frequent))
            if not len(ids):
                continue
            which, shifts, ones, twos = [], [], [], []
            for n in range(SLIDE + 1):
                long = np.flatnonzero(lengths >= WIDTH + n)
                strings = np.ascontiguousarray(parts[long, n : n + WIDTH])
                which.append(long)
                shifts.append(np.full(len(long), n))
                ones.append(_row_hashes(strings))
                twos.append(_row_hashes(strings[:, ::-1]))
            which, shifts, ones, twos = (np.concatenate(x) for x in (which, shifts, ones, twos))
            order = np.lexsort((ids[which], twos, ones))
            which, shifts, ones, twos = which[order], shifts[order], ones[order], twos[order]
            fresh = np.concatenate([[True], (ones[1:] != ones[:-1]) | (twos[1:] != twos[:-1])])
            first = ids[which][np.maximum.accumulate(np.where(fresh, np.arange(len(which)), 0))]
            known = ids[which] > first
            bits = np.zeros(len(ids), dtype=np.int64)
            np.bitwise_or.at(bits, which[known], np.int64(1) << shifts[known])
            marked, asks = np.flatnonzero(bits), np.flatnonzero(~known)
            # Known marks take along keys of their own, which spread them.
            own = np.stack([ids[marked], bases[marked]], axis=1).astype("<i8").view(np.uint8)
            columns = (
                np.concatenate([ones[asks], _row_hashes(own)]).view(np.int64),
                np.concatenate([twos[asks], _row_hashes(own[:, ::-1])]).view(np.int64),
                np.concatenate([ids[which[asks]], ids[marked]]),
                np.concatenate([bases[which[asks]], bases[marked]]).astype(np.int32),
                np.concatenate([np.int64(1) << shifts[asks], bits[marked]]),
                np.arange(len(asks) + len(marked)) >= len(asks),
            )
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["h1", "h2", "doc_id", "base", "bits", "known"])

    asked = placed.mapInArrow(ask, "h1 bigint, h2 bigint, doc_id bigint, base int, bits bigint, known boolean")
    # A key has a row or so for each batch.
    least = F.min("doc_id").over(Window.partitionBy("h1", "h2", "known"))
    return asked.withColumn("least", least).filter("known or doc_id > least").select("doc_id", "base", "bits")


def _packed_snippets(placed: DataFrame, buckets: int, frequent: np.ndarray) -> DataFrame:
    """``bucket, hashes, docs, bases, lengths, bytes``: packed snippets; in buckets below 0 the marks known already.

    Those of frequent anchors are left out.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids, hashes, bases, lengths, parts = _snippets(batch, lambda hashes: ~np.isin(hashes, frequent))
            if not len(ids):
                continue
            content = _row_hashes(parts) ^ lengths.astype(np.uint64) ^ (hashes * _MULTIPLIERS[1])
            order, group, first, last = _least_of(content, ids)
            known = ids[order] > first[group]
            out = [[], [], [], [], [], []]

            def emit(number: int, where: np.ndarray, with_bytes: bool) -> None:
                out[0].append(number)
                out[1].append(hashes[where].astype("<u8").tobytes() if with_bytes else b"")
                out[2].append(ids[where].astype("<i8").tobytes())
                out[3].append(bases[where].astype("<u4").tobytes())
                out[4].append(lengths[where].astype(np.uint8).tobytes())
                out[5].append(packer.compress(parts[where].tobytes()) if with_bytes else b"")

            asking = order[~known]
            # By bucket, then by anchor: snippets that differ little stand side by side and pack well.
            asking = asking[np.argsort(hashes[asking])]
            bucket = _bucket(hashes[asking] >> np.uint64(20), buckets)
            by_bucket = np.argsort(bucket, kind="stable")
            asking = asking[by_bucket]
            cuts = _groups(bucket[by_bucket])
            for part in np.split(asking, cuts[1:]):
                emit(int((hashes[part[0]] >> np.uint64(20)) % np.uint64(buckets)), part, True)
            if known.any():
                emit(-1 - int(hashes[order[0]] % np.uint64(buckets)), order[known], False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])],
                ["bucket", "hashes", "docs", "bases", "lengths", "bytes"],
            )

    return placed.mapInArrow(
        pack, "bucket int, hashes binary, docs binary, bases binary, lengths binary, bytes binary"
    )


def _row_hashes(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of bytes, a few thousand rows at a time."""
    out = np.empty(len(rows), dtype=np.uint64)
    for first in range(0, len(rows), 1 << 12):
        part = rows[first : first + (1 << 12)]
        wide = np.zeros((len(part), -(-rows.shape[1] // 8) * 8), dtype=np.uint8)
        wide[:, : rows.shape[1]] = part
        h = np.full(len(part), _MULTIPLIERS[3], dtype=np.uint64)
        for word in wide.view("<u8").T:
            h = (h ^ word) * _MULTIPLIERS[0]
            h ^= h >> np.uint64(29)
        out[first : first + (1 << 12)] = (h * _MULTIPLIERS[2]) ^ (h >> np.uint64(32))
    return out


def _marks(packed: DataFrame) -> DataFrame:
    """``doc_id, base, bits``: bit n stands for the repeated string that starts n bytes after ``base``."""

    def index(table: pa.Table) -> pa.Table:
        ids, bases, lengths = (
            np.frombuffer(b"".join(table[name].to_pylist()), dtype=kind).astype(np.int64)
            for name, kind in (("docs", "<i8"), ("bases", "<u4"), ("lengths", np.uint8))
        )
        whole = (np.int64(1) << np.maximum(0, lengths - WIDTH + 1)) - 1
        if table["bucket"][0].as_py() < 0:
            bits = whole
        else:
            hashes = np.frombuffer(b"".join(table["hashes"].to_pylist()), dtype="<u8")
            unpacked = b"".join(map(zstandard.ZstdDecompressor().decompress, table["bytes"].to_pylist()))
            parts = np.frombuffer(unpacked, dtype=np.uint8).reshape(-1, SNIPPET)
            content = _row_hashes(parts) ^ lengths.astype(np.uint64) ^ (hashes * _MULTIPLIERS[1])
            order, group, first, _ = _least_of(content, ids)
            ids, bases, lengths, whole = ids[order], bases[order], lengths[order], whole[order]
            starts = _groups(content[order])
            of_content = hashes[order][starts]
            # An anchor with one content has no other strings to compare it with.
            _, number, counts = np.unique(of_content, return_inverse=True, return_counts=True)
            several = np.flatnonzero((counts[number] > 1) & (lengths[starts] >= WIDTH))
            own = np.zeros(len(starts), dtype=np.int64)
            if len(several):
                contents, sizes = parts[order[starts[several]]], lengths[starts][several]
                sides = anchor_sides(contents, sizes, of_content[several])
                own[several] = repeated_strings(contents, sizes, first[several], sides)
            bits = np.where(ids > first[group], whole, own[group])
        some = bits != 0
        return pa.table(
            [pa.array(ids[some]), pa.array(bases[some], pa.int32()), pa.array(bits[some])], ["doc_id", "base", "bits"]
        )

    return packed.groupBy("bucket").applyInArrow(index, "doc_id bigint, base int, bits bigint")


def cut_texts(texts: list[bytes], which: np.ndarray, bases: np.ndarray, bits: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """What is left of each text, the bytes removed and their runs; ``which`` names the text of each mark."""
    lengths = np.array([len(text) for text in texts], dtype=np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    begins = np.zeros(len(data) + WIDTH - 1, dtype=bool)  # shifted by the pad that the sliding window needs
    for n in range(SLIDE + 1):
        some = ((bits >> n) & 1 == 1) & (bases + n + WIDTH <= lengths[which])
        begins[starts[which[some]] + bases[some] + (n + WIDTH - 1)] = True
    # Strings end inside their texts, so no cover reaches the next text.
    gone = _sliding(begins, WIDTH, np.logical_or)
    edges = gone & ~np.concatenate([[False], gone[:-1]])
    full = starts[lengths > 0]
    edges[full] = gone[full]  # a run that opens a text is its own, also behind a text cut at its end
    runs = np.bincount(np.searchsorted(ends, np.flatnonzero(edges), side="right"), minlength=len(texts))
    removed = np.bincount(np.searchsorted(ends, np.flatnonzero(gone), side="right"), minlength=len(texts))
    kept = data[~gone].tobytes()
    stops = np.cumsum(lengths - removed)
    return [kept[a:b] for a, b in zip(stops - lengths + removed, stops)], removed, runs


def _numbered(read: DataFrame) -> DataFrame:
    """``id, number`` of the ids that are no integers, numbered in their order: a range-partitioned sort, written."""
    ids = read.filter("id is not null").select("id").distinct().orderBy("id")
    return stage(ids.select("id", F.monotonically_increasing_id().alias("number")), "ids")


def dedup_strings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes) of every document; ids keep their type."""
    given = docs.select(docs[doc_id].alias("id"), docs[text].alias("text"))
    kind = given.schema["id"].dataType
    if isinstance(kind, IntegralType):
        cleaned = _dedup_strings(given.select(F.col("id").cast("bigint").alias("doc_id"), "text"))
        return cleaned.withColumn("doc_id", F.col("doc_id").cast(kind))
    numbers = _numbered(given)
    cleaned = _dedup_strings(given.join(numbers, "id", "left").select(F.col("number").alias("doc_id"), "text"))
    named = cleaned.join(numbers, cleaned["doc_id"] == numbers["number"], "left")
    return named.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def _dedup_strings(read: DataFrame) -> DataFrame:
    """The work on ``doc_id bigint, text``."""
    ship_code(read.sparkSession)
    able = read.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= WIDTH))
    total = able.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))).first()[0]
    buckets = max(64, -(-total // BUCKET_BYTES))
    shared = stage(_shared_places(_packed_anchors(able, buckets)), "places")
    by_doc = shared.groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    # Both joins of the texts are left joins of the same columns in one query: they share one exchange.
    placed = read.join(by_doc, "doc_id", "left").select("doc_id", "text", "places")
    # Fewer bytes hold no frequent anchor.
    frequent = _frequent_anchors(placed) if total >= FREQUENT else np.empty(0, dtype=np.uint64)
    marks = _marks(_packed_snippets(placed, buckets, frequent))
    if len(frequent):
        marks = marks.unionByName(_frequent_marks(placed, frequent))
    marked = marks.groupBy("doc_id").agg(F.collect_list(F.struct("base", "bits")).alias("marks"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(value.as_py() or "").encode() for value in batch.column(1)]
            kept, removed, runs = list(texts), np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
            owner = pc.list_parent_indices(batch.column(2)).to_numpy()
            found = pc.list_flatten(batch.column(2))
            bases, bits = (found.field(name).to_numpy().astype(np.int64) for name in ("base", "bits"))
            marked = np.unique(owner)
            # Texts are cut together in groups of about CHUNK bytes.
            sizes = np.cumsum([len(texts[row]) for row in marked]) // CHUNK
            for rows in np.split(marked, _groups(sizes)[1:]) if len(marked) else []:
                first, last = np.searchsorted(owner, [rows[0], rows[-1] + 1])
                which = np.searchsorted(rows, owner[first:last])
                left, removed[rows], runs[rows] = cut_texts([texts[r] for r in rows], which, bases[first:last], bits[first:last])
                for row, text in zip(rows, left):
                    kept[row] = text
            columns = [pa.array([len(text) for text in texts], pa.int64()), pa.array(removed), pa.array(runs), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return read.join(marked, "doc_id", "left").select("doc_id", "text", "marks").mapInArrow(
        remove, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )

