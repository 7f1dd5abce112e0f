"""Packing: pieces are the library's ids, sequences are gapless and full, small cases are optimal."""

import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tripmill.llm.packing import _plan_rows, best_fit, bin_completion, lower_bound, mixed, pack, tightest
from tripmill.llm.pieces import load

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def check(rows, out, capacity):
    library = Tokenizer.from_file(WORD_BPE)
    want = []
    for (i, t), e in zip(rows, library.encode_batch([t or "" for _, t in rows], add_special_tokens=False)):
        ids = np.array([*e.ids, 0], dtype="<u4")
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want.append((i, n, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(want, key=repr) == sorted(
        ((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=repr
    )
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), -(-sum(r.length for r in out) // capacity)


def test_pack(edges, edge_docs, small_docs):
    used, bound = check(edges, pack(edge_docs, WORD_BPE).collect(), 2048)
    assert used <= bound + 1
    used, bound = check(small_docs[0], pack(small_docs[1], WORD_BPE).collect(), 2048)
    assert used <= bound + 1


def test_pack_repeated_rows_and_null_ids(spark):
    rows = [(1, "same text")] * 40 + [(None, None)] * 3
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert check(rows, pack(frame, WORD_BPE, capacity=8).collect(), 8)[0] == 20  # two of three ids fit


def test_pack_empty(empty_docs):
    assert pack(empty_docs, WORD_BPE).collect() == []


def least_bins(items, capacity):
    best = len(items)

    def place(n, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if n == len(items):
            best = len(bins)
            return
        for b in sorted(set(bins)):
            if b + items[n] <= capacity:
                rest = list(bins)
                rest.remove(b)
                place(n + 1, [*rest, b + items[n]])
        place(n + 1, [*bins, items[n]])

    items = sorted(items, reverse=True)
    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(40))
def test_bin_completion_is_optimal_on_small_cases(seed):
    random.seed(seed)
    items = [random.randint(5, 60) for _ in range(random.randint(1, 12))]
    plan = bin_completion(Counter(items), 100)
    packed = Counter()
    for chosen, times in plan:
        assert sum(size * copies for size, copies in chosen.items()) <= 100
        for size, copies in chosen.items():
            packed[size] += copies * times
    assert packed == Counter(items)
    assert sum(times for _, times in plan) == least_bins(items, 100)


def test_bin_completion_on_hot_and_tiny_sizes():
    assert sum(t for _, t in bin_completion({1: 10**9}, 2048)) == -(-(10**9) // 2048)
    assert sum(t for _, t in bin_completion({2048: 10**6, 1024: 3, 1: 1024}, 2048)) == 10**6 + 2
    assert bin_completion({}, 2048) == []


def plain_best_fit(items, capacity):
    rooms = []
    for size in sorted(items, reverse=True):
        at = bisect_left(rooms, size)
        room = rooms.pop(at) if at < len(rooms) else capacity
        insort(rooms, room - size)
    return len(rooms)


def split_bins(rng, bins, parts, capacity, least):
    """Sequences cut at random into full parts: the optimum is known."""
    out = []
    for _ in range(bins):
        while True:
            cuts = sorted(rng.sample(range(1, capacity), parts - 1))
            sizes = [b - a for a, b in zip([0, *cuts], [*cuts, capacity])]
            if min(sizes) >= least:
                break
        out += sizes
    return out


HARD = {
    "between 600 and 1100": (lambda r: [r.randint(600, 1100) for _ in range(20_000)], 9050),
    "triplets": (lambda r: split_bins(r, 400, 3, 2048, 400), 402),
    "quadruples": (lambda r: split_bins(r, 500, 4, 2048, 200), 502),
    "any size": (lambda r: [r.randint(1, 2048) for _ in range(10_000)], 4960),
}


@pytest.mark.parametrize("kind", HARD)
def test_never_worse_than_best_fit_decreasing(kind):
    make, most = HARD[kind]
    items = make(random.Random(kind))
    plan = bin_completion(Counter(items), 2048)
    packed = Counter()
    for chosen, times in plan:
        assert sum(size * copies for size, copies in chosen.items()) <= 2048
        for size, copies in chosen.items():
            packed[size] += copies * times
    used = sum(times for _, times in plan)
    assert packed == Counter(items) and used <= plain_best_fit(items, 2048)
    assert most is None or used <= most


@pytest.mark.parametrize("seed", range(40))
def test_lower_bound_is_none_too_high(seed):
    rng = random.Random(seed)
    items = [rng.randint(5, 95) for _ in range(rng.randint(1, 11))]
    assert -(-sum(items) // 100) <= lower_bound(Counter(items), 100) <= least_bins(items, 100)


def test_lower_bound_of_pieces_that_stand_apart():
    # Pieces of 1000 do not fit beside those of 1100, pieces of 900 do.
    assert lower_bound({1100: 50, 1000: 10}, 2048) == 55 and lower_bound({1100: 50, 900: 10}, 2048) == 50
    assert lower_bound({}, 2048) == 0 and lower_bound({1: 10**9}, 2048) == -(-(10**9) // 2048)


def test_mixing_follows_the_fillings_not_the_corpus():
    """A wasteful plan of millions of sequences is mended whole; no piece is lost."""
    items, many = split_bins(random.Random(1), 30, 3, 2048, 400), 10**6
    plan = [(chosen, times * many) for chosen, times in best_fit(Counter(items), 2048)]
    counts = {size: n * many for size, n in Counter(items).items()}
    better = mixed(plan, 2048, lower_bound(counts, 2048))
    packed = Counter()
    for chosen, times in better:
        assert times > 0 and sum(size * copies for size, copies in chosen.items()) <= 2048
        for size, copies in chosen.items():
            packed[size] += copies * times
    assert packed == counts and sum(t for _, t in better) < sum(t for _, t in plan)
    assert better == mixed(plan, 2048, lower_bound(counts, 2048))


def test_gap_is_told(spark):
    rows = [(n, "same text") for n in range(40)]
    out = pack(spark.createDataFrame(rows, "doc_id bigint, text string"), WORD_BPE, capacity=8).collect()
    assert {r.gap for r in out} == {0} and len({r.sequence_id for r in out}) == 20


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_by_counts_is_best_fit(seed):
    rng = random.Random(seed)
    items = [rng.choice([3, 7, 11, 20, 33, 40, 51, 64, 90]) for _ in range(rng.randint(1, 300))]
    plan = best_fit(Counter(items), 100)
    packed = Counter()
    for chosen, times in plan:
        for size, copies in chosen.items():
            packed[size] += copies * times
    assert packed == Counter(items) and sum(t for _, t in plan) == plain_best_fit(items, 100)


def test_tightest_filling_wastes_least():
    rng = random.Random(2)
    for _ in range(200):
        left = {rng.randint(2, 30): rng.randint(1, 3) for _ in range(4)}
        room = rng.randint(1, 60)
        sums = {0}
        for size, copies in left.items():
            sums = {s + k * size for s in sums for k in range(copies + 1) if s + k * size <= room}
        chosen = tightest(room, left)
        assert sum(s * k for s, k in chosen.items()) == max(sums) and all(k <= left[s] for s, k in chosen.items())


def test_plan_rows_of_many_tiny_pieces():
    plan = bin_completion({1: 10**8, 700: 3000, 900: 2000, 1300: 500}, 2048)
    spans, rows = _plan_rows(plan)
    assert len(rows) <= 2 * sum(len(chosen) for chosen, _ in plan) + len(spans)
    per_chunk = Counter((length, chunk) for length, chunk, *_ in rows)
    assert max(per_chunk.values()) <= len(plan)


def test_every_plain_character(spark):
    library = Tokenizer.from_file(WORD_BPE)
    for code in range(0x300):
        for text in (f"a{chr(code)}b", f"{chr(code)} {chr(code)}{chr(code)}"):
            pieces = load(WORD_BPE).pieces(text)
            if pieces is not None:
                ids = [i for piece in pieces for i in load(WORD_BPE).piece_ids(piece)]
                assert ids == library.encode(text, add_special_tokens=False).ids, hex(code)
    rows = [(n, f"a{chr(c)}b") for n, c in enumerate((0x23A, 0x23E, 0x130))]
    check(rows, pack(spark.createDataFrame(rows, "doc_id bigint, text string"), WORD_BPE).collect(), 2048)
