"""Best-fit packing by bin completion.

Texts become token pieces of at most ``capacity``; packing them needs only how many pieces have each
length, a table of at most ``capacity`` counts whatever the size of the corpus. Bin completion works on it:
it takes the largest piece left, enumerates the undominated fillings of what its sequence has free, and
tries them from the least waste on, depth first. Best-fit completions give the incumbent, and a branch is
cut when the waste it has spent shows that it cannot need fewer sequences. A filling is applied as often as
the counts allow, so the plan holds far fewer rows than there are sequences. While the incumbent is above the
lower bound, sequences with waste are reopened together with full ones and completed anew, as long as that goes
on saving sequences. ``gap`` tells how many sequences the plan may be above the optimum.

The pieces are then numbered within their length, in salted buckets, and each number is looked up in the
plan: a distributed join on the length. A length that holds a third of all pieces is spread over its buckets.

Defined results: a null text is empty and gives one piece, the closing id; texts are cut only above
``capacity``; repeated rows and null ids are packed like others; other columns are ignored; an empty table
gives an empty result. The plan is deterministic; which of equal pieces takes which place may be any.
"""

from __future__ import annotations

import random
import struct
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.pieces import WorkerCache, load
from tripmill.llm.shared import partitions, ship_code, stage

#: Search bounds: fillings enumerated for a largest piece, decisions of the first incumbent that are
#: reopened, and nodes visited then.
FILLINGS, REOPENED, NODES = 16, 200, 2000
#: Fillings completed anew together, rounds of that without a sequence saved after which it ends, and all rounds.
MIXED, STALLED, ROUNDS = 12, 4000, 50_000

_CACHES: dict[str, WorkerCache] = {}


def token_pieces(docs: DataFrame, path: str, capacity: int, closing_id: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every text's ids with the closing id, cut at ``capacity``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        if path not in _CACHES:
            pack = lambda ids: struct.pack(f"<{len(ids)}I", *ids)
            _CACHES[path] = WorkerCache({}, lambda piece: pack(tokenizer.piece_ids(piece)))
        ids_of, closing = _CACHES[path].__getitem__, struct.pack("<I", closing_id)
        for batch in batches:
            rows, numbers, starts, lengths, sums = [], [], [], [], []
            for row, value in enumerate(batch.column(1)):
                value = value.as_py() or ""
                pieces = tokenizer.pieces(value)
                if pieces is None:
                    ids = tokenizer.text_ids(value)
                    data = struct.pack(f"<{len(ids)}I", *ids) + closing
                else:
                    data = b"".join(map(ids_of, pieces)) + closing
                for number, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    rows.append(row)
                    numbers.append(number)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int32())),
                    pa.array(numbers, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(cut, f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing over counts: equal sequences are filled together, so the work is by size."""
    open_bins: dict[int, list[tuple[dict[int, int], int]]] = {}  # room -> fillings and their uses
    rooms: list[int] = []

    def put(filling: dict[int, int], times: int) -> None:
        room = capacity - sum(size * copies for size, copies in filling.items())
        if room not in open_bins:
            open_bins[room] = []
            insort(rooms, room)
        open_bins[room].append((filling, times))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                each = capacity // size
                if left // each:
                    put({size: each}, left // each)
                if left % each:
                    put({size: left % each}, 1)
                break
            room = rooms[at]
            filling, times = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[at]
            # The tightest sequences stay the tightest until they are full.
            each = min(room // size, left)
            used = min(times, left // each)
            if used < times:
                put(filling, times - used)
            put(filling | {size: filling.get(size, 0) + each}, used)
            left -= each * used
    plan = [entry for entries in open_bins.values() for entry in entries]
    return sorted(plan, key=lambda entry: sorted(entry[0], reverse=True), reverse=True)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any plan needs: by their tokens; by how many pieces of a size or more fit in one; and, as
    pieces over half a sequence stand apart, by those of ``least`` or more that do not fit beside them."""
    best, pieces = -(-sum(size * n for size, n in counts.items()) // capacity), 0
    for size in sorted(counts, reverse=True):
        pieces += counts[size]
        best = max(best, -(-pieces // (capacity // size)))
    for least in {0, *(size for size in counts if 2 * size <= capacity)}:
        alone = beside = free = middle = 0
        for size, n in counts.items():
            if size > capacity - least:
                alone += n
            elif 2 * size > capacity:
                beside += n
                free += (capacity - size) * n
            elif size >= least:
                middle += size * n
        best = max(best, alone + beside + max(0, -(-(middle - free) // capacity)))
    return best


def tightest(room: int, left: dict[int, int], order: Callable[[Iterable[int]], list[int]] = sorted) -> dict[int, int]:
    """A filling of ``room`` with the least waste there is; the last pieces of the order first. Sums are sets of bits."""
    reach, sizes = [1], [size for size in order(left) if size <= room]
    mask = (1 << (room + 1)) - 1
    for size in sizes:
        sums, copies, part = reach[-1], min(left[size], room // size), 1
        while copies:
            step = min(part, copies)
            sums |= sums << (step * size) & mask
            copies, part = copies - step, part * 2
        reach.append(sums)
    target, chosen = reach[-1].bit_length() - 1, {}
    for at in range(len(sizes) - 1, -1, -1):
        size = sizes[at]
        for copies in range(min(left[size], target // size), -1, -1):
            if reach[at] >> (target - copies * size) & 1:
                break
        if copies:
            chosen[size] = copies
            target -= copies * size
    return chosen


def fillings(room: int, sizes: list[int], left: dict[int, int]) -> list[dict[int, int]]:
    """Undominated fillings (size → copies) of ``room``, least waste first; ``sizes`` ascend.

    A filling is dominated if a piece it leaves out fits in its waste, or if a larger piece could take the
    place of one it holds. Larger sizes and more copies come first, so the first one is the best fit's.
    """
    found: dict[tuple[tuple[int, int], ...], int] = {}
    steps = 0

    def dominated(chosen: tuple[tuple[int, int], ...], waste: int) -> bool:
        if not waste:
            return False
        copies = dict(chosen)
        free = lambda size: left[size] > copies.get(size, 0)
        if any(free(size) for size in sizes[: bisect_right(sizes, waste)]):
            return True
        return any(
            free(size) for c in copies for size in sizes[bisect_right(sizes, c) : bisect_right(sizes, c + waste)]
        )

    def grow(top: int, chosen: tuple[tuple[int, int], ...], space: int) -> None:
        nonlocal steps
        steps += 1
        top = min(top, bisect_right(sizes, space))
        for at in range(top - 1, -1, -1):
            size = sizes[at]
            for copies in range(min(left[size], space // size), 0, -1):
                if len(found) >= FILLINGS or steps >= 8 * FILLINGS:
                    return
                grow(at, (*chosen, (size, copies)), space - size * copies)
        if (not found or not dominated(chosen, space)) and chosen not in found:
            found[chosen] = space

    grow(len(sizes), (), room)
    return [dict(chosen) for chosen, _ in sorted(found.items(), key=lambda kv: (kv[1], len(kv[0])))]


def mixed(plan: list[tuple[dict[int, int], int]], capacity: int, bound: int) -> list[tuple[dict[int, int], int]]:
    """The plan with fewer sequences, where completing some of them anew saves any.

    A round opens one sequence each of a few fillings, half of them with waste, and completes the largest piece
    left as tightly as can be, of equal fillings a random one. The outcome counts if it needs no more sequences
    and gathers the waste in fewer of them; it is applied as often as the rarest of the fillings is used, so rounds
    follow the fillings, not the corpus. Draws are seeded: the plan is the same every time.
    """
    draw, uses = random.Random(0), Counter()
    for chosen, times in plan:
        uses[tuple(sorted(chosen.items()))] += times
    room = {key: capacity - sum(size * copies for size, copies in key) for key in uses}
    keys = list(uses)
    wasteful = [key for key in keys if room[key]]
    total, idle, rounds = sum(uses.values()), 0, 0

    def drop(key: tuple, from_list: list) -> None:
        at = from_list.index(key)
        from_list[at] = from_list[-1]
        from_list.pop()

    def shuffled(sizes: Iterable[int]) -> list[int]:
        out = sorted(sizes)
        draw.shuffle(out)
        return out

    while total > bound and idle < STALLED and rounds < ROUNDS:
        idle, rounds = idle + 1, rounds + 1
        opened = set(draw.sample(wasteful, min(MIXED // 2, len(wasteful))))
        opened.update(draw.sample(keys, min(MIXED - len(opened), len(keys))))
        opened = sorted(opened)
        left = Counter()
        for key in opened:
            left.update(dict(key))
        closed = []
        while left and len(closed) < len(opened):
            head = max(left)
            left[head] -= 1
            left = +left
            chosen = tightest(capacity - head, left, shuffled)
            left -= Counter(chosen)
            chosen[head] = chosen.get(head, 0) + 1
            closed.append(tuple(sorted(chosen.items())))
        rooms = [capacity - sum(size * copies for size, copies in key) for key in closed]
        if left or (len(closed) == len(opened) and sum(r * r for r in rooms) < sum(room[key] ** 2 for key in opened)):
            continue
        times = min(uses[key] for key in opened)
        for key in opened:
            uses[key] -= times
            if not uses[key]:
                del uses[key]
                drop(key, keys)
                if room[key]:
                    drop(key, wasteful)
        for key, free in zip(closed, rooms):
            if key not in uses:
                keys.append(key)
                room[key] = free
                if free:
                    wasteful.append(key)
            uses[key] += times
        if len(closed) < len(opened):
            total, idle = total - times * (len(opened) - len(closed)), 0
    return [(dict(key), uses[key]) for key in sorted(uses, reverse=True)]


def bin_completion(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Fillings of whole sequences (size → copies) and how often each is used."""
    start = {size: n for size, n in counts.items() if n > 0}
    total = sum(size * n for size, n in start.items())
    bound = lower_bound(start, capacity)

    def options(state: dict[int, int]) -> Iterator[tuple[dict[int, int], int, int]]:
        """Each completion of the largest piece: the filling, its uses, its waste."""
        head = max(state)
        rest = {size: n - (size == head) for size, n in state.items() if n > (size == head)}
        best = tightest(capacity - head, rest)
        for filling in [best, *(x for x in fillings(capacity - head, sorted(rest), rest) if x != best)]:
            chosen = filling | {head: filling.get(head, 0) + 1}
            times = min(state[size] // copies for size, copies in chosen.items())
            yield chosen, times, (capacity - sum(size * copies for size, copies in chosen.items())) * times

    def without(state: dict[int, int], chosen: dict[int, int], times: int) -> dict[int, int]:
        return {size: n for size, m in state.items() if (n := m - times * chosen.get(size, 0))}

    def used(plan: list[tuple[dict[int, int], int]]) -> int:
        return sum(times for _, times in plan)

    waste = lambda chosen: capacity - sum(size * copies for size, copies in chosen.items())
    plain = [(chosen, times, waste(chosen) * times) for chosen, times in best_fit(start, capacity)]
    incumbent, state = [], dict(start)
    if sum(times for _, times, _ in plain) > bound:  # else nothing can be better
        while state:
            chosen, times, lost = next(options(state))
            incumbent.append((chosen, times, lost))
            state = without(state, chosen, times)
    if not incumbent or sum(x[1] for x in plain) <= sum(x[1] for x in incumbent):
        incumbent, state = plain, {}

    # Branches reopen from the incumbent's last decisions backwards, as depth-first search would.
    stack, spent = [], sum(lost for *_, lost in incumbent)
    plan = [(chosen, times) for chosen, times, _ in incumbent]
    for at in range(len(incumbent) - 1, max(-1, len(incumbent) - 1 - REOPENED), -1):
        chosen, times, lost = incumbent[at]
        for size, copies in chosen.items():
            state[size] = state.get(size, 0) + times * copies
        spent -= lost
        stack.append((dict(state), plan[:at], spent))
    stack.reverse()
    incumbent, nodes = plan, 0
    while stack and nodes < NODES and used(incumbent) > bound:
        state, plan, waste = stack.pop()
        allowed = (used(incumbent) - 1) * capacity - total  # waste that still beats the incumbent
        if waste > allowed:
            continue
        if not state:
            incumbent = plan
            continue
        nodes += 1
        branches = [x for x in options(state) if waste + x[2] <= allowed]
        for chosen, times, lost in reversed(branches):
            stack.append((without(state, chosen, times), [*plan, (chosen, times)], waste + lost))
    return mixed(incumbent, capacity, bound) if used(incumbent) > bound else incumbent


def _plan_rows(plan: list[tuple[dict[int, int], int]]) -> tuple[list[tuple[int, int]], list[tuple[int, ...]]]:
    """Two tables: (length, span), and (length, chunk, first, last, sequence, times, offset).

    The second has a row for each size of a filling, whose copies are numbered one run of ``times`` after the
    other. Numbers are cut into chunks of ``span``, the mean run of a length, so that a piece meets a few rows
    of its chunk whatever the length of the plan.
    """
    runs, numbered, sequence = {}, {}, 0
    for chosen, times in plan:
        offset = 0
        for size, copies in sorted(chosen.items(), reverse=True):
            first = numbered.get(size, 0)
            numbered[size] = first + times * copies
            runs.setdefault(size, []).append((first, numbered[size] - 1, sequence, times, offset))
            offset += size * copies
        sequence += times
    spans = {size: -(-numbered[size] // len(own)) for size, own in runs.items()}
    rows = [
        (size, chunk, *run)
        for size, own in runs.items()
        for run in own
        for chunk in range(run[0] // spans[size], run[1] // spans[size] + 1)
    ]
    return list(spans.items()), rows


def pack(
    docs: DataFrame, path: str, capacity: int = 2048, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset, gap`` of every piece; ``gap``: sequences of
    the whole plan above its lower bound."""
    spark = docs.sparkSession
    ship_code(spark)
    read = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    pieces = stage(token_pieces(read, path, capacity), "pieces")
    salted = pieces.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(4 * partitions(spark))).cast("int")
    )
    # One row a length and bucket: bounded by the parameters.
    sizes = salted.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    offsets = sizes.select(
        "length",
        "bucket",
        (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"),
    )
    counts = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    fills = bin_completion(counts, capacity)
    gap = sum(times for _, times in fills) - lower_bound(counts, capacity)
    spans, rows = _plan_rows(fills)
    plan = spark.createDataFrame(
        rows, "length bigint, chunk bigint, first bigint, last bigint, sequence bigint, times bigint, offset bigint"
    )
    offsets = offsets.join(F.broadcast(spark.createDataFrame(spans, "length bigint, span bigint")), "length")
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = (
        salted.join(offsets, ["length", "bucket"])
        .withColumn("number", F.col("before") + F.row_number().over(inside) - 1)
        .withColumn("chunk", F.floor(F.col("number") / F.col("span")))
    )
    place = F.col("number") - F.col("first")
    # The plan has at most two rows for each size of each filling: a few for each possible length.
    return (
        numbered.join(F.broadcast(plan), ["length", "chunk"])
        .filter((F.col("number") >= F.col("first")) & (F.col("number") <= F.col("last")))
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("sequence") + place % F.col("times")).alias("sequence_id"),
            (F.col("offset") + F.floor(place / F.col("times")) * F.col("length")).alias("offset"),
            F.lit(gap).cast("bigint").alias("gap"),
        )
    )
