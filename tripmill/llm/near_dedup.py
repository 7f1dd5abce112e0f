"""MinHash near-dedup with sequential Bayesian verification.

1. A scan turns each text into its set of word shingles: the set's size, a 128-bit digest and a MinHash
   signature. Texts with equal sets form a class; only its smallest id goes on, so copies cost one row each.
2. Bands of the signature are bucket keys. Their rows follow from the threshold: as many as leave a pair
   at the threshold without a shared band with a chance of ``UNBANDED`` at most (6 at 0.85, 5 at 0.8).
3. Candidates are pairs with the bucket's hub (the member with most bucket mates). Their signatures are
   compared batch by batch, and a pair is dropped as soon as the posterior chance that its similarity
   reaches the threshold is below ``MISS``. Survivors are verified on their full sets.
4. Links are contracted to stars, alternating around large and small neighbours. A bucket whose members
   are one component is done, so a group of copies stays linear in its size. In the others, pairs across
   components follow: in small buckets by a join, in large ones inside tasks, where the members outside the
   bucket's largest component are held against all. There the texts are at hand, survivors are measured at
   once, the likeliest first, and two components that got a link need no other; so a cloud of texts around the
   threshold gives a task work, but no more rows than it has members and stragglers, block by block.

Nothing is collected but counts. Hot classes are reduced before they are shuffled, and joins back to them
have exchanges on both sides, which adaptive execution splits. Only the result stays on disk: signatures, texts and
what else is staged go when it is written.

Defined results: texts without words have the empty set and are linked with nothing; texts with fewer
words than a shingle are one shingle; repeated rows are copies of each other; a row with a null id is
never linked and has a null component; an id with several texts is linked by each of them, whose sets the
greatest text in order stands for when it is verified; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.pieces import WorkerCache
from tripmill.llm.shared import ship_code, stage
from tripmill.sources.workspace import Workspace

#: Hash functions, and the chance that a pair at the threshold shares no band.
HASHES, UNBANDED = 192, 1e-6
#: Signature rows compared at a time, and the chance of a link below which a pair is dropped.
BATCH, MISS = 32, 1e-7
#: Buckets up to this size are joined with themselves; larger ones are dealt to cells, with blocks of at most so many
#: members and shingles. Hash functions for what the signature leaves open there.
SMALL, BLOCK, BLOCK_SHINGLES, DEEP = 16, 4096, 1 << 21, 1024
_BLANK = b" \t\n\x0b\x0c\r"
_TO_SPACE = bytes.maketrans(_BLANK, b" " * len(_BLANK))
_SEEDS = np.random.default_rng(20).integers(1, 1 << 63, size=(2, HASHES), dtype=np.uint64)
_DEEP_SEEDS = np.random.default_rng(21).integers(1, 1 << 63, size=(2, DEEP), dtype=np.uint64)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def shingle_words(text: str) -> list[bytes]:
    """A-Z lower-cased words between ASCII white space."""
    return text.encode().lower().translate(_TO_SPACE).split()


def shingle_set(text: str, width: int) -> set[tuple[bytes, ...]]:
    words = shingle_words(text)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[n:] for n in range(width))))


_WORD_HASHES = WorkerCache({}, lambda word: xxhash.xxh3_64_intdigest(word))


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    words = shingle_words(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(_WORD_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    span = min(width, len(words))
    mixed = np.zeros(len(words) - span + 1, dtype=np.uint64)
    for n in range(span):
        mixed = (mixed ^ hashes[n : n + len(mixed)]) * _MIX[n % 3]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(shingles: np.ndarray, seeds: np.ndarray = _SEEDS) -> bytes:
    """Least 16-bit values of the hash functions; long sets go block by block."""
    least = np.full(seeds.shape[1], np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 512):
        block = shingles[at : at + 512, None] * (seeds[0] | np.uint64(1)) + seeds[1]
        least = np.minimum(least, block.min(axis=0))
    return ((least * _MIX[1]) >> np.uint64(48)).astype("<u2").tobytes()


def band_rows(threshold: float) -> int:
    """The most rows in a band under which a pair at the threshold is surely enough a candidate."""
    return max(r for r in range(1, 17) if (1 - threshold**r) ** (HASHES // r) <= UNBANDED)


def least_matches(threshold: float, hashes: int = HASHES, batch: int = BATCH) -> list[int]:
    """By batch: the fewest equal rows that keep the posterior chance of a link at ``MISS`` or more."""
    out = []
    for n in range(batch, hashes + 1, batch):
        tail, m = 0.0, -1  # under a uniform prior: P(similarity >= t | m of n) = P(Bin(n + 1, t) <= m)
        while tail < MISS:
            m += 1
            log = math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
            tail += math.exp(log + m * math.log(threshold) + (n + 1 - m) * math.log1p(-threshold))
        out.append(m)
    return out


def _signed(docs: DataFrame, width: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, high, low, signatures = [], [], [], []
            for value in batch.column(1):
                shingles = shingle_hashes(value.as_py() or "", width)
                digest = xxhash.xxh3_128_digest(shingles.tobytes())
                sizes.append(len(shingles))
                high.append(int.from_bytes(digest[:8], "little", signed=True))
                low.append(int.from_bytes(digest[8:], "little", signed=True))
                signatures.append(signature(shingles) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()),
                 pa.array(signatures, pa.binary())],
                ["doc_id", "n_shingles", "h1", "h2", "signature"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        sign, f"doc_id {id_type}, n_shingles bigint, h1 bigint, h2 bigint, signature binary"
    )


def _probable(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs that sequential comparison of their signatures does not rule out."""
    wanted = least_matches(threshold)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(n).to_pylist()), dtype="<u2").reshape(batch.num_rows, -1) for n in (2, 3)
            )
            alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, dtype=np.int64)
            for step, least in enumerate(wanted):
                part = slice(step * BATCH, (step + 1) * BATCH)
                matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
                alive = alive[matches[alive] >= least]
            yield pa.RecordBatch.from_arrays([batch.column(n).take(pa.array(alive)) for n in (0, 1)], ["a", "b"])

    side = lambda x: classes.select(
        F.col("rep").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("signature").alias(f"s_{x}")
    )
    sized = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * F.lit(threshold)
    )
    id_type = pairs.schema["a"].dataType.simpleString()
    return sized.select("a", "b", "s_a", "s_b").mapInArrow(compare, f"a {id_type}, b {id_type}")


def _alive(one: np.ndarray, many: np.ndarray, wanted: list[int]) -> np.ndarray:
    """Rows of ``many`` that sequential comparison with ``one`` does not rule out."""
    alive, matches = np.arange(len(many)), np.zeros(len(many), dtype=np.int64)
    for step, least in enumerate(wanted):
        part = slice(step * BATCH, (step + 1) * BATCH)
        matches = matches + (many[alive, part] == one[part]).sum(axis=1)
        good = matches >= least
        alive, matches = alive[good], matches[good]
    return alive


def _cells(members: DataFrame, classes: DataFrame, texts: DataFrame, space: Workspace | None = None) -> DataFrame:
    """Large buckets dealt to cells: ``key, band, rep, label, size`` → a row for each member of a cell.

    A bucket's largest component needs no comparison inside. Its other members, the stragglers, ask (``asks``) all
    members of the bucket: a cell holds a block of stragglers and a block of members, both of bounded
    size, so a bucket of up to ``BLOCK`` members makes a row for each member and one for each straggler.
    """
    weighed = members.join(classes.select("rep", "n_shingles"), "rep")
    parts = weighed.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("weight"))
    main = F.max(F.struct("n", "weight", "label"))
    blocks = lambda n, w: F.ceil(F.greatest(n / BLOCK, w / BLOCK_SHINGLES)).cast("bigint")
    buckets = stage(
        parts.groupBy("key").agg(main.alias("main"), F.sum("n").alias("n"), F.sum("weight").alias("weight")).select(
            "key",
            F.col("main.label").alias("main"),
            blocks(F.col("n"), F.col("weight")).alias("blocks"),
            blocks(F.col("n") - F.col("main.n"), F.col("weight") - F.col("main.weight")).alias("asking"),
        ),
        "blocks",
        space,
    )
    marked = weighed.join(buckets, "key").withColumn("straggler", F.col("label") != F.col("main"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    kept = ["key", "band", "rep", "label", "n_shingles", "straggler"]
    held = marked.withColumn("high", F.pmod(F.xxhash64("rep"), "blocks")).select(*kept, "high", each("asking").alias("low"))
    asks = marked.filter("straggler").withColumn("low", F.pmod(F.xxhash64(F.lit("asks"), "rep"), "asking"))
    asks = asks.select(*kept, each("blocks").alias("high"), "low")
    return (
        held.withColumn("asks", F.lit(False)).unionByName(asks.withColumn("asks", F.lit(True)))
        .join(classes.select("rep", "signature"), "rep")
        .join(texts.select(F.col("doc_id").alias("rep"), "text"), "rep")
    )


def _straggler_links(cells: DataFrame, width: int, percent: int) -> DataFrame:
    """Links across components in large buckets, found inside the cells: ``a, b``.

    A pair is looked at by the first band it shares only. Pairs that the signature leaves open are compared by
    ``DEEP`` hash functions more, then on their full sets, the likeliest first. Of the links between two
    components a cell reports one.
    """
    threshold = percent / 100
    wanted, rows, least = least_matches(threshold), band_rows(threshold), least_matches(threshold, DEEP, DEEP)[0]
    used = HASHES // rows * rows
    id_type = cells.schema["rep"].dataType.simpleString()

    def compare(table: pa.Table) -> pa.Table:
        rep, label, sizes = (table[name].to_numpy() for name in ("rep", "label", "n_shingles"))
        asks, straggler = (table[name].to_numpy(zero_copy_only=False).astype(bool) for name in ("asks", "straggler"))
        signatures = np.frombuffer(b"".join(table["signature"].to_pylist()), dtype="<u2").reshape(len(rep), -1)
        band, right = table["band"][0].as_py(), np.flatnonzero(~asks)
        found, parent, sets, deep = [[], []], {}, {}, {}

        def root(x):
            while x in parent:
                x = parent[x]
            return x

        def shingles(row: int) -> np.ndarray:
            if row not in sets:
                sets[row] = shingle_hashes(table["text"][row].as_py(), width)
            return sets[row]

        def more(row: int) -> np.ndarray:
            if row not in deep:
                deep[row] = np.frombuffer(signature(shingles(row), _DEEP_SEEDS), dtype="<u2")
            return deep[row]

        for x in np.flatnonzero(asks):
            others = right[(label[right] != label[x]) & (~straggler[right] | (rep[right] > rep[x]))]
            others = others[np.minimum(sizes[others], sizes[x]) >= threshold * np.maximum(sizes[others], sizes[x])]
            others = others[_alive(signatures[x], signatures[others], wanted)]
            equal = signatures[others, :used] == signatures[x, :used]
            bands = equal.reshape(len(others), used // rows, rows).all(axis=2)
            here = bands.argmax(axis=1) == band
            for y in others[here][np.argsort(-equal[here].sum(axis=1), kind="stable")]:
                one, two = root(label[x]), root(label[y])
                if one == two or np.count_nonzero(more(x) == more(y)) < least:
                    continue
                common = len(np.intersect1d(shingles(x), shingles(y), assume_unique=True))
                if 100 * common >= percent * (sizes[x] + sizes[y] - common):
                    parent[two] = one
                    found[0].append(min(rep[x], rep[y]))
                    found[1].append(max(rep[x], rep[y]))
        return pa.table([pa.array(v, table.schema.field("rep").type) for v in found], ["a", "b"])

    return cells.groupBy("key", "low", "high").applyInArrow(compare, f"a {id_type}, b {id_type}").distinct()


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept_set = None, set()
        for batch in batches:
            good = []
            for row in range(batch.num_rows):
                a = batch.column(0)[row].as_py()
                if a != last:
                    last, kept_set = a, shingle_set(batch.column(2)[row].as_py(), width)
                other = shingle_set(batch.column(3)[row].as_py(), width)
                common = len(kept_set & other)
                if 100 * common >= percent * (len(kept_set) + len(other) - common):
                    good.append(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n).take(pa.array(good, pa.int64())) for n in (0, 1)], ["a", "b"]
            )

    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t_{x}"))
    id_type = pairs.schema["a"].dataType.simpleString()
    return (
        pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "t_a", "t_b")
        .mapInArrow(verify, f"a {id_type}, b {id_type}")
    )


def stars(edges: DataFrame, space: Workspace | None = None) -> DataFrame:
    """``v, root`` for every linked vertex but the roots: edges contracted around their least neighbours."""

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        if large:
            both = pairs.unionByName(pairs.select(F.col("v").alias("root"), F.col("root").alias("v")))
        else:  # each edge at its larger end
            both = pairs
        least = stage(both.groupBy("v").agg(F.min("root").alias("least")), "least", space)
        least = least.withColumn("least", F.least("v", "least"))
        joined = both.join(least, "v")
        if large:
            moved = joined.filter(F.col("root") > F.col("v")).select(F.col("root").alias("v"), F.col("least").alias("root"))
        else:
            moved = joined.select(F.col("root").alias("v"), F.col("least").alias("root")).unionByName(
                least.select("v", F.col("least").alias("root"))
            )
        return stage(moved.filter("v <> root").distinct(), "star", space)

    def mark(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("v", "root").cast("decimal(38,0)"))).first())

    pairs = stage(
        edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("root")).filter("v <> root").distinct(),
        "edges",
        space,
    )
    before = mark(pairs)
    while before[0]:
        pairs = star(star(pairs, large=True), large=False)
        after = mark(pairs)
        if after == before:
            break
        before = after
    return pairs


def _labelled(members: DataFrame, roots: DataFrame, space: Workspace) -> DataFrame:
    """Bucket members with their components, in buckets that still hold several."""
    named = members.join(roots.withColumnRenamed("v", "rep"), "rep", "left").withColumn(
        "label", F.coalesce("root", "rep")
    )
    named = stage(named.select("key", "band", "rep", "label", "size"), "named", space)
    open_keys = stage(
        named.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("key"),
        "open",
        space,
    )
    return stage(named.join(open_keys, "key"), "members", space)


def near_dedup(
    docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    ship_code(docs.sparkSession)
    read = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    with Workspace(docs.sparkSession) as space:
        return stage(_judged(read, width, percent, space), "judged")


def _classes(read: DataFrame, width: int, space: Workspace) -> tuple[DataFrame, DataFrame]:
    """Every document's set without its signature, and the classes of equal sets with theirs."""
    with Workspace(read.sparkSession) as signatures:
        signed = stage(_signed(read, width), "signed", signatures)
        classes = (
            signed.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
            .groupBy("h1", "h2")
            .agg(
                F.min("doc_id").alias("rep"),
                F.first("n_shingles").alias("n_shingles"),
                F.first("signature").alias("signature"),
            )
        )
        return stage(signed.drop("signature"), "sets", space), stage(classes, "classes", space)


def _judged(read: DataFrame, width: int, percent: int, space: Workspace) -> DataFrame:
    """The verdicts, lazy over tables in ``space``."""
    threshold = percent / 100
    sets, classes = _classes(read, width, space)
    rows = band_rows(threshold)
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(HASHES // rows - 1)),
        lambda n: F.xxhash64(n, F.substring(F.col("signature"), n * 2 * rows + 1, F.lit(2 * rows))),
    )
    banded = classes.select("rep", F.posexplode(keys).alias("band", "key"))
    shared = stage(banded.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "buckets", space)
    members = stage(banded.join(shared, "key"), "members", space)
    degrees = members.groupBy("rep").agg(F.sum("size").alias("degree"))
    ranked = stage(members.join(degrees, "rep"), "ranked", space)
    hubs = stage(
        ranked.groupBy("key").agg(F.max_by("rep", F.struct("degree", F.hash("rep"), "rep")).alias("hub")), "hubs", space
    )
    involved = members.select(F.col("rep").alias("doc_id")).distinct()
    texts = read.join(involved, "doc_id", "left_semi").groupBy("doc_id").agg(F.max("text").alias("text"))
    texts = stage(texts, "texts", space)

    def links(*probable: DataFrame) -> DataFrame:
        pairs = functools.reduce(DataFrame.unionByName, probable)
        return stage(_verified(stage(pairs, "probable", space), texts, width, percent), "links", space)

    first = stage(
        members.join(hubs, "key").filter("rep <> hub")
        .select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct(),
        "pairs",
        space,
    )
    found = links(_probable(first, classes, threshold))
    roots = stars(found, space)
    left = _labelled(members, roots, space)
    small = left.filter(F.col("size") <= SMALL)
    one = small.select("key", F.col("rep").alias("a"), F.col("label").alias("la"))
    two = small.select("key", F.col("rep").alias("b"), F.col("label").alias("lb"))
    rest = (
        one.join(two, "key").filter("a < b and la <> lb").select("a", "b").distinct()
        .join(first, ["a", "b"], "left_anti")
    )
    large = _straggler_links(_cells(left.filter(F.col("size") > SMALL), classes, texts, space), width, percent)
    more = links(_probable(rest, classes, threshold), large)
    if not more.isEmpty():
        roots = stars(found.unionByName(more), space)

    components = stage(
        classes.select("h1", "h2", "rep").join(roots.withColumnRenamed("v", "rep"), "rep", "left")
        .select("h1", "h2", F.coalesce("root", "rep").alias("component")),
        "components",
        space,
    )
    component = F.when(F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.coalesce("component", "doc_id"))
    return sets.join(components, ["h1", "h2"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, component).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n_shingles") > 0, component).otherwise(F.col("doc_id")).eqNullSafe(F.col("doc_id")).alias("kept"),
    )
