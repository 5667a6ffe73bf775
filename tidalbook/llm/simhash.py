"""SimHash near-duplicates, linked through sharded BK-trees.

A fingerprint has 64 bits; a bit is 1 if it is set in over half of the XXH64
hashes of the text's word shingles (repeats count). Two texts are linked if
their fingerprints differ in at most ``radius`` bits, and a component is what
links reach.

How it scales
-------------
* Texts are read once. What moves afterwards is (doc_id, fingerprint).
* Equal fingerprints collapse to one node (their smallest doc_id) by a partial
  aggregate, so a group of exact copies, however large, costs one row per task.
* Fingerprints are cut into 8 blocks of 8 bits. Two that differ in 2 bits or
  fewer agree in 6 blocks at least, so each fingerprint goes to the
  C(8, 6) = 28 shards named by 6 of its blocks. A shard fixes 48 of 64 bits:
  it can hold no more than 65,536 different fingerprints whatever the data is.
* Each shard gets a BK-tree. Every fingerprint of the shard is searched in the
  tree, following only edges within the radius, and then becomes a child at
  its distance. The links that a shard reports are a spanning forest of its
  own links, one row less than it has members, so no group is expanded into
  its pairs, and no link between components is lost.
* Components come from large-star/small-star rounds over tables in the shared
  folder. Nothing is collected to the driver but two counters a round.

Trees are carried to their queries by the shuffle and not by broadcast: the
trees of all shards together grow with the corpus, so no size bound would hold
for such a broadcast.

Similarity
----------
A radius of 2 finds texts that share nearly all shingles. Two texts whose
shingle sets have a Jaccard similarity of 0.8 differ in about 10 of 64 bits,
and no sharding by bits finds such pairs in work linear in the corpus. So
``keep_one``, which promises that similarity, also makes partial fingerprints:
each of GROUPS is the SimHash of the LEAST shingles that come first in an order
of its own. Two texts of similarity 0.8 have an equal one with probability
1 - (1 - 0.8**3)**10 = 0.999. Members of a bucket are texts with different
shingle sets; equal sets are one member. In rounds, some members of each bucket
become pivots and every other member meets them, in the first round only the
one with most company in all its buckets, then up to SLOTS times as many each
time. Pairs that a one-permutation sketch of BINS bins shows to be far apart are
left out inside the join; the others are confirmed by the exact similarity of
their shingle sets. After each round pivots leave the bucket, and a bucket is done when one component
holds all members left, so a family is not expanded into its pairs once it is
joined, and no pair of different components stays uncompared. Members that
never join cost their bucket's pairs; those whose sets differ too much in size
to be that similar are not paired.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalbook.llm._shared import forget, fresh, marked, new_path, row_slices, stored

SEED = 42
BLOCKS = 8
RADIUS = 2
HASHES_AT_ONCE, WORDS_AT_ONCE = 1 << 16, 1 << 13
SIMILARITY = 0.8
GROUPS, LEAST = 10, 3
PIVOTS = (1, 8)
COUNTERS = 1 << 20

#: Lower-cases A-Z and turns all white space of ASCII into spaces.
_FOLD = bytes.maketrans(bytes(range(65, 91)) + b"\t\n\x0b\x0c\r", bytes(range(97, 123)) + b"     ")

#: An odd factor for each group; the products order the shingles.
FACTORS = np.array([int.from_bytes(hashlib.sha256(bytes([g])).digest()[:8], "little") | 1 for g in range(GROUPS)], dtype=np.uint64)
INVERSES = np.array([pow(int(f), -1, 1 << 64) for f in FACTORS], dtype=np.uint64)


def xxh64_slices(data: bytes, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of each data[start:end], all at once: every step of the hash takes the slices that are long enough for it."""
    whole = np.frombuffer(data + bytes(8), dtype=np.uint8)
    words = np.lib.stride_tricks.as_strided(whole.view(np.uint8), (len(data) + 1, 8), (1, 1)).view("<u8")[:, 0]  # the eight bytes from each place on
    back = starts - ends
    order = np.argsort(back.astype(np.int16) if len(back) and back.min() > -(1 << 15) else back, kind="stable")  # the longest first, so those that take part in a step stand in front
    at, left = starts[order].astype(np.int64), back[order].astype(np.int64)
    length = -left
    total = length.astype(np.uint64)
    one, two, three, four, five = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, by: (x << np.uint64(by)) | (x >> np.uint64(64 - by))
    mixed = lambda lane, word: turn(lane + word * two, 31) * one
    add = lambda *terms: np.uint64(sum(int(t) for t in terms) % (1 << 64))
    long = int(np.searchsorted(left, -32, side="right"))
    hashed = np.full(len(at), add(seed, five), dtype=np.uint64)
    if long:
        lanes = [np.full(long, v, dtype=np.uint64) for v in (add(seed, one, two), add(seed, two), add(seed), add(seed, -int(one)))]
        for stripe in range(int(length[0]) // 32):
            n = int(np.searchsorted(left, -32 * (stripe + 1), side="right"))
            for k, lane in enumerate(lanes):
                lane[:n] = mixed(lane[:n], words[at[:n] + (32 * stripe + 8 * k)])
        joined = turn(lanes[0], 1) + turn(lanes[1], 7) + turn(lanes[2], 12) + turn(lanes[3], 18)
        for lane in lanes:
            joined = (joined ^ mixed(np.zeros(long, dtype=np.uint64), lane)) * one + four
        hashed[:long] = joined
    hashed += total
    at, rest = at + length // 32 * 32, length % 32
    for k in range(3):
        some = np.flatnonzero(rest >= 8 * (k + 1))
        if len(some):
            word = mixed(np.zeros(len(some), dtype=np.uint64), words[at[some] + 8 * k])
            hashed[some] = turn(hashed[some] ^ word, 27) * one + four
    at, rest = at + rest // 8 * 8, rest % 8
    some = np.flatnonzero(rest >= 4)
    if len(some):
        hashed[some] = turn(hashed[some] ^ ((words[at[some]] & np.uint64(0xFFFFFFFF)) * one), 23) * two + three
    at, rest = at + rest // 4 * 4, rest % 4
    for k in range(3):
        some = np.flatnonzero(rest > k)
        if len(some):
            hashed[some] = turn(hashed[some] ^ (whole[at[some] + k].astype(np.uint64) * five), 11) * one
    hashed = (hashed ^ (hashed >> np.uint64(33))) * two
    hashed = (hashed ^ (hashed >> np.uint64(29))) * three
    hashed ^= hashed >> np.uint64(32)
    out = np.empty_like(hashed)
    out[order] = hashed
    return out


def shingle_hashes_of(texts: Iterable[str | None], size: int) -> Iterator[np.ndarray]:
    """For each text the XXH64 of each shingle; the whole sequence is one if the text has fewer words. About WORDS_AT_ONCE words are hashed together."""
    held: list[bytes] = []
    counts: list[int] = []
    n = 0

    def hashed() -> Iterator[np.ndarray]:
        data = b" ".join(held)
        ends = np.append(np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 32), len(data))
        starts = np.append(0, ends[:-1] + 1)
        first = np.cumsum([0, *counts])
        shingles = np.array([max(n - size + 1, 1) if n else 0 for n in counts], dtype=np.int64)
        bounds = np.cumsum([0, *shingles])
        opens = np.repeat(first[:-1] - bounds[:-1], shingles) + np.arange(bounds[-1])
        closes = np.minimum(opens + size, np.repeat(first[1:], shingles)) - 1
        found = xxh64_slices(data, starts[opens], ends[closes])
        yield from (found[a:b] for a, b in pairwise(bounds.tolist()))

    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
        if b"  " in words or words[:1] == b" " or words[-1:] == b" ":
            words = b" ".join(words.split())
        counts.append(words.count(b" ") + 1 if words else 0)
        if words:
            held.append(words)
        if (n := n + counts[-1]) >= WORDS_AT_ONCE:
            yield from hashed()
            held, counts, n = [], [], 0
    yield from hashed()


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of each shingle; the whole sequence is one if the text has fewer words."""
    return next(shingle_hashes_of([text], size))


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes; 0 if there are none."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[start : start + HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, size: int = 3) -> int:
    """The unsigned fingerprint of one text; 0 if it has no words."""
    return majority(shingle_hashes(text, size))


def partial_fingerprints(distinct: np.ndarray) -> list[int]:
    """For each group the fingerprint of those of the different shingles that its order puts first."""
    if len(distinct) <= LEAST:
        return [majority(distinct)] * GROUPS
    least = np.partition(distinct * FACTORS[:, None], LEAST - 1, axis=1)[:, :LEAST] * INVERSES[:, None]
    if LEAST == 3:  # two of three
        a, b, c = least.T
        return ((a & b) | (a & c) | (b & c)).tolist()
    return [majority(row) for row in least]


def fingerprints(docs: DataFrame, size: int = 3, parts: bool = False) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed bigint.

    A null text counts as empty. Rows with equal doc_id each get a row. With
    ``parts`` there are also a digest of the shingle set, its size and an array of
    the partial fingerprints.
    """

    def signed(values: list[int]) -> np.ndarray:
        return np.array(values, dtype=np.uint64).view(np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches):
            hashes = list(shingle_hashes_of(part.column(1).to_pylist(), size))
            columns = [part.column(0), pa.array(signed([majority(h) for h in hashes]))]
            if parts:
                sets = [np.unique(h) for h in hashes]
                columns.append(pa.array([hashlib.sha256(s.tobytes()).digest()[:16] for s in sets], pa.binary()))
                columns.append(pa.array([len(s) for s in sets], pa.int32()))
                flat = signed([p for s in sets for p in partial_fingerprints(s)])
                ends = np.arange(0, len(flat) + 1, GROUPS, dtype=np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", "own", "n", "parts"][: len(columns)])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, fp bigint" + ", own binary, n int, parts array<bigint>" * parts)


class BKTree:
    """Children are keyed by their Hamming distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near_and_add(self, value: int, radius: int) -> list[int]:
        """Places of the earlier values within the radius; the value is added."""
        place = len(self.values)
        self.values.append(value)
        self.children.append({})
        if not place:
            return []
        near, todo = [], [0]
        values, children = self.values, self.children
        while todo:
            at = todo.pop()
            distance = (values[at] ^ value).bit_count()
            if distance <= radius:
                near.append(at)
            below = children[at]
            if below:
                for d in range(max(distance - radius, 0), distance + radius + 1):
                    child = below.get(d)
                    if child is not None:
                        todo.append(child)
        at = 0
        while True:
            distance = (values[at] ^ value).bit_count()
            child = children[at].get(distance)
            if child is None:
                children[at][distance] = place
                return near
            at = child


def shard_forest(prints: list[int], nodes: list[int], radius: int) -> list[tuple[int, int]]:
    """Spanning forest (smaller node, other node) of the links within a shard."""
    tree, root = BKTree(), list(range(len(prints)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    order = sorted(range(len(prints)), key=nodes.__getitem__)
    for place, i in enumerate(order):
        for other in tree.near_and_add(prints[i], radius):
            a, b = sorted((top(other), top(place)))
            root[b] = a
    return [(nodes[order[top(k)]], nodes[order[k]]) for k in range(len(order)) if top(k) != k]


def _shard_keys(fp: Column, radius: int) -> Column:
    """One key for each choice of the blocks that two near fingerprints share."""
    width, keys = 64 // BLOCKS, []
    for number, kept in enumerate(combinations(range(BLOCKS), BLOCKS - radius)):
        mask = sum(((1 << width) - 1) << (width * b) for b in kept)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(number).cast("tinyint").alias("kind"), fp.bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*keys)


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b), a < b: node pairs whose components are those of all links.

    ``nodes`` has one row (node, fp) for each different fingerprint.
    """
    if not 0 <= radius < BLOCKS:
        raise ValueError(f"radius must be from 0 to {BLOCKS - 1}")
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = (
        nodes.repartition(tasks, "fp")  # a table of short rows is few files, and each row becomes many
        .select("node", "fp", F.explode(_shard_keys(F.col("fp"), radius)).alias("key"))
        .groupBy("key.kind", "key.bits")
        .agg(F.collect_list(F.struct("node", "fp")).alias("members"))  # at most 2**(8 * radius) members
        .where(F.size("members") > 1)
        .select("members")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches):
            pairs: list[tuple[int, int]] = []
            for members in part.column(0).to_pylist():
                prints = [m["fp"] & (2**64 - 1) for m in members]
                pairs += shard_forest(prints, [m["node"] for m in members], radius)
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return shards.mapInArrow(run, "a bigint, b bigint").distinct()


def similar_components(docs: DataFrame, nodes: DataFrame, edges: DataFrame, size: int, similarity: float) -> DataFrame:
    """``components`` of the edges and of node pairs of one bucket whose shingle sets have the similarity.

    ``nodes`` has one row (node, n, parts) for each different shingle set of n
    shingles; a node is a doc_id of ``docs``. If several texts have that
    doc_id, one that is similar is enough.
    """
    members = nodes.where("n > 0").select("node", "n", F.posexplode("parts").alias("kind", "part"))
    shared = members.groupBy(F.col("kind").alias("of"), F.col("part").alias("is")).agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("company")).where("low <> high")
    in_bucket = (F.col("kind") == F.col("of")) & (F.col("part") == F.col("is"))
    met = stored(members.join(shared, in_bucket).select("kind", "part", "node", "n", "company"), "members")
    scores = stored(met.groupBy(F.col("node").alias("scored")).agg(F.sum("company").alias("score")), "scores")
    sets = stored(_shingle_sets(docs, scores, size), "shingle-sets")
    found = stored(components(edges), "components")
    left = met.join(scores, F.col("node") == F.col("scored")).select("kind", "part", "node", "n", "score")
    left = _open(left, found, in_bucket)
    for number, slots in enumerate(PIVOTS):
        slot = F.pmod(F.xxhash64("node", F.lit(number)), F.lit(slots))
        end = F.max_by(F.struct("node", "n", "root"), F.struct("score", "node"))
        pivots = stored(left.groupBy(F.col("kind").alias("of"), F.col("part").alias("is"), slot.alias("slot")).agg(end.alias("end")), "pivots")
        close = F.least("n", "end.n") >= similarity * F.greatest("n", "end.n")
        pairs = left.join(pivots, in_bucket & (F.col("root") != F.col("end.root")) & close)
        pairs = stored(pairs.select(F.least("node", "end.node").alias("a"), F.greatest("node", "end.node").alias("b")).distinct(), "met")
        found = _joined(found, _similar(sets, pairs, similarity))
        used = pivots.select("of", "is", F.col("end.node").alias("used"))
        left = _open(left.drop("root").join(used, in_bucket & (F.col("node") == F.col("used")), "left_anti"), found, in_bucket)
    pairs = stored(_prefix_pairs(sets, left.select("node", "root").distinct(), similarity), "met")
    return _joined(found, _similar(sets, pairs, similarity))


def _open(members: DataFrame, found: DataFrame, in_bucket: Column) -> DataFrame:
    """The members with their component as ``root``, of buckets that hold more than one component."""
    joined = found.withColumnsRenamed({"node": "joined", "root": "of_joined"})
    rows = members.join(joined, F.col("node") == F.col("joined"), "left").withColumn("root", F.coalesce("of_joined", "node"))
    rows = stored(rows.select(*members.columns, "root"), "labelled")
    live = rows.groupBy(F.col("kind").alias("of"), F.col("part").alias("is")).agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return stored(rows.join(live, in_bucket, "left_semi"), "open")


def _joined(found: DataFrame, similar: DataFrame) -> DataFrame:
    """The components after more links."""
    similar = stored(similar, "similar")
    if similar.isEmpty():
        return found
    edges = found.where("root <> node").select(F.col("root").alias("a"), F.col("node").alias("b"))
    return stored(components(edges.union(similar)), "components")


def prefix_lengths(n: int, similarity: float) -> tuple[int, int]:
    """How many of a set's n tokens, in the common order, it must look up among smaller sets and show to larger ones."""
    at_least = lambda share: n - math.ceil(share * n - 1e-9) + 1
    return at_least(similarity), at_least(2 * similarity / (1 + similarity))


def _prefix_pairs(sets: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """(a, b): pairs of ``nodes`` (node, root) with different roots, among them all whose sets have the similarity."""
    own = stored(sets.join(nodes, F.col("id") == F.col("node")).select("node", "root", "hashes"), "open-sets")
    counted = own.select(F.explode("hashes").alias("hash")).groupBy(F.pmod("hash", F.lit(COUNTERS)).cast("int").alias("counter")).agg(F.count("*").alias("n"))
    counted = counted.select("counter", F.floor(16 * F.log2("n")).cast("short").alias("level")).toArrow()  # COUNTERS rows of 6 bytes at most
    levels = np.zeros(COUNTERS, dtype=np.int16)
    levels[counted.column(0).to_numpy()] = counted.column(1).to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = shared.value
        for part in row_slices(batches):
            rows: list[tuple[np.ndarray, ...]] = []
            for node, root, hashes in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), strict=True):
                hashes = np.asarray(hashes.values, dtype=np.int64)
                looks_up, shows = prefix_lengths(len(hashes), similarity)
                first = np.lexsort((hashes, levels[np.mod(hashes, COUNTERS)]))[:looks_up]
                places = np.arange(len(first))
                rows.append((hashes[first], *(np.full(len(first), v) for v in (node, root, len(hashes))), places, places < shows))
            columns = [np.concatenate(c) for c in zip(*rows, strict=True)]
            if columns:
                yield pa.RecordBatch.from_arrays([pa.array(columns[k].astype(kind)) for k, kind in enumerate(("i8", "i8", "i8", "i4", "i4", "?"))], names=["token", "node", "root", "n", "place", "shown"])

    prefix = stored(own.mapInArrow(run, "token bigint, node bigint, root bigint, n int, place int, shown boolean"), "prefix")
    live = prefix.groupBy(F.col("token").alias("met")).agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    prefix = stored(prefix.join(live, F.col("token") == F.col("met"), "left_semi"), "shared-prefix")
    x, y = prefix.alias("x"), prefix.where("shown").alias("y")
    larger = F.struct("x.n", "x.node") > F.struct("y.n", "y.node")
    behind = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))  # this token and all after it
    enough = (F.col("y.n") >= similarity * F.col("x.n")) & (behind >= similarity / (1 + similarity) * (F.col("x.n") + F.col("y.n")) - 1e-9)
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root")) & larger & enough)
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _shingle_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(id, hashes): the sorted hashes of the different shingles of the texts whose doc_id is in ``wanted`` (and of few others).

    A bitmap picks the texts where they are read; only sets are shuffled, to
    leave out repeated rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches):
            sets = [np.unique(h).view(np.int64) for h in shingle_hashes_of(part.column(1).to_pylist(), size)]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            own = pa.array([hashlib.sha256(s.tobytes()).digest()[:16] for s in sets], pa.binary())
            hashes = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *sets])))
            yield pa.RecordBatch.from_arrays([part.column(0), own, hashes], names=["id", "own", "hashes"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").where("id is not null")
    texts = marked(texts, F.xxhash64("id"), wanted.select(F.xxhash64(wanted.columns[0])))
    sets = texts.mapInArrow(run, "id bigint, own binary, hashes array<bigint>")
    return sets.groupBy("id", "own").agg(F.first("hashes").alias("hashes")).drop("own")


def _similar(sets: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of doc_ids whose shingle sets have the similarity."""
    left, right = sets.toDF("left_id", "left_set"), sets.toDF("right_id", "right_set")
    both = pairs.join(left, F.col("a") == F.col("left_id")).join(right, F.col("b") == F.col("right_id"))
    common = F.size(F.array_intersect("left_set", "right_set"))
    return both.where((common > 0) & (common >= similarity * (F.size("left_set") + F.size("right_set") - common))).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches.

    Large-star and small-star rounds in turn until nothing changes. Hubs meet
    in joins whose large partitions adaptive execution splits, and in partial
    minima; neighbours are never gathered in a list.
    """
    spark = edges.sparkSession
    path = new_path(spark, "links")
    edges.select("a", "b").write.parquet(path)
    state = None
    while True:
        pairs = spark.read.schema("a bigint, b bigint").parquet(path)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == state or not now[0]:
            break
        state = tuple(now)
        large = _star(pairs.union(pairs.select("b", "a")), large=True)
        middle = stored(large.distinct(), "large-star")
        small = _star(middle.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), large=False)
        after = new_path(spark, "links")
        small.distinct().write.parquet(after)
        forget(spark, path)
        path = after
    settled = spark.read.schema("a bigint, b bigint").parquet(path)
    return settled.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours get linked to the smallest of node and neighbours.

    Large: only neighbours above the node. Small: ``pairs`` holds only
    neighbours (b) below the node (a), and the node is linked too.
    """
    spark = pairs.sparkSession
    least = pairs.groupBy(F.col("a").alias("hub")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
    path = new_path(spark, "least")
    least.write.parquet(path)
    least = spark.read.schema("hub bigint, m bigint").parquet(path)
    joined = pairs.join(least, pairs.a == least.hub)
    if large:
        out = joined.where("b > a").select(F.col("m").alias("a"), "b")
    else:
        out = joined.select(F.col("m").alias("a"), F.col("b")).union(least.select(F.col("m").alias("a"), F.col("hub").alias("b")))
    return out.where("a <> b")


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = RADIUS, similarity: float | None = None) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs`` (doc_id, text; more columns are ignored).

    component_id is the smallest doc_id reachable, itself included. Links are
    those of the fingerprints within the radius and, with ``similarity``, those
    of texts whose shingle sets are that similar. Empty and null texts have
    fingerprint zero and are linked like others. Repeated rows each keep a row.
    A null doc_id keeps its row and fingerprint; it takes the component of its
    fingerprint, which is null if no doc_id is known there.
    """
    prints = stored(fingerprints(docs, size, similarity is not None), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    known = nodes.where("node is not null")
    edges = links(known, radius)
    if similarity is None:
        found = components(edges)
    else:
        sets = stored(prints.groupBy("own").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("parts").alias("parts")).where("node is not null"), "sets")
        owners, holders = sets.select(F.col("own").alias("set"), F.col("node").alias("owner")), known.toDF("held", "holder")
        tied = prints.select("fp", "own").distinct().join(owners, F.col("own") == F.col("set")).join(holders, F.col("fp") == F.col("held")).where("owner <> holder")
        tied = tied.select(F.least("owner", "holder").alias("a"), F.greatest("owner", "holder").alias("b")).distinct()
        edges = stored(edges.union(tied), "edges")
        found = similar_components(docs, sets.select("node", "n", "parts"), edges, size, similarity)
    roots = stored(
        nodes.join(found, "node", "left").select(F.col("fp").alias("node_fp"), F.coalesce("root", "node").alias("component_id")),
        "roots",
    )
    return prints.join(roots, prints.fp == roots.node_fp, "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, size: int = 5, radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` but those whose text is a near copy of a kept one.

    Near copies have shingle sets of that Jaccard similarity or more, or
    fingerprints within the radius. Of each component the smallest doc_id
    stays. Rows that share a doc_id are one document: they stay or go together,
    and go if one of their texts is a near copy of an earlier document. Columns
    stay as they are. Rows without a doc_id stay.
    """
    found = near_duplicates(docs, size, radius, similarity)
    (name,) = fresh(docs, "gone")
    gone = stored(found.where("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct(), "near-copies")
    return docs.join(gone, docs["doc_id"] == gone[name], "left_anti")
