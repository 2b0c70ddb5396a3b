"""Records with similar metadata: sets of ``path=value`` tokens with a Jaccard similarity of 0.8 or more.

Equal sets are one node. A node's sketch is a row of minima of hashed tokens, cut into bands; nodes that
share a band are candidates, and their whole sets decide. Nodes are first compared with one lead of their
buckets each. A small bucket that is then of several components is compared pair by pair; a larger one is split
by measured numbers of nodes into blocks, which meet block by block and give only a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxledger.operators.components import components
from voxledger.session import shared_checkpoint, shared_dir

# Fixed value: the similarity, as a fraction.
LEAST = (4, 5)
BANDS, BAND_ROWS = 25, 5  # a pair at 0.8 shares a band with a probability of 0.99995
SMALL = 32  # nodes of a bucket that are compared pair by pair
BLOCK = 1_024  # nodes of a block
COLUMNS = 4_096  # tokens that are compared at a time
SEED = 20


def _mixers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    n = BANDS * BAND_ROWS
    return rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, dtype=np.uint64)


def band_keys(hashes: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """One number per band from the minima of the hashed tokens."""
    low = np.full(len(factors), np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 2048):
        mixed = hashes[at : at + 2048, None] * factors + terms
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0x94D049BB133111EB)
        low = np.minimum(low, mixed.min(axis=0))
    key = np.arange(BANDS, dtype=np.uint64)
    for column in low.reshape(BANDS, BAND_ROWS).T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def sketched(nodes: DataFrame) -> DataFrame:
    """``node``, ``n`` (tokens) and one ``bucket`` per band of nodes (``node``, ``hashes``); an empty set has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, terms = _mixers()
        for batch in batches:
            sets = batch.column(1)
            sizes = sets.value_lengths().to_numpy(zero_copy_only=False)
            ends, flat = np.cumsum(sizes), sets.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            some = np.flatnonzero(sizes)
            keys = [band_keys(flat[ends[i] - sizes[i] : ends[i]], factors, terms) for i in some]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.asarray(batch.column(0))[some], BANDS), pa.int64()),
                    pa.array(np.repeat(sizes[some], BANDS), pa.int64()),
                    pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)),
                ],
                names=["node", "n", "bucket"],
            )

    return nodes.select("node", "hashes").mapInArrow(run, "node bigint, n bigint, bucket bigint")


def similar_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (``u``, ``v``) that join all nodes of a bucket whose similarity is ``LEAST`` or more.

    ``members``: ``bucket``, ``node``, ``n``; ``sets``: ``node``, ``hashes``; both stored. Every bucket has a
    lead, and every node is first compared with the lead it shares most bands with. Only buckets that are
    then still of several components are compared in full, and in large ones the members of the greatest
    component not with each other.
    """
    crowd = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    met = shared_checkpoint(members.join(crowd, "bucket"))
    leads = met.groupBy("bucket").agg(F.min_by(F.struct("node", "n"), F.xxhash64("node")).alias("p"))
    asked = met.join(leads, "bucket").where((F.col("node") != F.col("p.node")) & _fits(F.col("n"), F.col("p.n")))
    shared = asked.groupBy("node", F.col("p.node").alias("lead")).agg(F.count(F.lit(1)).alias("bands"))
    best = shared.groupBy("node").agg(F.max_by("lead", F.struct("bands", "lead")).alias("lead"))
    pairs = best.select(F.least("node", "lead").alias("u"), F.greatest("node", "lead").alias("v")).distinct()
    first = shared_checkpoint(_similar(pairs, sets))
    rooted = met.join(components(first), "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    open_ = shared_checkpoint(rooted.join(several.select("bucket"), "bucket"))
    return first.unionByName(_pair_links(open_.where(F.col("rows") <= SMALL), sets)).unionByName(
        _block_links(open_.where(F.col("rows") > SMALL), sets)
    )


def _fits(a, b):
    """Sizes of two sets that can be similar enough."""
    return F.least(a, b) * LEAST[1] >= F.greatest(a, b) * LEAST[0]


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (``u``, ``v``) whose whole sets are similar enough, told in whole numbers."""
    left = sets.select(F.col("node").alias("u"), F.col("hashes").alias("tu"))
    right = sets.select(F.col("node").alias("v"), F.col("hashes").alias("tv"))
    both = F.size(F.array_intersect("tu", "tv"))
    enough = both * LEAST[1] >= (F.size("tu") + F.size("tv") - both) * LEAST[0]
    return pairs.join(left, "u").join(right, "v").where(enough).select("u", "v")


def _pair_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components in small buckets, pair by pair."""
    a, b = members.alias("a"), members.alias("b")
    apart = (F.col("a.node") < F.col("b.node")) & (F.col("a.root") != F.col("b.root"))
    pairs = a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & apart & _fits(F.col("a.n"), F.col("b.n")))
    return _similar(pairs.select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct(), sets)


def _block_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components in large buckets: blocks of the rest meet each other and those of the greatest component."""
    sizes = members.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("c"))
    shape = sizes.groupBy("bucket").agg(F.max_by("root", F.struct("c", "root")).alias("major"), F.max("c").alias("most"), F.sum("c").alias("all"))
    blocks = lambda c: F.ceil(c / BLOCK).cast("bigint")
    dealt = members.join(
        shape.select("bucket", "major", blocks(F.col("most")).alias("majors"), blocks(F.col("all") - F.col("most")).alias("minors")), "bucket"
    ).withColumn("minor", F.col("root") != F.col("major"))
    own = F.pmod(F.xxhash64("node", F.lit(9)), F.when(F.col("minor"), F.col("minors")).otherwise(F.col("majors")))
    each = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    meet = lambda kind, low, high: F.struct(F.lit(kind).alias("kind"), low.alias("low"), high.alias("high"))
    groups = F.when(
        F.col("minor"),
        F.concat(
            F.transform(each("minors"), lambda o: meet(0, F.least(own, o), F.greatest(own, o))),
            F.transform(each("majors"), lambda o: meet(1, own, o)),
        ),
    ).otherwise(F.transform(each("minors"), lambda o: meet(1, o, own)))
    met = dealt.select("bucket", "node", "minor", own.alias("block"), F.explode(groups).alias("g")).select("bucket", "node", "minor", "block", "g.*")
    # Where a block meets itself every member is on both sides.
    left = ((F.col("kind") == 0) & (F.col("block") == F.col("low"))) | ((F.col("kind") == 1) & F.col("minor"))
    right = ((F.col("kind") == 0) & (F.col("block") == F.col("high"))) | ((F.col("kind") == 1) & ~F.col("minor"))
    sided = met.select("bucket", "kind", "low", "high", "node", left.alias("is_left"), right.alias("is_right"))
    return sided.join(sets.select("node", "hashes"), "node").groupBy("bucket", "kind", "low", "high").applyInArrow(
        _compare, "u bigint, v bigint"
    )


def _compare(table: pa.Table) -> pa.Table:
    """A spanning forest of the similar pairs between the left and the right rows of a group."""
    node = table.column("node").to_numpy()
    hashes = table.column("hashes").combine_chunks()
    sizes = hashes.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values, owner = hashes.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(node)), sizes)
    left, right = (np.flatnonzero(table.column(c).to_numpy(zero_copy_only=False)) for c in ("is_left", "is_right"))
    place = np.full((2, len(node)), -1)
    place[0, left], place[1, right] = np.arange(len(left)), np.arange(len(right))
    shared = np.intersect1d(values[place[0, owner] >= 0], values[place[1, owner] >= 0])
    spot = np.searchsorted(shared, values)
    spot[spot == len(shared)] = 0
    known = shared[spot] == values if len(shared) else np.zeros(len(values), bool)
    both = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(shared), COLUMNS):
        here = known & (spot >= at) & (spot < at + COLUMNS)
        sides = []
        for k, rows in enumerate((left, right)):
            mine = here & (place[k, owner] >= 0)
            m = np.zeros((len(rows), min(COLUMNS, len(shared) - at)), np.float32)
            m[place[k, owner[mine]], spot[mine] - at] = 1
            sides.append(m)
        both += sides[0] @ sides[1].T
    common = both.astype(np.int64)
    union = sizes[left][:, None] + sizes[right][None, :] - common
    i, j = np.nonzero(common * LEAST[1] >= union * LEAST[0])
    kept = _forest(left[i], right[j], len(node))
    return pa.table({"u": pa.array(node[left[i][kept]], pa.int64()), "v": pa.array(node[right[j][kept]], pa.int64())})


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Places of links that join all that the links join: those that joined something when they came."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for at, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = find(x), find(y)
        if x != y:
            root[x] = y
            kept.append(at)
    return np.array(kept, np.int64)


def similar_classes(records: DataFrame, member: str, tokens: str) -> DataFrame:
    """Classes of more than one record: ``first`` member, ``copies`` (members) and ``variants`` (different sets).

    ``records`` has a ``member`` column of an ordered type and a column of sorted, distinct ``tokens``.
    Two records are linked if the Jaccard similarity of their tokens is ``LEAST`` or more; a class is what
    links reach. Records without tokens (NULL or empty) are one class. Equal sets are told by a SHA-256,
    similar ones by the 64-bit hashes of their tokens: only these move, and they are stored once.
    """
    spark = records.sparkSession
    held = F.coalesce(F.col(tokens), F.array().cast("array<string>"))
    keyed = records.select(
        F.col(member).alias("member"), F.sha2(F.array_join(held, "\u0001").cast("binary"), 256).alias("set"),
        F.array_sort(F.transform(held, lambda t: F.xxhash64(t))).alias("hashes"),
    )
    path = shared_dir(spark, "similar-sets")
    once = keyed.groupBy("set").agg(F.min("member").alias("first"), F.count(F.lit(1)).alias("copies"), F.any_value("hashes").alias("hashes"))
    once.select(F.monotonically_increasing_id().alias("node"), "first", "copies", "hashes").write.parquet(path)
    kept = spark.read.parquet(path)
    members = shared_checkpoint(sketched(kept.select("node", "hashes")))
    links = similar_links(members, kept.select("node", "hashes"))
    root = components(links)
    classes = kept.select("node", "first", "copies").join(root, "node", "left").groupBy(F.coalesce("root", "node").alias("root"))
    return (
        classes.agg(F.min("first").alias("first"), F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("variants"))
        .where("copies > 1")
        .drop("root")
    )
