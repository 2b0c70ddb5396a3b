"""Near-duplicate operators and connected components against brute force."""

import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.cases import awkward, blank_text_words, components, empty, rows
from voxledger.llm import embedding_join, simhash
from voxledger.llm.common import connected_components
from voxledger.llm.suite import QUERIES


def slow_fingerprint(text):
    words = blank_text_words(text)
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_simhash(docs):
    """(doc_id, hex fingerprint, component) of rows with ids."""
    prints = [(i, slow_fingerprint(t)) for i, t in docs]
    links = [
        (a, b) for a in range(len(prints)) for b in range(a) if (prints[a][1] ^ prints[b][1]).bit_count() <= 2
    ]
    of = components(range(len(prints)), links)
    lowest = {}
    for n, root in of.items():
        lowest[root] = min(lowest.get(root, math.inf), prints[n][0])
    return sorted((i, f"{p:016x}", lowest[of[n]]) for n, (i, p) in enumerate(prints))


def test_simhash_query_equals_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in QUERIES["op2_simhash"](spark, sf_dir).collect()) == brute_simhash(docs)


def test_simhash_of_awkward_rows(spark):
    got = simhash.simhash_table(awkward(spark))
    known = [(r["doc_id"], r["text"]) for r in awkward(spark).collect() if r["doc_id"] is not None]
    low = {i: c for i, _, c in brute_simhash(known)}
    assert {r["doc_id"]: r["component_id"] for r in got.where("doc_id is not null").collect()} == low
    assert rows(got) == rows(simhash.simhash_table(awkward(spark, clashing=True)))
    assert simhash.simhash_table(empty(spark)).count() == 0


def test_keep_one_keeps_one_row_of_each_group(spark):
    docs = awkward(spark, clashing=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    found = simhash.near_duplicates(docs)
    groups = found.select(F.coalesce("component_id", "fingerprint")).distinct().count()
    assert kept.count() == groups + 1  # id 7 names two texts that are not alike: two groups
    assert kept.where("doc_id = 4").count() == 1 and kept.where("doc_id = 5").count() == 0


def test_rows_without_ids_are_kept_apart(spark):
    a, b = "red green blue " * 5, "one two three four " * 5
    rows_ = [(None, a, "x"), (None, a, "y"), (None, b, "x"), (7, "else entirely here", "x"), (None, "else entirely here", "y"), (8, "nine ten", "x"), (8, "nine ten", "x")]
    df = spark.createDataFrame(rows_, "doc_id long, text string, text_digest string")
    kept = rows(simhash.keep_one(df))
    assert [r[:2] for r in kept] == [(7, "else entirely here"), (8, "nine ten"), (None, b), (None, a)]
    assert kept[0][2] == "x" and simhash.keep_one(df).columns == df.columns


def test_trees_find_every_pair_across_shards(spark):
    rng = np.random.default_rng(1)
    values = [rng.integers(0, 2**63, 600).astype(np.uint64)]
    for _ in range(3):
        near = values[0][rng.integers(0, 600, 300)]
        for _ in range(2):
            near = near ^ (np.uint64(1) << rng.integers(0, 64, len(near)).astype(np.uint64))
        values.append(near)
    values = np.unique(np.concatenate(values))
    distance = np.bitwise_count(values[:, None] ^ values[None, :])
    want = components(range(len(values)), zip(*np.nonzero(np.triu(distance <= 2, 1))))
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint long")
    links = simhash.fingerprint_links(df, shard_rows=64)
    place = {int(v): i for i, v in enumerate(values.view(np.int64))}
    got = components(range(len(values)), [(place[r["u"]], place[r["v"]]) for r in links.collect()])
    assert got == want


@pytest.mark.parametrize("n", [1, 2, 40])
def test_leaf_and_tree_comparison_agree(n):
    rng = np.random.default_rng(n)
    home = np.unique(rng.integers(0, 2**10, 900).astype(np.uint64))
    queries = np.setdiff1d(rng.integers(0, 2**10, n).astype(np.uint64), home)
    both = np.concatenate([home, queries])
    got = set()
    for i, j in simhash.close_pairs(home, queries, 2):
        got |= {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist())}
    d = np.bitwise_count(both[:, None] ^ both[None, :]) <= 2
    want = {(a, b) for a, b in zip(*np.nonzero(np.triu(d, 1))) if a < len(home)}
    assert got == {(int(a), int(b)) for a, b in want}


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100)] + [(500, i) for i in range(501, 700)] + [(i, 800 + (i - 799) % 50) for i in range(800, 850)]
    links += [(rng.randint(1000, 1200), rng.randint(1000, 1200)) for _ in range(150)]
    df = spark.createDataFrame(links, "u long, v long")
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == components(nodes, [(a, b) for a, b in links if a != b])
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_vectors(vectors, cosine=0.95):
    good = {}
    for n, (_, v) in enumerate(vectors):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            good[n] = x / np.abs(x).max()
    links = [
        (a, b)
        for a in good
        for b in good
        if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= cosine
    ]
    of = components(range(len(vectors)), links)
    degree = [0] * len(vectors)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    low = {}
    for n, root in of.items():
        low[root] = min(low.get(root, math.inf), vectors[n][0])
    return sorted((i, degree[n], low[of[n]], i == low[of[n]]) for n, (i, _) in enumerate(vectors))


def test_grid_join_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24))
    vectors = [(centres[i % 12] + rng.normal(size=24) * rng.choice([0.02, 0.25, 0.6])).tolist() for i in range(500)]
    vectors += [vectors[0], vectors[0], [2 * x for x in vectors[1]], [1e200 * x for x in vectors[2]]]
    vectors += [None, [], [0.0] * 24, [math.nan] + [1.0] * 23, [math.inf] + [1.0] * 23, [None] + [1.0] * 23, [1.0, 0.0], [1.0, 0.01]]
    table = [(i, v) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>").repartition(4)
    got = embedding_join.embedding_near_duplicates(df, interval_rows=40)
    got = sorted((r["id"], r["n_links"], r["component_id"], r["id"] == r["component_id"]) for r in got.collect())
    assert got == brute_vectors(table)


def test_dense_groups_are_counted_without_comparing(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=16)
    vectors = [(i, (centre + rng.normal(size=16) * 0.01).tolist()) for i in range(700)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in embedding_join.embedding_table(df).collect()}
    assert got == {(i, 699, 0, i == 0) for i in range(700)}


def test_embedding_query_and_edge_tables(spark, sf_dir):
    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(tuple(r) for r in QUERIES["op3_embedding_join"](spark, sf_dir).collect()) == brute_vectors(table)
    schema = "vec_id long, embedding array<float>, label int, id string, node long"
    assert embedding_join.embedding_table(empty(spark, schema)).count() == 0
    ties = spark.createDataFrame([(5, [1.0, 0.0], 1, "x", 1), (5, [1.0, 0.0], 1, "x", 1), (None, [1.0, 0.0], 1, "x", 1)], schema)
    assert sorted(r["n_links"] for r in embedding_join.embedding_table(ties).collect()) == [2, 2, 2]
    only = spark.createDataFrame([(1, None, 1, "x", 1)], schema)
    assert rows(embedding_join.embedding_table(only)) == [(1, 0, 1, True)]


def test_vectors_of_many_widths(spark):
    """More than 64 widths, few vectors each: one plan links within each width only."""
    rng = np.random.default_rng(8)
    rows = []
    for width in range(1, 90):
        base = rng.normal(size=width)
        rows += [(3 * width, base.tolist()), (3 * width + 1, (base * 2).tolist()), (3 * width + 2, (-base).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_join.embedding_table(df).collect()}
    for width in range(1, 90):
        assert [got[3 * width + i] for i in range(3)] == [(1, 3 * width), (1, 3 * width), (0, 3 * width + 2)]


def test_keep_one_with_names_that_operators_make(spark):
    df = spark.createDataFrame([(1, "a b c d", "x"), (2, "a b c d", "y")], "doc_id long, text string, kept_digest string")
    assert simhash.keep_one(df).columns == df.columns and [r["kept_digest"] for r in simhash.keep_one(df).collect()] == ["x"]
