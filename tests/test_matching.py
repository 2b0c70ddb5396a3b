"""Similar records, name patterns, ranges, permutations, search and run state against plain computations."""

import fnmatch
import json
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxledger.functions import flatten as FL
from voxledger.functions.permutation import permuted, unpermuted
from voxledger.operators import intervals as N
from voxledger.operators import ivf as I
from voxledger.operators import patterns as P
from voxledger.operators import records as R
from voxledger.operators import similar as S
from voxledger.operators import similarity as E
from voxledger.operators.components import components
from voxledger.streaming import jobs as X
from voxledger.streaming import runs as U


# ---- similar records -----------------------------------------------------------------
def classes(sets):
    """(first, copies, variants) of all classes by comparing all pairs."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(sets)):
        groups.setdefault(find(i), []).append(i)
    return sorted((min(g), len(g), len({frozenset(sets[i]) for i in g})) for g in groups.values() if len(g) > 1)


def some_sets(rng, families, copies):
    out = []
    for _ in range(families):
        base = {f"k{rng.randrange(4000)}={rng.randrange(50)}" for _ in range(rng.randint(8, 60))}
        for _ in range(copies):
            changed = set(base)
            for _ in range(rng.randrange(4)):
                changed.discard(rng.choice(sorted(changed)))
                changed.add(f"n{rng.randrange(10**6)}=1")
            out.append(changed)
    rng.shuffle(out)
    return out


def found_classes(spark, sets, **more):
    df = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "member long, tokens array<string>").repartition(5)
    return sorted(tuple(r) for r in S.similar_classes(df, "member", "tokens").collect())


def test_similar_records_equal_all_pairs(spark):
    sets = some_sets(random.Random(1), 40, 5) + [set(), set(), {"a=1"}, {"a=1"}]
    assert found_classes(spark, sets) == classes(sets)


def test_hot_buckets_are_compared_in_blocks(spark, monkeypatch):
    """A third of all records share buckets; sizes differ; blocks of a few rows meet."""
    rng = random.Random(2)
    base = [f"field{i}=v" for i in range(50)]
    sets = some_sets(rng, 20, 3)
    for i in range(90):
        mine = set(base[: 50 - rng.randrange(12)]) | {f"own{i}.{k}=1" for k in range(rng.randrange(8))}
        sets.append(mine)
    want = classes(sets)
    monkeypatch.setattr(S, "SMALL", 4)
    monkeypatch.setattr(S, "BLOCK", 16)
    monkeypatch.setattr(S, "COLUMNS", 7)
    assert found_classes(spark, sets) == want


def test_recall_at_the_least_similarity(spark):
    """Pairs at exactly 0.8 to 0.85, alone with each other: at least 0.95 are found."""
    rng = random.Random(3)
    sets = []
    for i in range(400):
        shared = {f"p{i}.{k}=1" for k in range(40)}
        extra = rng.choice([8, 9, 10])
        sets += [shared, shared | {f"q{i}.{k}=1" for k in range(extra)}]
    got = found_classes(spark, sets)
    assert len(got) >= 0.95 * 400 and all(c == (f, 2, 2) for c in got for f in [c[0]])


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(6, 60)] + [(200, 201), (201, 200), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in range(5, 60)}, 200: 200, 201: 200}


# ---- open documents --------------------------------------------------------------------
def random_json(rng, depth):
    kind = rng.randrange(7 if depth else 4)
    if kind < 4:
        return [None, rng.randrange(100), rng.choice(["", "é", "a.b", '"q"']), rng.choice([True, False])][kind]
    if kind == 4:
        return [random_json(rng, depth - 1) for _ in range(rng.randrange(3))]
    return {rng.choice("abcd"): random_json(rng, depth - 1) for _ in range(rng.randrange(4))}


def test_merging_as_variant_equals_merging_in_python(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        rows.append((i, json.dumps({"t": random_json(rng, 4), "u": random_json(rng, 3)}), json.dumps({"t": random_json(rng, 4), "w": random_json(rng, 2)})))
    rows += [(1000, None, '{"x": 1}'), (1001, '{"x": 1}', None), (1002, "{broken", "{}"), (1003, "{}", "nope"), (1004, None, None), (1005, "[1]", "{}")]
    df = spark.createDataFrame(rows, "id long, base string, extra string")
    got = {r["id"]: (r["merged"], r["merge_error"]) for r in FL.merge_texts(df, "base", "extra", 6).collect()}
    want = {r["id"]: (r["m"], r["e"]) for r in df.select("id", R.deep_merge("base", "extra").alias("m"), R.merge_error("base", "extra").alias("e")).collect()}
    for i in want:
        assert got[i][1] == want[i][1], rows[i]
        assert (got[i][0] and json.loads(got[i][0])) == (want[i][0] and json.loads(want[i][0])), i
    deep = spark.createDataFrame([(1, '{"a": {"b": {"c": 1}}}', '{"a": {"b": {"d": 1}}}')], "id long, base string, extra string")
    assert FL.merge_texts(deep, "base", "extra", 2).first()["merge_error"] == "objects below 2 levels"
    assert json.loads(FL.merge_texts(deep, "base", "extra", 3).first()["merged"]) == {"a": {"b": {"c": 1, "d": 1}}}


def test_tokens_of_documents(spark):
    text = '{"a": {"b": 1, "c": [2, 2, {"d": null}]}, "e": {}, "f": [], "g": "x=y"}'
    row = spark.sql("SELECT 1").select(FL.tokens(F.parse_json(F.lit(text)), 5)).first()[0]
    assert row == sorted(["a.b=1", "a.c[]=2", "a.c[].d=null", "e={}", "f=[]", 'g="x=y"'])


# ---- patterns ----------------------------------------------------------------------------
def test_a_thousand_patterns_match_like_the_shell(spark):
    rng = random.Random(5)
    alphabet = "abcx_1."
    names = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(12))) for _ in range(250)] + ["", "a[1", "x]y", "a\nb", "ü日x", "a^b", "$HOME(1)"]
    parts = ["*", "?", "[ab]", "[!ab]", "[a-c]", "[]x]", "[!]]", "[^a]", "a", "b", "x_", "abc", ".", "1", "(", "$", "^", "é", "ü日"]
    patterns = ["".join(rng.choice(parts) for _ in range(rng.randrange(6))) for _ in range(1000)] + ["", "*", "a[1", "[", "a\nb"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)] + [(9999, None)], "i long, name string")
    table = spark.createDataFrame([(k, p) for k, p in enumerate(patterns)] + [(9999, None)], "k long, pattern string")
    got = {(r["k"], r["i"]) for r in P.match_patterns(df, "name", table).collect()}
    want = {(k, i) for k, p in enumerate(patterns) for i, n in enumerate(names) if fnmatch.fnmatchcase(n, p)}
    assert got == want
    assert P.match_patterns(df, "name", table.where("k < 0")).count() == 0


def test_patterns_are_verified_on_few_names_and_once_a_text(spark, monkeypatch):
    """A thousand numbered patterns and 400 rows of one pattern: 41,000 pairs, few of which take a regular expression."""
    monkeypatch.setattr(P, "LIST", 30, raising=False)
    names = spark.createDataFrame([(i, f"/data/metadata_{i}_20240101.json") for i in range(1_000)], "i long, name string")
    rows = [(k, f"*_{k}_2024*", {"kind": k}) for k in range(1_000)] + [(1_000 + k, "*7_20240101.json", {}) for k in range(400)]
    table = spark.createDataFrame(rows, "k long, pattern string, more map<string,long>")
    verified = spark.sparkContext.accumulator(0)

    def counted(_, name, regex):
        def fits(a, b):
            verified.add(1)
            return re.search(b, a) is not None

        return F.udf(fits, "boolean")(name, regex)

    with monkeypatch.context() as patch:
        patch.setattr(P.F, "call_function", counted)
        found = P.match_patterns(names, "name", table)
    got = sorted((r["k"], r["i"]) for r in found.collect())
    assert got == [(k, k) for k in range(1_000)] + [(1_000 + k, i) for k in range(400) for i in range(7, 1_000, 10)]
    assert verified.value <= 5_000


def test_pairs_are_made_of_slices_and_common_pieces_stay(spark, monkeypatch):
    """Lists become slices before pairs, so a task keeps few of them; pieces that all names have do not travel unless one is filed under."""
    monkeypatch.setattr(P, "LIST", 30)
    monkeypatch.setattr(P, "SLICE", 7, raising=False)
    texts = [f"/data/metadata_{i}_20240101_{i:06d}.json" for i in range(100)] + ["", None, "json", "/data/metadata_5_20240101_000005.json"]
    names = spark.createDataFrame(list(enumerate(texts)), "i long, name string").repartition(3)
    patterns = ["/data/*"] * 70 + ["*_5_*", "*[0-9]5_*.json", "*json", "*no such piece*metadata*", "*", "", "?son", None]
    table = spark.createDataFrame(list(enumerate(patterns)), "k long, pattern string")
    found = P.match_patterns(names, "name", table)
    want = [(k, i) for k, p in enumerate(patterns) for i, n in enumerate(texts) if None not in (p, n) and fnmatch.fnmatchcase(n, p)]
    assert sorted((r["k"], r["i"]) for r in found.collect()) == want and len(want) > 7_000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(" in plan and ("INSET" in plan or " IN (" in plan)


# ---- ranges -------------------------------------------------------------------------------
def brute_gaps(total, ranges):
    missing = set(range(total))
    for s, e in ranges:
        if s is not None and e is not None:
            missing -= set(range(s, e + 1))
    out, run = [], None
    for b in sorted(missing):
        if run and b == run[1] + 1:
            run[1] = b
        else:
            run = [b, b]
            out.append(run)
    return [tuple(r) for r in out]


@pytest.mark.parametrize("span", [3, 1_000_000])
def test_missing_ranges_equal_sets_of_bytes(spark, span):
    rng = random.Random(6)
    files = [(i, rng.choice([0, 1, 50, 300])) for i in range(30)]
    done = []
    for i, total in files:
        for _ in range(rng.choice([0, 1, 5, 40])):
            s = rng.randint(-5, 320)
            done.append((i, s, s + rng.randint(-1, 30)))
    done += [(0, s, s + 2) for s in range(0, 300, 4)] + [(3, None, 5), (3, 5, None), (77, 0, 9), (4, 0, 400)]
    f = spark.createDataFrame(files, "file long, total long")
    d = spark.createDataFrame(done, "file long, start_byte long, end_byte long").repartition(3)
    want = sorted((i, *g) for i, total in files for g in brute_gaps(total, [(s, e) for j, s, e in done if j == i]))
    assert sorted(map(tuple, N.missing_ranges(f, d, span).collect())) == want
    plan = N.resume_plan(f, d, 16, span).collect()
    assert sum(r["end_byte"] - r["start_byte"] + 1 for r in plan) == sum(e - s + 1 for _, s, e in want)
    assert all(r["start_byte"] // 16 == r["end_byte"] // 16 == r["chunk_id"] for r in plan)


# ---- permutations ---------------------------------------------------------------------------
def test_permutations_are_bijections_for_every_count(spark):
    counts = spark.range(1, 90).selectExpr("id AS n", "explode(sequence(0L, id - 1)) AS x")
    df = counts.withColumn("y", permuted(F.col("x"), F.col("n"), F.lit("7:1"))).withColumn("back", unpermuted(F.col("y"), F.col("n"), F.lit("7:1")))
    assert df.where("y < 0 OR y >= n OR back <> x").count() == 0
    assert df.groupBy("n").agg(F.count_distinct("y").alias("d")).where("d <> n").count() == 0
    big = spark.range(5).select(permuted(F.col("id"), F.lit(10**12), F.lit("k")).alias("y"))
    assert big.distinct().count() == 5
    order = [r["y"] for r in df.where("n = 80").orderBy("x").collect()]
    other = [r["y"] for r in spark.range(80).select(permuted(F.col("id"), F.lit(80), F.lit("8:1")).alias("y")).collect()]
    assert order != sorted(order) and order != other
    assert np.corrcoef(np.arange(80), order)[0, 1] ** 2 < 0.2


# ---- inverted files -----------------------------------------------------------------------
def test_inverted_file_recall_and_odd_vectors(spark, sf_dir, monkeypatch):
    index = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    odd = spark.createDataFrame([(10**6, None), (10**6 + 1, [1.0]), (10**6 + 2, [0.0] * 64), (10**6 + 3, [float("nan")] * 64)], "vec_id long, embedding array<float>")
    queries = index.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    want = {(r["query_id"], r["vec_id"]) for r in E.top_k(index, queries, 10).collect()}
    both = index.unionByName(odd)
    monkeypatch.setattr(I, "LIST_ROWS", 16)
    centroids = I.fit(both, "embedding", 64)
    assert 20 <= len(centroids.matrix) <= 40
    got = {(r["query_id"], r["vec_id"]) for r in I.search(both, queries.unionByName(odd.withColumnRenamed("vec_id", "query_id")), 10, centroids).collect()}
    assert len(got & want) >= 0.9 * len(want) and max(q for q, _ in got) < 10**6
    monkeypatch.setattr(I, "PART_ROWS", 7)
    split = {(r["query_id"], r["vec_id"]) for r in I.search(both, queries, 10, centroids).collect()}
    assert split == got
    whole = I.search(index, queries, 10, centroids, probes=len(centroids.matrix)).collect()
    assert {(r["query_id"], r["vec_id"]) for r in whole} == want
    nothing = I.fit(odd.limit(0), "embedding", 64)
    assert I.search(index.limit(0), queries, 3, nothing).count() == 0


# ---- runs -----------------------------------------------------------------------------------
def test_run_state_in_three_arrivals_equals_batch(spark):
    """Events out of order, steps left out, runs that are stuck while open."""
    hour = 3_600_000
    base = 1_704_067_200_000
    script = {
        1: [(0, "pending"), (1, "processing"), (2, "saving-data"), (3, "complete")],
        2: [(0, "pending"), (1, "saving-data"), (2, "processing"), (30, "complete")],
        3: [(0, "processing"), (9, "processing"), (10, "failed"), (11, "complete"), (12, "pending")],
        4: [(20, "pending")],
        5: [(45, "processing")],
    }
    rows, n = [], 0
    for key, steps in script.items():
        for h, status in steps:
            rows.append((key, n, base + h * hour, status))
            n += 1
    rows.append((9, n, base + 50 * hour, "complete"))
    events = spark.createDataFrame(rows, "dataset_id long, ord long, at long, status string").select("dataset_id", "ord", F.timestamp_millis("at").alias("ts"), "status")
    parts = [events.where("ord % 3 = 2"), events.where("ord % 3 = 0"), events.where("ord % 3 = 1")]
    until = F.lit(base + 50 * hour - 100 * hour)
    wide = X.drain_in_turn([*parts, events.where("ord < 0")], lambda s: U.run_findings(s, lateness="100 hours"))
    assert sorted(map(tuple, wide.collect()), key=repr) == sorted(map(tuple, U.run_findings_batch(events, until).collect()), key=repr) == []
    later = spark.createDataFrame([(99, 999, base + 400 * hour, "complete")], "dataset_id long, ord long, at long, status string").select("dataset_id", "ord", F.timestamp_millis("at").alias("ts"), "status")
    got = X.drain_in_turn([*parts, later], lambda s: U.run_findings(s, lateness="100 hours"))
    want = U.run_findings_batch(events.unionByName(later), F.lit(base + 300 * hour))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    kinds = {(r["dataset_id"], r["kind"]) for r in got.collect()}
    assert {(2, "illegal"), (2, "stuck"), (3, "stuck"), (4, "stuck"), (5, "stuck")} <= kinds and not any(d in (1, 9, 99) for d, _ in kinds)


class _Entries:
    """A list or value of the state store that counts calls."""

    def __init__(self):
        self.held, self.calls = [], 0

    def _call(self, held=None):
        self.calls += 1
        if held is not None:
            self.held = list(held)
        return iter(self.held)

    def get(self):
        self._call()
        return iter(self.held) if isinstance(self, _List) else self.held[0]

    def exists(self):
        self._call()
        return bool(self.held)

    def clear(self):
        self._call([])


class _List(_Entries):
    def appendValue(self, value):
        self._call([*self.held, value])

    def appendList(self, values):
        self._call([*self.held, *values])

    def put(self, values):
        self._call(values)


class _Value(_Entries):
    def update(self, value):
        self._call([value])


class _Handle:
    def __init__(self):
        self.timers = []

    def getListState(self, name, schema):
        return _List()

    def getValueState(self, name, schema):
        return _Value()

    def registerTimer(self, at):
        self.timers.append(at)


def test_waiting_events_cost_calls_by_the_list(monkeypatch):
    """Thousands of events of a run, out of order, in a few calls to the state store; what waits on stays in lists."""
    monkeypatch.setattr(U, "CHUNK", 700, raising=False)
    n, run, handle = 5_000, U.RunState(10_800_000), _Handle()
    run.init(handle)
    at = [int(a) for a in np.random.default_rng(6).permutation(n) * 1_000 + 7]
    status = [U.STEPS[a // 1_000 % 3] for a in at]
    parts = [pd.DataFrame({"at_ms": at[i : i + 2_000], "ord": range(i, min(i + 2_000, n)), "status": status[i : i + 2_000]}) for i in range(0, n, 2_000)]
    list(run.handleInputRows((1,), iter([*parts, parts[0].head(0)]), None))
    assert run.waiting.calls <= 3 and handle.timers == [7]
    assert all(len(c) <= 700 for entry in run.waiting.held for c in entry)

    class Now:
        def __init__(self, at):
            self.at = at

        def getCurrentWatermarkInMs(self):
            return self.at

    found = [r for frame in run.handleExpiredTimer((1,), Now(3_000_000), None) for r in frame.itertuples(index=False)]
    assert [r.at_ms for r in found] == [a * 1_000 + 7 for a in range(3, 3_000, 3)] and {r.kind for r in found} == {"illegal"}
    assert sum(len(entry[0]) for entry in run.waiting.held) == 2_000 and handle.timers[1] == 3_000_007
    assert run.waiting.calls <= 6
    run.handle.timers.clear()
    assert list(run.handleExpiredTimer((1,), Now(3_000_000), None)) == []
