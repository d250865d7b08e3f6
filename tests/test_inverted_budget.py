"""Inverted lists against the exact search, and places of exact hits against plain sorting."""

import math
from collections import Counter

import numpy as np
import pytest

from recollect import MemoryConfig, hashing_embedder
from recollect.functions.signatures import planes
from recollect.operators import budget
from recollect.operators.approximate import recall
from recollect.operators.inverted import NO_LIST, InvertedLists
from recollect.operators.search import top_k

DIMS = 16
SMALL = MemoryConfig(embedder=hashing_embedder(DIMS), dimensions=DIMS)
MEMORY = "memory_id string, app_name string, user_id string, embedding array<float>"
QUERY = "query_id string, app_name string, user_id string, embedding array<float>"


@pytest.fixture(scope="module")
def clusters(spark):
    """Vectors around 40 centres; one tenant holds two thirds of them."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, DIMS))
    rows = [(f"m{n:05d}", "a", "hot" if n % 3 else f"u{n % 7}", (centres[n % 40] + rng.normal(size=DIMS) * 0.25).tolist()) for n in range(6000)]
    memories = spark.createDataFrame(rows, MEMORY).repartition(4).persist()
    queries = spark.createDataFrame([(r[0], *r[1:]) for r in rows[::20]], QUERY).persist()
    return queries, memories


@pytest.fixture(scope="module")
def lists(clusters, tmp_path_factory):
    return InvertedLists.create(clusters[1], str(tmp_path_factory.mktemp("lists") / "i"), SMALL, 32, per_list=30)


def test_recall_and_pruned_scan(clusters, lists):
    queries, memories = clusters
    exact, found = top_k(queries, memories, SMALL), lists.top_k(queries, SMALL, probes=4)
    shares = [r.recall for r in recall(exact, found).collect()]
    assert len(shares) == 300 and sum(shares) / len(shares) >= 0.9
    few = queries.limit(2)
    plan = lists.top_k(few, SMALL, probes=2)._jdf.queryExecution().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "embedding" in line]
    assert scans and all("PartitionFilters" in s and "list" in s.split("PartitionFilters")[1].split("]")[0] for s in scans)


def test_all_lists_give_the_exact_answer(clusters, lists):
    queries, memories = clusters
    asked = queries.limit(40)
    key = lambda df: sorted((r.query_id, r["rank"], r.memory_id, r.similarity) for r in df.collect())
    assert key(lists.top_k(asked, SMALL, probes=32)) == key(top_k(asked, memories, SMALL))


def test_lists_do_not_depend_on_the_deal(spark, clusters, lists, tmp_path):
    other = InvertedLists.create(clusters[1].repartition(11), str(tmp_path / "i"), SMALL, 32, per_list=30)
    assert (other.centroids == lists.centroids).all()
    assert sorted(lists.read().select("memory_id", "list").collect()) == sorted(other.read().select("memory_id", "list").collect())


def test_added_memories_odd_vectors_and_empty_tables(spark, tmp_path):
    rows = [(f"m{n}", "a", "u", [float(n % 5), 1.0] + [0.0] * 14) for n in range(50)]
    made = InvertedLists.create(spark.createDataFrame(rows, MEMORY), str(tmp_path / "i"), SMALL, 4)
    odd = [("zero", "a", "u", [0.0] * 16), ("short", "a", "u", [1.0]), ("none", "a", "u", None), ("new", "a", "u", [9.0, 9.0] + [0.0] * 14)]
    made.add(spark.createDataFrame(odd, MEMORY), SMALL)
    assert made.read().count() == 54
    assert {r.memory_id for r in made.read().filter(f"list = {NO_LIST}").collect()} == {"zero", "short", "none"}
    asked = spark.createDataFrame([("q", "a", "u", odd[3][3]), ("z", "a", "u", [0.0] * 16), ("other", "a", "v", odd[3][3])], QUERY)
    hits = made.top_k(asked, SMALL, probes=1).collect()
    assert [r.memory_id for r in hits if r.query_id == "q" and r["rank"] == 1][0] in {"m1", "m6", "new"}
    assert {(r.query_id, r.memory_id) for r in hits if r.query_id != "q"} == {("z", "zero")}
    empty = InvertedLists.create(spark.createDataFrame([], MEMORY), str(tmp_path / "e"), SMALL, 4)
    empty.add(spark.createDataFrame(rows[:3], MEMORY), SMALL)
    assert {r["list"] for r in empty.read().collect()} == {NO_LIST}
    assert empty.top_k(asked, SMALL).filter("query_id = 'q'").count() == 3


def signature(v):
    on = (np.asarray(v, np.float32).astype(float) @ planes(256, DIMS).astype(float)) > 1e-9
    return on


@pytest.mark.parametrize("blocks", [{}, {"memory_block": 20, "query_block": 3}])
def test_places_are_those_of_a_sorted_list(spark, blocks):
    rng = np.random.default_rng(8)
    pool = rng.normal(size=(60, DIMS))  # equal vectors, so ties by id
    rows = [(f"m{n:03d}", "a", "hot" if n % 4 else "cold", pool[rng.integers(60)].tolist()) for n in range(240)]
    asked = [(f"q{n}", "a", "hot" if n % 2 else "cold", rng.normal(size=DIMS).tolist()) for n in range(12)]
    memories, queries = spark.createDataFrame(rows, MEMORY), spark.createDataFrame(asked, QUERY)
    hits = top_k(queries, memories, SMALL)
    got = {(r.query_id, r.memory_id): r.place for r in budget.hit_places(hits, queries, memories, SMALL, **blocks).collect()}
    want = {}
    for q in asked:
        sign = signature(q[3])
        order = sorted(((signature(m[3]) != sign).sum(), m[0]) for m in rows if m[2] == q[2])
        want |= {(q[0], name): k for k, (_, name) in enumerate(order, 1)}
    assert len(got) == 60 and all(want[k] == place for k, place in got.items())


def test_curve_and_least_budgets(spark):
    places = [1] * 50 + [2] * 30 + [2000] * 15 + [5000] * 5
    curve = budget.budget_curve(spark.createDataFrame([(p,) for p in places], "place bigint"))
    got = {r.budget: r for r in curve.collect()}
    assert {b: r.hits for b, r in got.items()} == {1: 50, 2: 80, 2000: 95, 5000: 100}
    z, n = budget.DEVIATIONS, 100
    for b, c in Counter({1: 50, 2: 80, 2000: 95, 5000: 100}).items():
        p = c / n
        low = (p + z * z / 2 / n - z * math.sqrt((p * (1 - p) + z * z / 4 / n) / n)) / (1 + z * z / n)
        assert got[b].recall == p and got[b].at_least == pytest.approx(low, abs=1e-12)
    least = {r.target: (r.budget, r.safe_budget) for r in budget.least_budgets(curve, [0.5, 0.8, 0.95, 1.0]).collect()}
    assert least == {0.5: (1, 2), 0.8: (2, 2000), 0.95: (2000, 5000), 1.0: (5000, None)}
    assert budget.budget_curve(spark.createDataFrame([], "place bigint")).count() == 0
