import random
import re

import pytest
from pyspark.sql import functions as F

from recollect.llm import linking, near_dup, store

from .corpus import messy, near, prose, table


def shingles(text, width):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def brute(rows, width, percent=80):
    """Component number of each row."""
    sets = [shingles(r[1], width) for r in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return sets, [find(k) for k in range(len(rows))]


def groups():
    rng = random.Random(5)
    rows = [(k, prose(rng, rng.randint(1, 120))) for k in range(150)]
    base = prose(rng, 200)
    rows += [(200 + k, near(rng, base, rng.randint(0, 12))) for k in range(120)]
    rows += [(400 + k, base) for k in range(80)]
    rows += [(500 + k, rows[k][1].upper()) for k in range(20)]
    return rows


def template():
    """Variants of one text, most of them less similar than linked, each with a twin."""
    rng = random.Random(9)
    base, rows = prose(rng, 200, 5000), []
    for k in range(600):
        own = near(rng, base, 7)
        rows += [(2 * k, own), (2 * k + 1, near(rng, own, 9))]
    return rows


def equals(got, rows, width=2):
    sets, root = brute(rows, width)
    least = {}
    for r, c in zip(rows, root):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    want = sorted(
        ((r[0], len(s), least.get(c) if s else r[0]) for r, s, c in zip(rows, sets, root)), key=str
    )
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_no_link_is_lost_in_a_crowded_bucket(spark):
    equals(near_dup.near_duplicates(table(spark, template())).collect(), template())


def test_blocks_and_shrinking_stars(spark, monkeypatch):
    """The ways that only very large buckets go."""
    for name, value in {"OPEN": 7, "WHOLE": 20, "HEAVY": 200, "CENTRES": 2, "DENSE": 64}.items():
        monkeypatch.setattr(linking, name, value)
    monkeypatch.setattr("recollect.llm.store.BROADCAST_ROWS", 0)
    rows = template()[:300] + groups()[150:270]
    rows = [(k, text) for k, (_, text) in enumerate(rows)]
    equals(near_dup.near_duplicates(table(spark, rows)).collect(), rows)


def test_comparing_rows_by_matrix_and_one_by_one():
    import numpy as np

    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40))) for _ in range(40)]
    values, bounds = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    for left in (np.array([3]), np.arange(0, 20), np.array([], int)):
        right = np.arange(10, 40)
        want = [[len(np.intersect1d(sets[a], sets[b])) for b in right] for a in left]
        assert linking._shared(values, bounds, left, right).tolist() == want


@pytest.mark.parametrize("rows", [groups(), messy()], ids=["groups", "messy"])
def test_equals_brute_force(spark, rows):
    equals(near_dup.near_duplicates(table(spark, rows)).collect(), rows)


def test_bands_are_not_joined_and_texts_are_shuffled(spark, monkeypatch, capsys):
    """Bands come along with the first of equal rows, and tasks get texts, not hashes of shingles."""
    seen = []

    def watched(buckets, sets_of, *rest):
        capsys.readouterr()
        buckets.explain()
        seen.append((capsys.readouterr().out, sets_of(buckets.select("uid").distinct(), True).schema["items"].dataType.simpleString()))
        return linking.link(buckets, sets_of, *rest)

    monkeypatch.setattr(near_dup, "link", watched)
    equals(near_dup.near_duplicates(table(spark, groups())).collect(), groups())
    (plan, items), = seen
    assert "Join" not in plan and items == "string"


def test_one_row_of_each_group_stays_whole(spark):
    rows = groups() + messy()
    docs = table(spark, rows)
    out = near_dup.drop_near_duplicates(docs, width=5)
    assert out.columns == docs.columns
    sets, root = brute(rows, 5)
    assert out.count() == len({c for s, c in zip(sets, root) if s}) + sum(not s for s in sets)


def test_empty_table(spark):
    docs = table(spark, [])
    assert near_dup.near_duplicates(docs).count() == 0
    assert near_dup.drop_near_duplicates(docs).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(1000, 1000 + k) for k in range(1, 60)] + [(5, 5)]
    got = linking.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in got} == {(k, 0) for k in range(41)} | {(1000 + k, 1000) for k in range(60)}


def test_densified_signatures_estimate_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    probes = near_dup._probes(180)
    for size in (3, 20, 400):
        same = []
        for _ in range(60):
            common = rng.integers(0, 2**64 - 1, size * 8 // 10 + 1, dtype=np.uint64)
            sets = [np.unique(np.append(common, rng.integers(0, 2**64 - 1, size // 10 + 1, dtype=np.uint64))) for _ in range(2)]
            table = [near_dup._signatures(s, np.array([0, len(s)]), 180, probes)[0] for s in sets]
            union = len(np.union1d(*sets))
            same.append((table[0] == table[1]).mean() - len(np.intersect1d(*sets)) / union)
        assert abs(np.mean(same)) < 0.06


@pytest.mark.parametrize("share", [3, 10_000])
def test_large_tables_of_least_rows_are_not_repeated_for_a_broadcast(spark, monkeypatch, share):
    """A key's least row went to 32 tasks by an explode, and Spark broadcast all 32 by the size of the file."""
    monkeypatch.setattr(store, "BROADCAST_ROWS", 50)
    monkeypatch.setattr(store, "HEAVY", share)
    rows = [(k, k if k % 2 else 0, k * 7919 % 1000) for k in range(1000)]
    members = store.stored(spark.createDataFrame(rows, "uid long, root long, x long"), "members")
    done = linking.with_least(members, F.struct("x", "uid"), "head")
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "explode" not in plan
    least = {}
    for uid, root, x in rows:
        least[root] = min(least.get(root, (x, uid)), (x, uid))
    got = sorted((r.uid, r.root, r.x, tuple(r.head)) for r in done.collect())
    assert got == sorted((uid, root, x, least[root]) for uid, root, x in rows)


def test_exploded_tasks_are_not_broadcast_by_estimate(spark):
    tasks = spark.range(20).select(F.explode(F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))).alias("t"), F.col("id").alias("uid"), F.lit(0).alias("side"), F.col("id").alias("label"))
    sets = store.stored(spark.range(20).select(F.col("id").alias("uid"), F.lit("a b").alias("items")), "sets")
    plan = linking._compared(tasks, sets, near_dup._shingle_sets(2), 80)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
