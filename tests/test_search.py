from dataclasses import replace

import numpy as np
import pytest
from helpers import CONFIG, one, questions, session

from recollect import ingest_sessions, insert_memories, schema, search, search_memory
from recollect.operators import approximate
from recollect.operators.nearest import arranged, nearest
from recollect.operators.search import top_k

NOW = "2024-03-01 08:00:00"


def brute_force(queries, memories, k, metric):
    """(query, rank) -> memory, from plain numpy."""
    out = {}
    for q in queries:
        scored = []
        for m in memories:
            if (q[1], q[2]) != (m[1], m[2]):
                continue
            a, b = np.float32(q[3]).astype(float), np.float32(m[3]).astype(float)
            if metric == "euclidean":
                s = -np.sqrt(((a - b) ** 2).sum())
            else:
                s = a @ b
                if metric == "cosine":
                    size = np.linalg.norm(a) * np.linalg.norm(b)
                    s = s / size if size else 0.0
            scored.append((-round(s, 9), m[0]))
        for rank, (_, name) in enumerate(sorted(scored)[:k], 1):
            out[q[0], rank] = name
    return out


@pytest.fixture(scope="module")
def skewed():
    """One tenant holds most memories and most queries; many vectors are equal."""
    rng = np.random.default_rng(11)
    tenants = [("a", "hot")] * 400 + [("a", f"u{n % 30}") for n in range(200)]
    pool = rng.normal(size=(150, 8))
    memories = [(f"m{n:04d}", *t, pool[rng.integers(150)].tolist()) for n, t in enumerate(tenants)]
    memories.append(("m9999", "a", "hot", [0.0] * 8))
    queries = [(f"q{n}", "a", "hot", rng.normal(size=8).tolist()) for n in range(60)]
    queries += [(f"r{n}", "a", f"u{n % 30}", pool[n].tolist()) for n in range(40)]
    queries += [("lost", "a", "nobody", [1.0] * 8)]
    return queries, memories


def frames(spark, skewed):
    queries, memories = skewed
    return (
        spark.createDataFrame(queries, "query_id string, app_name string, user_id string, embedding array<float>"),
        spark.createDataFrame(memories, "memory_id string, app_name string, user_id string, embedding array<float>"),
    )


@pytest.mark.parametrize("metric", ["cosine", "dotProduct", "euclidean"])
@pytest.mark.parametrize("blocks", [(100_000, 2_000), (16, 7)])
def test_nearest_equals_brute_force(spark, skewed, metric, blocks):
    q, m = frames(spark, skewed)
    hits = nearest(q, m, 4, metric, 8, memory_block=blocks[0], query_block=blocks[1])
    got = {(r.query_id, r["rank"]): r.memory_id for r in hits.collect()}
    assert got == brute_force(*skewed, 4, metric)


def test_small_tiles_and_arrow_batches_change_nothing(spark, skewed, monkeypatch):
    q, m = frames(spark, skewed)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "17")
    try:
        hits = nearest(q, m, 7, "cosine", 8).collect()
    finally:
        spark.conf.set(name, before)
    assert {(r.query_id, r["rank"]): r.memory_id for r in hits} == brute_force(*skewed, 7, "cosine")


def test_candidates_are_the_tenants_own_and_a_large_budget_is_exact(spark, skewed):
    q, m = frames(spark, skewed)
    config = replace(CONFIG, dimensions=8, candidates_multiplier=1000)
    got = {(r.query_id, r["rank"]): r.memory_id for r in top_k(q, m, config, "approximate").collect()}
    assert got == brute_force(*skewed, 5, "cosine")
    tight = replace(config, candidates_multiplier=4)
    near = approximate.recall(top_k(q, m, tight), top_k(q, m, tight, "approximate"))
    assert near.selectExpr("avg(recall)").first()[0] > 0.6


def test_vectors_of_another_length_take_no_part(spark):
    m = spark.createDataFrame(
        [("x", "a", "u", [1.0, 0.0]), ("y", "a", "u", [1.0]), ("z", "a", "u", None)],
        "memory_id string, app_name string, user_id string, embedding array<float>",
    )
    q = m.withColumnRenamed("memory_id", "query_id")
    assert [(r.query_id, r.memory_id) for r in nearest(q, m, 5, "cosine", 2).collect()] == [("x", "x")]


def remembered(spark):
    talks = [
        ("s1", "app", "alice", [("user", "My favourite language for coding is Rust.")]),
        ("s2", "app", "alice", [("user", "In the morning I run along the river.")]),
        ("hint", "bot", "alice", [("user", "My dog is called Rex.")]),
        ("hint", "bot", "bob", [("user", "My cat is called Mittens.")]),
    ]
    parts = [session(spark, t, sid, app, user) for sid, app, user, t in talks]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return ingest_sessions(rows, CONFIG, NOW)


def test_search_ranks_and_isolates(spark):
    asked = questions(
        spark,
        ("1", "app", "alice", "Which coding language is my favourite?"),
        ("2", "bot", "alice", "What is my pet called?"),
        ("3", "bot", "bob", "What is my pet called?"),
        ("4", "bot", "bob", " \n"),
        ("5", "bot", "carol", "What is my pet called?"),
    )
    got = search(asked, remembered(spark), CONFIG).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"]) for r in got] == [("1", 1), ("1", 2), ("2", 1), ("3", 1)]
    assert "Rust" in got[0].text and "Rex" in got[2].text and "Mittens" in got[3].text
    assert (got[0].role, got[0].author) == ("model", "memory")
    assert got[0].timestamp == "2024-03-01T08:00:00+00:00"
    assert got[0].custom_metadata["session_id"] == "s1"
    assert float(got[0].custom_metadata["score"]) == got[0].score > got[1].score
    assert list(got[0].asDict()) == schema.RESULTS.fieldNames()


def test_one_question_equals_the_table_of_questions(spark):
    memories = remembered(spark)
    text = "Which coding language is my favourite?"
    many = search(questions(spark, ("0", "app", "alice", text)), memories, CONFIG).collect()
    single = search_memory(memories, CONFIG, "app", "alice", text).collect()
    assert sorted(many) == sorted(single)
    assert search_memory(memories, CONFIG, "app", "alice", " ").isEmpty()


def test_stored_metadata_overrides_the_map_but_not_the_score(spark):
    rows = spark.createDataFrame(
        [("app", "ann", None, [("likes tea",)], {"score": "high", "source": "crm"})],
        schema.DIRECT_MEMORIES,
    )
    memories = insert_memories(rows, CONFIG, NOW)
    got = one(search(questions(spark, ("1", "app", "ann", "tea")), memories, CONFIG))
    assert got.custom_metadata["score"] == "high" and got.custom_metadata["source"] == "crm"
    assert got.custom_metadata["session_id"] is None and 0 < got.score <= 1


def test_expired_rows_are_found_unless_asked_not_to(spark):
    config = replace(CONFIG, ttl_seconds=3600)
    asked = questions(spark, ("1", "app", "alice", "river"))
    assert search(asked, remembered(spark), config).count() == 2
    assert search(asked, remembered(spark), config, now="2024-03-02").isEmpty()


@pytest.mark.parametrize("n", [200, 400])
def test_repeats_of_small_blocks_do_not_grow_with_the_table(spark, n):
    rng = np.random.default_rng(n)
    rows = [(f"m{k:04d}", "a", "u", rng.normal(size=4).tolist()) for k in range(n)]
    memories = spark.createDataFrame(rows, "memory_id string, app_name string, user_id string, embedding array<float>")
    queries = memories.withColumnRenamed("memory_id", "query_id")
    parts = arranged(queries, memories, "embedding", (4, 4), 5, 4)
    assert parts.count() <= 2 * 8 * n and parts.select("_m", "_q").distinct().count() == 64
    cut, whole = (sorted(map(tuple, nearest(queries, memories, 3, "cosine", 4, **b).collect())) for b in ({"memory_block": 5, "query_block": 4}, {}))
    assert cut == whole and len(cut) == 3 * n
