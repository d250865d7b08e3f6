import hashlib
from dataclasses import replace

import numpy as np
import pytest
from helpers import CONFIG, DIMS, session
from pyspark.sql import functions as F

from recollect import MemoryConfig, batch_embedder, column_embedder, ingest_sessions
from recollect.functions import vectors as vx
from recollect.functions.signatures import planes, signature
from recollect.operators.embedding import embed
from recollect.plans.embedding import QUERIES


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "text string")


def test_config_is_checked():
    with pytest.raises(ValueError, match="embedder"):
        MemoryConfig()
    for wrong in ({"similarity": "l1"}, {"search_limit": 0}, {"dimensions": 0}, {"ttl_seconds": -1}):
        with pytest.raises(ValueError):
            replace(CONFIG, **wrong)
    assert replace(CONFIG, candidates_multiplier=0).num_candidates == CONFIG.search_limit
    assert CONFIG.num_candidates == 100


def test_hashing_embedder(spark):
    rows = embed(texts(spark, "Red red, BLUE!", "blue red red", "?!", None), CONFIG, "text").collect()
    assert rows[0].embedding == rows[1].embedding
    assert np.linalg.norm(rows[0].embedding) == pytest.approx(1, abs=1e-6)
    assert sorted(set(rows[0].embedding))[-2:] == pytest.approx([1 / 5**0.5, 2 / 5**0.5])
    assert rows[2].embedding == [0.0] * DIMS
    assert rows[3].embedding is None and rows[3].embedding_ok is False


def test_model_gets_batches_and_never_a_null(spark):
    def model():
        def run(batch, input_type):
            assert None not in batch and len(batch) <= 2
            return [[float(len(batch)), float(input_type == "query")] for _ in batch]

        return run

    config = replace(CONFIG, embedder=batch_embedder(model, batch_size=2), dimensions=2)
    df = texts(spark, "a", None, "b", "c").coalesce(1)
    got = [r.embedding for r in embed(df, config, "text", "query").collect()]
    assert got == [[2.0, 1.0], None, [2.0, 1.0], [1.0, 1.0]]


def test_empty_vector_is_an_error_only_in_strict_mode(spark):
    empty = column_embedder(lambda t: F.array().cast("array<float>"))
    config = replace(CONFIG, embedder=empty)
    with pytest.raises(Exception, match="empty vector"):
        embed(texts(spark, "a"), config, "text").collect()
    loose = embed(texts(spark, "a"), replace(config, strict_embedding=False), "text").first()
    assert loose.embedding == [] and loose.embedding_ok is False


def test_unchanged_text_is_not_embedded_again(spark):
    def counting():
        def run(batch, _):
            assert all("new" in t for t in batch), batch
            return [[1.0] for _ in batch]

        return run

    first = replace(CONFIG, embedder=column_embedder(lambda t: F.array(F.lit(0).cast("float"))), dimensions=1, signature_bits=None)
    second = replace(first, embedder=batch_embedder(counting))
    old = session(spark, [("user", "old")], "a").unionByName(session(spark, [("user", "old")], "b"))
    stored = ingest_sessions(old, first, "2024-01-01")
    again = session(spark, [("user", "old")], "a").unionByName(session(spark, [("user", "new")], "b"))
    got = {r.session_id: r.embedding for r in ingest_sessions(again, second, "2024-01-02", stored).collect()}
    assert got == {"a": [0.0], "b": [1.0]}


@pytest.mark.parametrize("metric", ["cosine", "dotProduct", "euclidean"])
def test_column_and_batch_similarity_agree(spark, metric):
    rng = np.random.default_rng(3)
    rows = [(rng.normal(size=8).tolist(), rng.normal(size=8).tolist()) for _ in range(50)]
    rows.append(([0.0] * 8, rows[0][1]))
    df = spark.createDataFrame(rows, "a array<float>, b array<float>")
    got = df.select(
        vx.similarity(metric, F.col("a"), F.col("b")).alias("x"),
        vx.similarity_in_batches(metric)("a", "b").alias("y"),
    ).toPandas()
    assert np.allclose(got.x, got.y, atol=2e-9)


def test_signature_bits(spark):
    rng = np.random.default_rng(5)
    vectors = [rng.normal(size=16).tolist() for _ in range(20)]
    df = spark.createDataFrame([(n, v) for n, v in enumerate(vectors)] + [(99, [1.0]), (100, None)], "id int, v array<float>")
    got = {r.id: r.s for r in df.select("id", signature(F.col("v"), 16, 128).alias("s")).collect()}
    assert got[99] is None and got[100] is None
    on = np.float32(vectors) @ planes(128, 16) > 0
    for n in range(20):
        bits = [(int(w) & (2**64 - 1)) >> b & 1 for w in got[n] for b in range(64)]
        assert bits == on[n].astype(int).tolist()
    a, b = F.array(F.lit(-1), F.lit(0)), F.array(F.lit(0), F.lit(3))
    distance = vx.hamming_distance(a.cast("array<bigint>"), b.cast("array<bigint>"))
    assert spark.range(1).select(distance).first()[0] == 66


def test_hashing_embedder_costs_a_text_once(spark, tmp_path, capfd):
    spark.createDataFrame([(1, "Été à l'été İstanbul  x_y ΣΑΣ"), (2, None), (3, "?!")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    cells = QUERIES["e5_hashing_embedder"][0](spark, str(tmp_path))
    cells.explain()
    # one pass per batch, not a comparison of each word for each dimension, and not twice
    plan = capfd.readouterr().out
    assert plan.count("ArrowEvalPython") == 1 and "array_remove" not in plan
    words = "été à l été i̇stanbul x y σας".replace("\u0307", " ").split()
    counts = {}
    for w in words:
        d = int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 64
        counts[d] = counts.get(d, 0) + 1
    size = sum(n * n for n in counts.values()) ** 0.5
    assert {(r.doc_id, r.dim): r.value for r in cells.collect()} == {(1, d): float(np.float32(n / size)) for d, n in counts.items()}
