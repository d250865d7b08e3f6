"""Distinct texts, rejected vectors, typed metadata and a key per field."""

from dataclasses import replace

import pytest
from helpers import CONFIG, DIMS, one
from pyspark.sql import functions as F

from recollect import batch_embedder, column_embedder, insert_memories, search
from recollect.functions import crypto, typed
from recollect.operators import distinct_texts, protect
from recollect.operators.distinct_texts import by_length, calls, embed_distinct
from recollect.operators.rejects import set_aside

NOW = "2024-03-01 08:00:00"
RING = crypto.key_ring(bytes(range(32)), [1, 2, 3])


def test_calls_are_cut_by_length_and_hold_like_texts():
    assert calls([5, None, 1, 3, 100, 2], 10, 3) == [[2, 5, 3], [0], [4]]
    assert calls([4, 4, 4], 8, 100) == [[0, 1], [2]]
    assert calls([], 8, 1) == calls([None], 8, 1) == []


@pytest.mark.parametrize("hot", [100_000, 3])
def test_each_text_is_sent_once(spark, monkeypatch, hot):
    monkeypatch.setattr(distinct_texts, "HOT_ROWS", hot)

    def model():
        def run(texts, _):
            assert sum(map(len, texts)) <= 50 or len(texts) == 1
            return [[float(len(t)), float(ord(t[0]) if t else 0)] for t in texts]

        return run

    texts = ["hello"] * 40 + [f"text {k % 7}" for k in range(30)] + ["", None, None, "x" * 200]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, stored_text string").repartition(3)
    config = replace(CONFIG, embedder=by_length(model, call_chars=50), dimensions=2, strict_embedding=False)
    done, sent = embed_distinct(rows, config)
    assert sent == 1 + 7 + 1 + 1 and done.columns == ["id", "stored_text", "embedding", "embedding_ok"]
    got = {r.id: (r.stored_text, r.embedding, r.embedding_ok) for r in done.collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        want = None if text is None else [float(len(text)), float(ord(text[0]) if text else 0)]
        assert got[k] == (text, want, text is not None)


def test_no_texts_at_all(spark):
    done, sent = embed_distinct(spark.createDataFrame([(1, None)], "id long, stored_text string"), CONFIG)
    assert sent == 0 and one(done).embedding is None


def test_bad_vectors_are_set_aside_and_the_rest_is_kept(spark):
    vectors = {"good": [1.0] * DIMS, "empty": [], "long": [1.0] * 40, "nan": [float("nan")] * DIMS, "inf": [1.0] * (DIMS - 1) + [float("inf")]}
    config = replace(CONFIG, embedder=batch_embedder(lambda: lambda texts, _: [vectors[t] for t in texts]), strict_embedding=False)
    entries = spark.createDataFrame(
        [("a", "u", None, [(name,)], None) for name in vectors],
        "app_name string, user_id string, author string, parts array<struct<text:string>>, custom_metadata map<string,string>",
    )
    checked = set_aside(insert_memories(entries, config, NOW), config)
    assert [r.transcript for r in checked.kept.collect()] == ["good"] and "reason" not in checked.kept.columns
    assert {r.transcript: r.reason for r in checked.rejected.collect()} == {
        "empty": "empty", "long": "wrong_length", "nan": "not_finite", "inf": "not_finite"
    }
    assert checked.counts == {"kept": 1, "missing": 0, "empty": 1, "wrong_length": 1, "not_finite": 2}


def test_nothing_to_check(spark):
    checked = set_aside(spark.createDataFrame([], "embedding array<float>"), CONFIG)
    assert checked.kept.count() == checked.rejected.count() == 0 and set(checked.counts.values()) == {0}
    missing = set_aside(spark.createDataFrame([(None,)], "embedding array<float>"), CONFIG)
    assert one(missing.rejected).reason == "missing"


def test_strict_mode_still_fails(spark):
    strict = replace(CONFIG, embedder=column_embedder(lambda text: F.array().cast("array<float>")))
    entries = spark.createDataFrame(
        [("a", "u", None, [("t",)], None)],
        "app_name string, user_id string, author string, parts array<struct<text:string>>, custom_metadata map<string,string>",
    )
    with pytest.raises(Exception, match="empty vector"):
        insert_memories(entries, strict, NOW).collect()


def test_values_keep_their_types(spark):
    rows = spark.createDataFrame([('{"n": 3, "s": "3", "f": 0.5, "b": true, "z": null, "o": {"k": [1]}}',), ("[1]",), (None,)], "j string")
    got = rows.select(typed.merge_typed(typed.from_json(F.col("j")), typed.typed_map({"n": 4, "new": "x", "none": None})).alias("m"))
    full, *rest = got.select(
        typed.value_of(F.col("m"), "n", "bigint").alias("n"), typed.value_of(F.col("m"), "s", "boolean").alias("s"),
        typed.value_of(F.col("m"), "missing", "string").alias("missing"), typed.as_strings(F.col("m")).alias("text"),
    ).collect()
    assert (full.n, full.s, full.missing) == (4, None, None)
    assert full.text == {"n": "4", "s": "3", "f": "0.5", "b": "true", "z": "null", "o": '{"k":[1]}', "new": "x"}
    assert [r.text for r in rest] == [{"n": "4", "new": "x"}] * 2


def test_a_search_over_typed_metadata_gives_a_number(spark):
    entries = spark.createDataFrame([("a", "u", None, [("hello there",)], '{"k": 1}')], "app_name string, user_id string, author string, parts array<struct<text:string>>, j string")
    entries = entries.withColumn("custom_metadata", typed.from_json(F.col("j"))).drop("j")
    memories = insert_memories(entries, CONFIG, NOW, {"batch": 2})
    asked = spark.createDataFrame([("q", "a", "u", "hello")], "query_id string, app_name string, user_id string, query string")
    hit = one(search(asked, memories, CONFIG).select("score", *[typed.value_of(F.col("custom_metadata"), n, k).alias(a) for n, k, a in (
        ("score", "double", "s"), ("k", "int", "k"), ("batch", "int", "b"), ("source", "string", "source"), ("session_id", "string", "session"))]))
    assert (hit.s, hit.k, hit.b, hit.source, hit.session) == (hit.score, 1, 2, "add_memory", None)


RULES = {"ssn": protect.FieldRule(crypto.DETERMINISTIC, 1), "note": protect.FieldRule(crypto.RANDOM, 2)}


def secured(spark):
    rows = spark.createDataFrame(
        [(1, {"ssn": "1", "note": "n", "open": "o"}, None), (2, {"ssn": "1"}, None), (3, None, None), (4, {"note": ""}, {"old": bytearray(b"x")})],
        "id long, custom_metadata map<string,string>, secure_metadata map<string,binary>",
    )
    return protect.encrypt_by_rules(rows, RULES, RING)


def test_each_field_has_its_own_key(spark):
    rows = {r.id: r for r in protect.decrypt_by_ring_fields(secured(spark), ["ssn", "note"], RING).collect()}
    assert [(rows[k].ssn, rows[k].note) for k in (1, 2, 3, 4)] == [("1", "n"), ("1", None), (None, None), (None, "")]
    assert rows[1].custom_metadata == {"open": "o"} and set(rows[4].secure_metadata) == {"old", "note"}
    assert rows[1].secure_metadata["ssn"] == rows[2].secure_metadata["ssn"], "deterministic under one key"
    assert {bytes(rows[1].secure_metadata[f][:4]).hex() for f in RULES} == {"00000001", "00000002"}
    lacking = one(protect.decrypt_by_ring_fields(secured(spark).filter("id = 1"), ["ssn", "note"], {2: RING[2]}))
    assert (lacking.ssn, lacking.note) == (None, "n")
    forged = secured(spark).filter("id = 1").withColumn("ct", F.concat(F.unhex(F.lit("00000002")), F.substring(F.col("secure_metadata")["ssn"], 5, 999)))
    assert one(forged.select(crypto.decrypt_by_ring(F.col("ct"), RING, F.lit("ssn")).alias("x"))).x is None
    with pytest.raises(ValueError, match="no key 9"):
        protect.encrypt_by_rules(secured(spark), {"open": protect.FieldRule(crypto.RANDOM, 9)}, RING)


def test_rotation_re_encrypts_what_is_old_and_loses_nothing(spark):
    before = {r.id: r.secure_metadata for r in secured(spark).collect()}
    rules = RULES | {"ssn": protect.FieldRule(crypto.DETERMINISTIC, 3)}
    rows = spark.createDataFrame(list(before.items()), "id long, secure_metadata map<string,binary>")
    after = {r.id: r for r in protect.decrypt_by_ring_fields(protect.rotate(rows, rules, RING), ["ssn", "note"], RING).collect()}
    assert [(after[k].ssn, after[k].note) for k in (1, 2, 3, 4)] == [("1", "n"), ("1", None), (None, None), (None, "")]
    assert bytes(after[1].secure_metadata["ssn"][:4]).hex() == "00000003" and after[1].secure_metadata["note"] == before[1]["note"]
    assert after[4].secure_metadata["old"] == bytearray(b"x")
    blind = {r.id: r.secure_metadata for r in protect.rotate(rows, rules, {2: RING[2], 3: RING[3]}).collect()}
    assert blind == before, "what cannot be read is left alone"
