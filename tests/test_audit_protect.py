import hashlib
import hmac
from dataclasses import replace

import pytest
from helpers import CONFIG, one, questions, session
from pyspark.sql import functions as F

from recollect import ingest_sessions, search
from recollect.functions import crypto
from recollect.operators import audit, protect
from recollect.operators.retention import expired, live, retention_report

NOW = "2024-03-01 08:00:00"
KEY = bytes(range(32))
OTHER = bytes(32)


def two_tenants(spark):
    ann = session(spark, [("user", "my dog is Rex")], "hint", user="ann")
    bob = session(spark, [("user", "my cat is Mittens")], "hint", user="bob")
    return ingest_sessions(ann.unionByName(bob), CONFIG, NOW)


def test_isolation_report(spark):
    memories = two_tenants(spark)
    asked = questions(spark, ("1", "app", "ann", "pet"), ("2", "app", "bob", "pet"))
    clean = audit.isolation_report(search(asked, memories, CONFIG), asked, memories)
    assert {(r.user_id, r.leaks, r.self_misses) for r in clean.collect()} == {("ann", 0, 0), ("bob", 0, 0)}
    bobs = memories.filter("user_id = 'bob'").first().memory_id
    leaky = spark.createDataFrame(
        [("app", "ann", "1", bobs), ("app", "bob", "2", bobs)], "app_name string, user_id string, query_id string, memory_id string"
    )
    report = {r.user_id: r for r in audit.isolation_report(leaky, asked, memories).collect()}
    assert (report["ann"].leaks, report["ann"].self_misses) == (1, 1)
    assert (report["bob"].leaks, report["bob"].self_misses) == (0, 0)
    nothing = leaky.limit(0)
    empty = audit.isolation_report(nothing, asked, memories).collect()
    assert all((r.leaks, r.self_misses) == (0, 1) for r in empty)


def test_uniqueness_ignores_direct_memories(spark):
    memories = two_tenants(spark)
    direct = memories.withColumn("session_id", F.lit(None).cast("string"))
    assert audit.duplicate_sessions(memories.unionByName(direct).unionByName(direct)).isEmpty()
    twice = memories.unionByName(memories.filter("user_id = 'ann'"))
    assert one(audit.duplicate_sessions(twice)).copies == 2


def test_coverage_and_freshness(spark):
    memories = two_tenants(spark)
    short = memories.withColumn("embedding", F.slice("embedding", 1, 2))
    got = one(audit.coverage(memories.unionByName(short), CONFIG))
    assert (got.memories, got.searchable, got.wrong_length) == (4, 2, 2)
    asked = questions(spark, ("1", "app", "ann", "pet"), ("2", "app", "carol", "pet"))
    found = search(asked, memories, CONFIG)
    assert {r.query_id: r.ready for r in audit.freshness(found, asked).collect()} == {"1": True, "2": False}


def test_retention(spark):
    rows = spark.createDataFrame(
        [("a", "u", "2024-01-01 00:00:00"), ("b", "u", "2024-01-31 00:00:00"), ("c", "u", None)],
        "app_name string, user_id string, t string",
    ).withColumn("updated_at", F.col("t").cast("timestamp"))
    thirty = 2_592_000
    kept = {r.app_name for r in live(rows, thirty, "2024-02-01").collect()}
    assert kept == {"b", "c"}
    assert [r.app_name for r in expired(rows, thirty, "2024-02-01").collect()] == ["a"]
    assert live(rows, None, "2034-01-01").count() == 3 and expired(rows, None, NOW).isEmpty()
    assert live(rows, thirty, "2024-01-31").filter("app_name = 'a'").isEmpty(), "the end is exclusive"
    report = {r.app_name: r for r in retention_report(rows, thirty, "2024-02-01").collect()}
    assert (report["a"].live, report["a"].expired, report["a"].next_expiry) == (0, 1, None)
    assert str(report["b"].next_expiry) == "2024-03-01 00:00:00"


def test_hmac_matches_the_standard_library(spark):
    for key in (KEY, b"k", b"x" * 64):
        got = spark.range(1).select(crypto.hmac_sha256(key, F.lit("päyload"))).first()[0]
        assert bytes(got) == hmac.new(key, "päyload".encode(), hashlib.sha256).digest()


def secured(spark, policy):
    rows = spark.createDataFrame(
        [("1", {"ssn": "123-45-6789", "lang": "en"}), ("2", {"ssn": "123-45-6789"}), ("3", {"lang": "de"}), ("4", None)],
        "memory_id string, custom_metadata map<string,string>",
    ).withColumn("secure_metadata", F.lit(None).cast("map<string,binary>"))
    return protect.encrypt_fields(rows, policy, KEY)


@pytest.mark.parametrize("algorithm", [crypto.DETERMINISTIC, crypto.RANDOM])
def test_fields_are_moved_and_come_back(spark, algorithm):
    rows = secured(spark, {"ssn": algorithm}).orderBy("memory_id").collect()
    assert [r.custom_metadata for r in rows] == [{"lang": "en"}, {}, {"lang": "de"}, {}]
    assert [set(r.secure_metadata) for r in rows] == [{"ssn"}, {"ssn"}, set(), set()]
    same = rows[0].secure_metadata["ssn"] == rows[1].secure_metadata["ssn"]
    assert same == (algorithm == crypto.DETERMINISTIC)
    df = secured(spark, {"ssn": algorithm})
    opened = [r[0] for r in df.orderBy("memory_id").select(protect.decrypt_field("ssn", KEY)).collect()]
    assert opened == ["123-45-6789", "123-45-6789", None, None]
    assert all(r[0] is None for r in df.select(protect.decrypt_field("ssn", OTHER)).collect())


def test_encrypting_twice_keeps_earlier_fields(spark):
    rows = secured(spark, {"ssn": crypto.RANDOM})
    both = protect.encrypt_fields(rows, {"lang": crypto.DETERMINISTIC}, KEY)
    first = both.filter("memory_id = '1'").first()
    assert set(first.secure_metadata) == {"ssn", "lang"} and first.custom_metadata == {}


def test_lookup_report_and_exposure(spark):
    rows = secured(spark, {"ssn": crypto.DETERMINISTIC})
    probes = spark.createDataFrame([("123-45-6789",), ("000-00-0000",)], "value string")
    assert sorted(r.memory_id for r in protect.lookup_encrypted(rows, probes, "ssn", KEY).collect()) == ["1", "2"]
    ct = F.col("secure_metadata")["ssn"]
    plain = F.when(ct.isNotNull(), F.lit("123-45-6789"))
    got = one(protect.ciphertext_report(rows, ct, plain, KEY, "ssn"))
    assert (got.present, got.in_clear, got.round_trips) == (2, 0, 2)
    clear = one(protect.ciphertext_report(rows, F.encode(plain, "utf-8"), plain, KEY, "ssn"))
    assert (clear.in_clear, clear.round_trips) == (2, 0)
    texts = spark.createDataFrame([("my id is 1-2",), ("nothing",)], "transcript string")
    assert protect.exposure(texts, F.lit("1-2")).count() == 1
    assert protect.exposure(texts, F.lit("")).isEmpty()


def test_key_comes_from_the_configuration(spark):
    spark.conf.unset(crypto.KEY_CONF)
    with pytest.raises(ValueError, match="32-byte"):
        crypto.key_from_conf(spark)
    spark.conf.set(crypto.KEY_CONF, "ab")
    with pytest.raises(ValueError, match="32 bytes"):
        crypto.key_from_conf(spark)
    spark.conf.set(crypto.KEY_CONF, KEY.hex())
    assert crypto.key_from_conf(spark) == KEY
    spark.conf.unset(crypto.KEY_CONF)


def test_audit_of_a_similarity_other_than_the_default(spark):
    memories = two_tenants(spark)
    asked = questions(spark, ("1", "app", "ann", "my dog is Rex"))
    for metric in ("euclidean", "dotProduct"):
        got = one(search(asked, memories, replace(CONFIG, similarity=metric)))
        assert 0 < got.score <= 1
