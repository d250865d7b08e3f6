"""Any protected value in any text of its tenant, against Python's ``in``."""

import random

import pytest

from recollect.operators import protect

TENANT = ["app_name", "user_id"]
VALUE = "app_name string, user_id string, value string"
TEXT = "app_name string, user_id string, memory_id string, transcript string"


def brute(texts, values):
    return {(t[0], t[1], t[2], v[2]) for t in texts for v in values if t[:2] == v[:2] and v[2] and t[3] and v[2] in t[3]}


def found(spark, texts, values, **options):
    got = protect.exposed_values(spark.createDataFrame(texts, TEXT).repartition(3), spark.createDataFrame(values, VALUE), TENANT, **options)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def many(seed=4):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abé語 \U0001f600") for _ in range(n))
    texts = [("a", f"u{k % 3}", f"m{k}", word(rng.randrange(0, 60))) for k in range(120)]
    values = [("a", f"u{k % 4}", word(rng.randrange(1, 9))) for k in range(60)]
    values += [(t[0], t[1], t[3][3:20]) for t in texts[::7]]
    return texts, values


@pytest.mark.parametrize("length", [1, 3, 6, 50])
def test_equals_brute_force(spark, length):
    texts, values = many()
    assert found(spark, texts, values, length=length) == brute(texts, values) != set()


def test_too_many_substrings_to_send(spark, monkeypatch):
    monkeypatch.setattr(protect, "BROADCAST_GRAMS", 2)
    texts, values = many(5)
    assert found(spark, texts, values) == brute(texts, values)


def test_other_tenants_nulls_and_empty_tables(spark):
    texts = [("a", "u", "1", "call 123-45-6789 now"), ("a", "v", "2", "call 123-45-6789 now"), ("a", "u", "3", None), ("a", "u", "4", "")]
    values = [("a", "u", "123-45-6789"), ("a", "u", None), ("a", "u", ""), ("a", "u", "123-45-6789"), ("b", "v", "call")]
    assert found(spark, texts, values) == {("a", "u", "1", "123-45-6789")}
    assert found(spark, texts, [("a", "u", "")]) == set() == found(spark, [], values) == found(spark, texts, [])


def test_texts_are_not_joined_with_values(spark):
    texts, values = many()
    got = protect.exposed_values(spark.createDataFrame(texts, TEXT), spark.createDataFrame(values, VALUE), TENANT)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_a_long_text(spark):
    text = "x" * 2_000_000 + "secret-value" + "y" * 100
    assert found(spark, [("a", "u", "1", text)], [("a", "u", "secret-value"), ("a", "u", "secret-other")]) == {("a", "u", "1", "secret-value")}
