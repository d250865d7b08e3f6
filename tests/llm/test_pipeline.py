import re

import duckdb
import pytest

import corpus_pipeline
from recollect.llm import queries
from recollect.llm.sql import SQL

from . import test_line_dedup, test_near_dup, test_scans
from .corpus import SCHEMA, messy, prose

SF = "/root/testdata/sf0.001"


def through(spark, sf_dir, folder):
    """Each stage's input and output, written and read again in between."""
    docs, found = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        found.append((docs, spark.read.parquet(f"{folder}/{k}")))
        docs = found[-1][1]
    return found


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    return through(spark, SF, tmp_path_factory.mktemp("stages"))


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_rules(stages):
    before, after = map(rows, stages[0])
    counts = {k: test_scans.counts(r.text) for k, r in before.items()}
    assert set(after) == {k for k, c in counts.items() if c[0] >= 20 and 100 * c[4] <= 30 * c[0]}


def test_lines(stages):
    before, after = map(rows, stages[1])
    data = sorted((r.doc_id, r.text) for r in before.values())
    gone = {}
    for group in test_line_dedup.brute(data).values():
        for line in sorted(group)[1:]:
            gone.setdefault(line[1], set()).add(line[3])
    for key, text in data:
        left = "\n".join(x for p, x in enumerate(text.split("\n")) if p not in gone.get(key, ()))
        assert (after[key].text == left and after[key].n_chars == len(left)) if left.strip() else key not in after


def test_near_duplicates(stages):
    before, after = map(rows, stages[2])
    data = sorted((r.doc_id, r.text) for r in before.values())
    sets, root = test_near_dup.brute(data, 5)
    first = {}
    for (key, _), s, c in zip(data, sets, root):
        if s:
            first.setdefault(c, key)
    assert set(after) == set(first.values()) | {k for (k, _), s in zip(data, sets) if not s}


def contaminated(text, items):
    """Whether a window of an item stands in the text, by going through all places."""

    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    own = words(text)
    for item in map(words, items):
        for k in range(max(len(item) - 9, 1)):
            window = item[k : k + 10]
            if window and any(own[p : p + len(window)] == window for p in range(len(own))):
                return True
    return False


def test_decontamination(spark, stages):
    before, after = map(rows, stages[3])
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(after) == {k for k, r in before.items() if not contaminated(r.text, items)}
    assert all(after[k] == before[k] for k in after)


def messy_folder(spark, tmp_path, documents, items):
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, "u", "d", "w", "k", "y", "n") for r in documents]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string, uid string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_messy_tables_through_all_stages(spark, tmp_path):
    import random

    rng = random.Random(6)
    copies = prose(rng, 40)
    documents = messy() + [(20, copies, "b"), (21, copies, "b"), (21, copies, "b"), (22, prose(rng, 30), None), (23, prose(rng, 25), "z")]
    items = [("i", documents[-1][1].upper(), "u"), ("i", None, "u"), (None, "", "u"), ("j", "...", "u")]
    folder = messy_folder(spark, tmp_path / "in", documents, items)
    found = through(spark, folder, tmp_path / "out")
    for k, (before, after) in enumerate(found[:-1]):
        assert after.columns == before.columns and after.count() <= before.count(), k
    kept = {r.doc_id: r for r in found[-1][1].collect()}
    assert set(kept) >= {20, 22} and not {21, 23} & set(kept) and all(r.lossless for r in kept.values())
    assert {c for c in SCHEMA.replace(",", "").split()[::2] if c not in ("text",)} <= set(found[-1][1].columns)
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(str, whole)) == sorted(map(str, found[-1][1].select(*whole[0].__fields__).collect()))


def test_empty_tables_through_all_stages(spark, tmp_path):
    folder = messy_folder(spark, tmp_path / "in", [], [])
    for before, after in through(spark, folder, tmp_path / "out"):
        assert after.count() == 0


def test_finished_stages_leave_no_scratch(spark, tmp_path, monkeypatch):
    """When a stage begins, nothing is left of the one before but its written output."""
    seen = []
    real = corpus_pipeline.delete
    monkeypatch.setattr(corpus_pipeline, "delete", lambda s, paths: (seen.append(list(paths)), real(s, paths)))
    through(spark, SF, tmp_path)
    assert [bool(x) for x in seen] == [bool(seen[0]), True, True, True, True]
    import os

    assert not any(os.path.exists(p) for paths in seen for p in paths)


def test_encoding_is_lossless(stages):
    before, after = map(rows, stages[4])
    assert set(before) == set(after) and all(r.lossless and r.n_tokens == len(r.ids) for r in after.values())
    assert stages[3][1].columns == stages[0][0].columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(SQL[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF).select(*columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
