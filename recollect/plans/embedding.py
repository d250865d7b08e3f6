"""Registered queries on embedding."""

from __future__ import annotations

import hashlib
import re
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect import batch_embedder, column_embedder
from recollect.config import QUERY_INPUT
from recollect.operators import context_vectors as context
from recollect.operators.distinct_texts import by_length, embed_distinct
from recollect.operators.embedding import embed
from recollect.operators.ingest import ingest_sessions, insert_memories
from recollect.operators.rejects import set_aside
from recollect.plans import inputs as i
from recollect.plans.inputs import DIMS

WORD = re.compile(r"[^\W_]+")


def hashing_model():
    """A stand-in for a remote model with the batch call shape: texts in, vectors out.

    Same buckets as the hashing embedder; the query side is told apart by its sign.
    """
    known: dict[str, int] = {}

    def bucket(word: str) -> int:
        if word not in known:
            known[word] = int.from_bytes(hashlib.md5(word.encode()).digest()[:4], "big") % DIMS
        return known[word]

    def run(texts, input_type):
        out = np.zeros((len(texts), DIMS))
        for row, text in zip(out, texts):
            np.add.at(row, [bucket(w) for w in WORD.findall(text.lower())], 1.0)
        size = np.linalg.norm(out, axis=1, keepdims=True)
        out = np.divide(out, size, out=out, where=size > 0)
        return -out if input_type == QUERY_INPUT else out

    return run


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return i.table(spark, sf_dir, "documents")


def _cells(df: DataFrame, key: str) -> DataFrame:
    """One row per non-zero vector entry. The outer form spares a filter on the vector's size, for
    which Spark would embed each text once more."""
    cells = df.select(key, F.posexplode_outer("embedding").alias("dim", "value"))
    return cells.filter("value <> 0").select(
        key, F.col("dim").cast("bigint").alias("dim"), F.col("value").cast("double").alias("value")
    )


CELLS_SQL = """SELECT {key}, d AS dim, CAST(x AS DOUBLE) AS value
FROM (SELECT id AS {key}, unnest(v) AS x, unnest(range(len(v))) AS d FROM vec) c WHERE x <> 0"""
DOC_VECTORS = f"WITH {i.hash_vectors_sql('vec', 'documents', 'doc_id', 'text')} "


def e1_pluggable_embedder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model is told whether it embeds a stored text or a question."""
    config = replace(i.CONFIG, embedder=batch_embedder(hashing_model))
    asked = embed(_docs(spark, sf_dir), config, "text", QUERY_INPUT)
    return _cells(asked, "doc_id")


E1 = DOC_VECTORS + CELLS_SQL.format(key="doc_id").replace("CAST(x AS DOUBLE) AS value", "-CAST(x AS DOUBLE) AS value")


def e2_batched_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts reach the model in lists; every vector says how long its list was at most."""

    def sized_model():
        return lambda texts, _: [[float(len(texts) <= 32), float(len(t))] for t in texts]

    config = replace(i.CONFIG, embedder=batch_embedder(sized_model, batch_size=32), dimensions=2)
    done = embed(_docs(spark, sf_dir), config, "text")
    return done.select(
        "doc_id",
        F.col("embedding")[0].cast("bigint").alias("within_batch"),
        F.col("embedding")[1].cast("bigint").alias("chars"),
    )


E2 = "SELECT doc_id, CAST(1 AS BIGINT) AS within_batch, length(text) AS chars FROM documents"


def _by_length(text):
    """Vectors of the configured length, of another one, or empty, by the text's length."""
    size = F.length(text) % 3
    return F.when(size == 0, F.array().cast("array<float>")).otherwise(
        F.array_repeat(F.lit(1.0).cast("float"), (size * i.DIMS).cast("int"))
    )


def _uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = replace(i.CONFIG, embedder=column_embedder(_by_length), strict_embedding=False)
    return embed(_docs(spark, sf_dir), config, "text")


def e3_empty_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What strict mode would refuse, counted per source."""
    return _uneven(spark, sf_dir).groupBy("source").agg(
        F.count_if(F.size("embedding") == 0).alias("empty"), F.count(F.lit(1)).alias("texts")
    )


E3 = """SELECT source, count(*) FILTER (length(text) % 3 = 0) AS empty, count(*) AS texts
FROM documents GROUP BY 1"""


def e4_wrong_length_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _uneven(spark, sf_dir).select("doc_id", "embedding_ok")


E4 = "SELECT doc_id, length(text) % 3 = 1 AS embedding_ok FROM documents"


def e5_hashing_embedder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(embed(_docs(spark, sf_dir), i.CONFIG, "text"), "doc_id")


E5 = DOC_VECTORS + CELLS_SQL.format(key="doc_id")


def e6_embed_only_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models leave their mark: the second one sees only sessions with new text."""

    def marked(mark: float):
        vector = F.array(F.lit(mark).cast("float"))
        return column_embedder(lambda text: F.when(text.isNotNull(), vector))

    def config(mark: float):
        return replace(i.CONFIG, embedder=marked(mark), dimensions=1, signature_bits=None)

    ev = i.events(spark, sf_dir)
    stored = ingest_sessions(ev.filter("seq < 4"), config(1.0), i.at(i.FIRST))
    after = ingest_sessions(ev, config(2.0), i.at(i.SECOND), stored)
    return after.select("session_id", F.col("embedding")[0].cast("bigint").alias("model"))


E6 = f"""WITH {i.EVENTS_SQL}
SELECT session_id, CAST(CASE WHEN max(seq) >= 4 THEN 2 ELSE 1 END AS BIGINT) AS model
FROM ev GROUP BY 1"""


def e2_distinct_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts are sent once, in calls of a bounded number of characters; each row has its
    own text's vector."""

    def sized_model():
        return lambda texts, _: [[float(len(texts) == 1 or sum(map(len, texts)) <= 20_000), float(len(t))] for t in texts]

    config = replace(i.CONFIG, embedder=by_length(sized_model, call_chars=20_000), dimensions=2)
    done, sent = embed_distinct(_docs(spark, sf_dir), config, "text")
    return done.select(
        "doc_id", F.col("embedding")[0].cast("bigint").alias("within_call"), F.col("embedding")[1].cast("bigint").alias("chars"),
        F.lit(sent).cast("bigint").alias("texts_sent"),
    )


E2D = """SELECT doc_id, CAST(1 AS BIGINT) AS within_call, length(text) AS chars,
  (SELECT count(DISTINCT text) FROM documents) AS texts_sent FROM documents"""


def e3_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the vectors are empty and a third too long: these are set aside with the
    reason, the others are stored; both are counted in the pass that embeds them."""
    config = replace(i.CONFIG, embedder=column_embedder(_by_length), strict_embedding=False, signature_bits=None)
    made = insert_memories(i.entries(spark, sf_dir), config, i.at(i.FIRST), entry_id=F.col("entry_id"))
    checked = set_aside(made, config)
    table = i.new_table(spark, "checked")
    table.add_memories(checked.kept)
    kept = table.read().select("memory_id", F.lit("stored").alias("fate"))
    both = kept.union(checked.rejected.select("memory_id", F.col("reason").alias("fate")))
    count = F.lit(None).cast("bigint")
    for name, fate in (("kept", "stored"), ("empty", "empty"), ("wrong_length", "wrong_length")):
        count = F.when(F.col("fate") == fate, checked.counts[name]).otherwise(count)
    return both.select("memory_id", "fate", count.cast("bigint").alias("counted"))


E3R = """WITH d AS (SELECT sha256(length('add_memory') || ':add_memory' || length(CAST(doc_id AS VARCHAR)) || ':' || doc_id) AS memory_id,
  CASE length(trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')) % 3 WHEN 0 THEN 'empty' WHEN 1 THEN 'stored' ELSE 'wrong_length' END AS fate
  FROM documents WHERE trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') <> '')
SELECT memory_id, fate, count(*) OVER (PARTITION BY fate) AS counted FROM d"""


CONTEXT_DIMS = 48


def e5_context_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors learned from all documents' words and their company, for all documents."""
    docs = _docs(spark, sf_dir)
    return _cells(context.embed_by_context(docs, context.fit_words(docs, CONTEXT_DIMS), CONTEXT_DIMS, "doc_id"), "doc_id")


_W, _S, _K = context.WEIGHT, context.STEPS, context.WINDOW
E5C = f"""WITH t AS MATERIALIZED (SELECT doc_id, list_filter(string_split(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents),
dw AS MATERIALIZED (SELECT doc_id, unnest(w) AS word FROM t),
wt AS MATERIALIZED (SELECT * FROM (SELECT word, CAST(floor(log2((SELECT count(*) FROM documents)::DOUBLE / count(DISTINCT doc_id)) * {_W} + 0.5) AS BIGINT) AS weight FROM dw GROUP BY word) a WHERE weight > 0),
ps AS (SELECT w[i] AS a, w[i + k] AS b FROM (SELECT w, unnest(range(1, len(w) + 1)) AS i FROM t) x, range(1, {_K + 1}) r(k) WHERE i + k <= len(w) AND w[i] <> w[i + k]),
nb AS (SELECT word, near, count(*) AS n FROM (SELECT a AS word, b AS near FROM ps UNION ALL SELECT b, a FROM ps) u GROUP BY ALL),
en AS (SELECT word, CAST('0x' || substr(d, 1, 8) AS BIGINT) % {CONTEXT_DIMS} AS dim, CASE WHEN substr(d, 9, 1) < '8' THEN 1 ELSE -1 END AS sign
  FROM (SELECT word, md5(word || ':' || j) AS d FROM wt, range({context.ENTRIES}) r(j)) z),
cx AS MATERIALIZED (SELECT nb.word, dim, sum(n * wt.weight * sign)::BIGINT AS x FROM nb JOIN wt ON wt.word = near JOIN en ON en.word = near GROUP BY nb.word, dim HAVING x <> 0),
wv AS (SELECT word, dim, CAST(floor(x * {_S} / max(abs(x)) OVER (PARTITION BY word)) AS BIGINT) AS value FROM cx),
tx AS (SELECT doc_id, dim, sum(tf * weight * value)::BIGINT AS x FROM (SELECT doc_id, word, count(*) AS tf FROM dw GROUP BY ALL) f
  JOIN wt USING (word) JOIN wv USING (word) GROUP BY doc_id, dim)
SELECT doc_id, dim, CAST(CAST(x / max(abs(x)) OVER (PARTITION BY doc_id) AS FLOAT) AS DOUBLE) AS value FROM tx WHERE x <> 0"""


QUERIES = {
    "e5_context_vectors": (e5_context_vectors, E5C),
    "e2_distinct_texts": (e2_distinct_texts, E2D),
    "e3_rejected": (e3_rejected, E3R),
    "e1_pluggable_embedder": (e1_pluggable_embedder, E1),
    "e2_batched_calls": (e2_batched_calls, E2),
    "e3_empty_vectors": (e3_empty_vectors, E3),
    "e4_wrong_length_flag": (e4_wrong_length_flag, E4),
    "e5_hashing_embedder": (e5_hashing_embedder, E5),
    "e6_embed_only_changed": (e6_embed_only_changed, E6),
}
