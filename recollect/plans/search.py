"""Registered queries on search."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recollect.config import TENANT
from recollect.functions import typed
from recollect.functions import vectors as vx
from recollect.functions.signatures import DEFAULT_BITS
from recollect.operators import approximate, budget
from recollect.operators.ingest import ingest_sessions
from recollect.operators.inverted import InvertedLists
from recollect.operators.nearest import nearest
from recollect.operators.search import (
    prepare_queries,
    search,
    search_memory,
    top_k,
    with_memories,
)
from recollect.plans import inputs as i
from recollect.session import scratch_path


def _ranked(hits: DataFrame) -> DataFrame:
    return hits.select(
        "query_id", "rank", "memory_id", "similarity"
    )


RANKED_SQL = "SELECT query_id, rnk AS rank, memory_id, sim AS similarity"
VQ_SQL = f"""{i.VECTORS_SQL}, vq AS (SELECT memory_id AS query_id, app_name, user_id, v FROM vm)"""


def session_memories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session memories, written to a table and read back, as a search meets them."""
    table = i.new_table(spark, "search")
    table.add_sessions(i.events(spark, sf_dir), i.CONFIG, i.at(i.SECOND))
    return table.read()


# ---- text questions over session memories ------------------------------------

QUESTIONS_SQL = f"""{i.EVENTS_SQL}, {i.transcripts_sql()},
oq AS (SELECT event_id AS query_id, app_name, user_id, text AS query FROM ev WHERE author = 'user'),
{i.hash_vectors_sql("qv", "oq", "query_id", "query")},
{i.hash_vectors_sql("mv", "tr", "memory_id", "transcript")},
q AS (SELECT oq.query_id, app_name, user_id, CAST(v AS DOUBLE[]) AS v FROM oq JOIN qv ON qv.id = oq.query_id),
m AS (SELECT tr.memory_id, app_name, user_id, CAST(v AS DOUBLE[]) AS v FROM tr JOIN mv ON mv.id = tr.memory_id),
{i.top_k_sql("hits", "q", "m")}"""


def q1_blank_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions without text, or with spaces only, get no rows; the others do."""
    asked = i.events(spark, sf_dir).select(
        F.col("event_id").alias("query_id"),
        *TENANT,
        F.when(F.col("author") == "user", F.col("parts")[0]["text"])
        .when(F.col("author") == "assistant", F.lit(" \t\n"))
        .alias("query"),
    )
    return prepare_queries(asked, i.CONFIG).select("query_id", "app_name", "user_id")


Q1 = f"""WITH {i.EVENTS_SQL}
SELECT event_id AS query_id, app_name, user_id FROM ev WHERE author = 'user'"""


def q2_tenant_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every query gets as many memories as its tenant has, up to the limit, and all its own."""
    memories = i.vector_memories(spark, sf_dir)
    hits = top_k(i.vector_queries(spark, sf_dir), memories, i.CONFIG)
    owner = memories.select("memory_id", F.struct(*TENANT).alias("owner"))
    return hits.join(owner, "memory_id").groupBy("query_id", *TENANT).agg(
        F.count(F.lit(1)).alias("memories"),
        F.count_if(F.col("owner") == F.struct(*TENANT)).alias("own"),
    )


Q2 = f"""WITH {VQ_SQL}
SELECT q.query_id, q.app_name, q.user_id, least(n, 5) AS memories, least(n, 5) AS own
FROM vq q JOIN (SELECT app_name, user_id, count(*) AS n FROM vm GROUP BY 1, 2) m
ON q.app_name = m.app_name AND q.user_id = m.user_id"""


def _pair_scores(metric: str):
    """A metric as a column expression: every vector against the one before it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        vec = i.table(spark, sf_dir, "embeddings")
        before = vec.select((F.col("vec_id") + 1).alias("vec_id"), F.col("embedding").alias("other"))
        sim = vx.similarity(metric, F.col("embedding"), F.col("other"))
        return vec.join(before, "vec_id").select(
            "vec_id",
            sim.alias("similarity"),
            vx.bounded_score(metric, sim).alias("score"),
        )

    return run


def _pair_sql(metric: str) -> str:
    sim = i.SIMILARITY_SQL[metric].format(a="CAST(a.embedding AS DOUBLE[])", b="CAST(b.embedding AS DOUBLE[])")
    score = "1 / (1 - s)" if metric == "euclidean" else "(1 + s) / 2"
    return f"""SELECT vec_id, s AS similarity, {score} AS score FROM (
  SELECT a.vec_id, {sim} AS s FROM embeddings a JOIN embeddings b ON a.vec_id = b.vec_id + 1) p"""


def _top_by(metric: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        config = replace(i.CONFIG, similarity=metric)
        return _ranked(
            top_k(i.vector_queries(spark, sf_dir), i.vector_memories(spark, sf_dir), config)
        )

    return run


def _top_sql(metric: str) -> str:
    return f"WITH {VQ_SQL}, {i.top_k_sql('hits', 'vq', 'vm', metric)} {RANKED_SQL} FROM hits"


def q6_split_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 with every tenant cut into many blocks, as a heavy one would be."""
    hits = nearest(
        i.vector_queries(spark, sf_dir),
        i.vector_memories(spark, sf_dir),
        3,
        "cosine",
        i.DIMS,
        memory_block=5,
        query_block=4,
    )
    return _ranked(hits)


Q6B = f"WITH {VQ_SQL}, {i.top_k_sql('hits', 'vq', 'vm', k=3)} {RANKED_SQL} FROM hits"


# ---- approximate -------------------------------------------------------------

SIGNATURES_SQL = f"""{VQ_SQL},
pl AS (SELECT j, list(CASE WHEN strpos('01234567', substr(md5(j || ':' || k), 1, 1)) > 0 THEN 1.0 ELSE -1.0 END ORDER BY k) AS p
       FROM (SELECT unnest(range({DEFAULT_BITS})) AS j) a CROSS JOIN (SELECT unnest(range({i.DIMS})) AS k) b GROUP BY j),
sg AS (SELECT memory_id, list(list_inner_product(v, CAST(p AS DOUBLE[])) > 1e-9 ORDER BY j) AS bits
       FROM vm CROSS JOIN pl GROUP BY memory_id),
hd AS (SELECT q.query_id, m.memory_id, q.v AS qv, m.v AS mv,
              len(list_filter(list_zip(a.bits, b.bits), lambda z: z[1] <> z[2])) AS differing
       FROM vq q JOIN vm m ON q.app_name = m.app_name AND q.user_id = m.user_id
       JOIN sg a ON a.memory_id = q.query_id JOIN sg b ON b.memory_id = m.memory_id),
cd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY differing, memory_id) AS pos FROM hd) t
       WHERE pos <= 10),
ap AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, memory_id) AS rnk
  FROM (SELECT query_id, memory_id, round(list_cosine_similarity(qv, mv), 9) AS sim FROM cd) s) t WHERE rnk <= 5)"""
#: Ten candidates, so that within small tenants the budget still leaves something out.
APPROXIMATE = replace(i.CONFIG, candidates_multiplier=2)


def q7_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = approximate.candidates(
        i.vector_queries(spark, sf_dir),
        i.vector_memories(spark, sf_dir).drop("signature"),
        APPROXIMATE,
    )
    return found.select(
        "query_id", "memory_id", "rank", (-F.col("similarity")).cast("bigint").alias("differing")
    )


Q7C = f"WITH {SIGNATURES_SQL} SELECT query_id, memory_id, pos AS rank, differing FROM cd"


def q7_approximate_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    memories = i.vector_memories(spark, sf_dir).drop("signature")
    return _ranked(top_k(i.vector_queries(spark, sf_dir), memories, APPROXIMATE, "approximate"))


Q7 = f"WITH {SIGNATURES_SQL} {RANKED_SQL} FROM ap"


def _locally_numbered(queries: DataFrame) -> DataFrame:
    """Each tenant numbers its queries from 1."""
    place = F.row_number().over(Window.partitionBy(*TENANT).orderBy(F.col("query_id").cast("long")))
    return queries.withColumn("query_id", place.cast("string"))


def _by_local_ids(mode: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        memories = i.vector_memories(spark, sf_dir).drop("signature")
        hits = top_k(_locally_numbered(i.vector_queries(spark, sf_dir)), memories, APPROXIMATE, mode)
        return hits.select(*TENANT, "query_id", "rank", "memory_id", "similarity")

    return run


def q11_local_query_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole search in which every tenant has a first query."""
    found = search(_locally_numbered(i.vector_queries(spark, sf_dir)), i.vector_memories(spark, sf_dir), i.CONFIG)
    return found.select(*TENANT, "query_id", "rank", "memory_id", "score")


_LOCAL_SQL = """, ln AS (SELECT query_id AS gid, app_name, user_id, CAST(row_number() OVER (
  PARTITION BY app_name, user_id ORDER BY CAST(query_id AS BIGINT)) AS VARCHAR) AS query_id FROM vq)
SELECT ln.app_name, ln.user_id, ln.query_id, h.rnk AS rank, h.memory_id, """
Q6L = f"""WITH {VQ_SQL}, {i.top_k_sql("h", "vq", "vm")} {_LOCAL_SQL} h.sim AS similarity FROM h JOIN ln ON ln.gid = h.query_id"""
Q7L = f"""WITH {SIGNATURES_SQL} {_LOCAL_SQL} h.sim AS similarity FROM ap h JOIN ln ON ln.gid = h.query_id"""
Q11L = f"""WITH {VQ_SQL}, {i.top_k_sql("h", "vq", "vm")} {_LOCAL_SQL} (1 + h.sim) / 2 AS score
FROM h JOIN ln ON ln.gid = h.query_id JOIN vm ON vm.memory_id = h.memory_id WHERE vm.transcript <> ''"""


def q8_score_without_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    memories = i.vector_memories(spark, sf_dir)
    queries = i.vector_queries(spark, sf_dir)
    hits = with_memories(top_k(queries, memories, i.CONFIG), memories, False)
    return hits.select(
        "query_id",
        "memory_id",
        vx.bounded_score("cosine", F.col("similarity")).alias("score"),
        F.lit("embedding" in hits.columns).alias("has_vector"),
    )


HITS_SQL = f"{VQ_SQL}, {i.top_k_sql('hits', 'vq', 'vm')}"
Q8 = f"""WITH {HITS_SQL}
SELECT query_id, memory_id, (1 + sim) / 2 AS score, false AS has_vector FROM hits"""


def q9_shape_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result fields; the stored ``source`` and ``score`` replace the map's own, not the column."""
    lang_as_score = F.when(
        F.col("user_id") == "1", F.create_map(F.lit("score"), F.col("custom_metadata")["lang"])
    ).otherwise(F.col("custom_metadata"))
    memories = i.vector_memories(spark, sf_dir).withColumn("custom_metadata", lang_as_score)
    memories = memories.withColumn("author", F.when(F.col("user_id") != "2", F.col("author")))
    shaped = search(i.vector_queries(spark, sf_dir), memories, i.CONFIG)
    return shaped.select(
        "query_id",
        "rank",
        "memory_id",
        F.md5("text").alias("text_md5"),
        "role",
        "author",
        "timestamp",
        "score",
        F.col("custom_metadata")["source"].alias("map_source"),
        F.when(F.col("custom_metadata")["score"].rlike("^[a-z]+$"), F.col("custom_metadata")["score"])
        .alias("map_score_text"),
        F.map_contains_key("custom_metadata", "session_id").alias("has_session_key"),
    )


Q9 = f"""WITH {HITS_SQL}
SELECT query_id, rnk AS rank, hits.memory_id, md5(transcript) AS text_md5, 'model' AS role, 'memory' AS author,
  strftime(updated_at, '%Y-%m-%dT%H:%M:%S+00:00') AS timestamp, (1 + sim) / 2 AS score,
  CASE WHEN user_id = '1' THEN 'add_memory' ELSE coalesce(doc_source, 'add_memory') END AS map_source,
  CASE WHEN user_id = '1' THEN lang END AS map_score_text, true AS has_session_key
FROM hits JOIN vm USING (memory_id) WHERE transcript <> ''"""


def q9_typed_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata as variants: the score in the map is a number, and so is what was stored as one.
    Stored values replace the map's own of the same name, but never the column."""
    memories = i.vector_memories(spark, sf_dir)
    number = F.col("memory_id").cast("long")
    own = typed.typed_map({"number": number, "source": F.col("custom_metadata")["source"], "score": F.when(number % 2 == 1, number)})
    shaped = search(i.vector_queries(spark, sf_dir), memories.withColumn("custom_metadata", own), i.CONFIG)
    md = F.col("custom_metadata")
    return shaped.select(
        "query_id", "rank", "memory_id", "score", typed.value_of(md, "score", "double").alias("map_score"),
        typed.value_of(md, "number", "bigint").alias("number"), typed.value_of(md, "source", "string").alias("map_source"),
        F.schema_of_variant(md["number"]).alias("kind"),
    )


Q9T = f"""WITH {HITS_SQL}
SELECT query_id, rnk AS rank, hits.memory_id, (1 + sim) / 2 AS score,
  CASE WHEN CAST(hits.memory_id AS BIGINT) % 2 = 1 THEN CAST(hits.memory_id AS DOUBLE) ELSE (1 + sim) / 2 END AS map_score,
  CAST(hits.memory_id AS BIGINT) AS number, coalesce(doc_source, 'add_memory') AS map_source, 'BIGINT' AS kind
FROM hits JOIN vm USING (memory_id) WHERE transcript <> ''"""


def q10_skip_empty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """German texts are blanked: such hits fall out after the limit, so queries get fewer rows."""
    memories = i.vector_memories(spark, sf_dir).withColumn(
        "transcript",
        F.when(F.col("custom_metadata")["lang"] == "de", F.lit("")).otherwise(F.col("transcript")),
    )
    shaped = search(i.vector_queries(spark, sf_dir), memories, i.CONFIG)
    return shaped.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("hits"), F.max("rank").alias("last_rank")
    )


Q10 = f"""WITH {HITS_SQL}
SELECT query_id, count(*) AS hits, max(rnk) AS last_rank FROM hits JOIN vm USING (memory_id)
WHERE transcript <> '' AND lang <> 'de' GROUP BY 1"""


def q11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions into a table, then every question of a user answered from its own tenant."""
    found = search(
        i.user_questions(spark, sf_dir), session_memories(spark, sf_dir), i.CONFIG
    )
    return found.select(
        "query_id",
        "rank",
        "memory_id",
        F.md5("text").alias("text_md5"),
        "role",
        "author",
        "timestamp",
        "score",
        F.col("custom_metadata")["session_id"].alias("session_id"),
    )


Q11_COLUMNS = """query_id, rnk AS rank, memory_id, md5(transcript) AS text_md5, 'model' AS role,
  'memory' AS author, '2024-02-02T12:30:00.250000+00:00' AS timestamp,
  (1 + sim) / 2 AS score, session_id"""
Q11 = f"WITH {QUESTIONS_SQL} SELECT {Q11_COLUMNS} FROM hits JOIN tr USING (memory_id)"


def q11_search_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tenant, one question."""
    memories = ingest_sessions(i.events(spark, sf_dir), i.CONFIG, i.at(i.SECOND))
    found = search_memory(memories, i.CONFIG, "app0", "u0", "la question de éreux tion the and")
    return found.select("rank", "memory_id", "score")


Q11M = f"""WITH {i.EVENTS_SQL}, {i.transcripts_sql()},
oq AS (SELECT 'app0' AS app_name, 'u0' AS user_id, 0 AS query_id, 'la question de éreux tion the and' AS query),
{i.hash_vectors_sql("qv", "oq", "query_id", "query")},
{i.hash_vectors_sql("mv", "tr", "memory_id", "transcript")},
q AS (SELECT oq.query_id, app_name, user_id, CAST(v AS DOUBLE[]) AS v FROM oq JOIN qv ON qv.id = oq.query_id),
m AS (SELECT tr.memory_id, app_name, user_id, CAST(v AS DOUBLE[]) AS v FROM tr JOIN mv ON mv.id = tr.memory_id),
{i.top_k_sql("hits", "q", "m")}
SELECT rnk AS rank, memory_id, (1 + sim) / 2 AS score FROM hits"""


def q12_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = i.vector_queries(spark, sf_dir)
    memories = i.vector_memories(spark, sf_dir).drop("signature")
    exact = top_k(queries, memories, APPROXIMATE)
    found = approximate.recall(exact, top_k(queries, memories, APPROXIMATE, "approximate"))
    return found.drop(*TENANT)


Q12 = f"""WITH {SIGNATURES_SQL}, {i.top_k_sql("hits", "vq", "vm")}
SELECT h.query_id, count(*) AS exact_hits, avg(CASE WHEN a.memory_id IS NULL THEN 0 ELSE 1 END) AS recall
FROM hits h LEFT JOIN ap a ON a.query_id = h.query_id AND a.memory_id = h.memory_id GROUP BY 1"""


def _curve(spark: SparkSession, sf_dir: str, **blocks) -> DataFrame:
    queries = i.vector_queries(spark, sf_dir)
    memories = i.vector_memories(spark, sf_dir).drop("signature")
    places = budget.hit_places(top_k(queries, memories, i.CONFIG), queries, memories, i.CONFIG, **blocks)
    return budget.budget_curve(places)


def q12_budget_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall of the exact five for every budget of candidates, and what it is at least."""
    return _curve(spark, sf_dir)


def q12_least_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The budgets for some targets, counted with every tenant cut into many blocks."""
    return budget.least_budgets(_curve(spark, sf_dir, memory_block=7, query_block=9), TARGETS)


#: Recalls to find the budget for.
TARGETS = (0.5, 0.8, 0.9, 0.95, 0.99)
_Z = budget.DEVIATIONS
CURVE_SQL = f"""{SIGNATURES_SQL}, {i.top_k_sql("hits", "vq", "vm")},
pl2 AS (SELECT query_id, memory_id, row_number() OVER (PARTITION BY query_id ORDER BY differing, memory_id) AS place FROM hd),
pc AS (SELECT place, count(*) AS n FROM hits JOIN pl2 USING (query_id, memory_id) GROUP BY place),
ps AS (SELECT place, CAST(sum(n) OVER (ORDER BY place) AS BIGINT) AS hits, CAST(sum(n) OVER () AS DOUBLE) AS n FROM pc),
pr AS (SELECT place AS budget, hits, hits / n AS recall, n FROM ps),
cv AS (SELECT budget, hits, recall, (recall + CAST({_Z * _Z / 2!r} AS DOUBLE) / n
  - CAST({_Z!r} AS DOUBLE) * sqrt((recall * (1.0::DOUBLE - recall) + CAST({_Z * _Z / 4!r} AS DOUBLE) / n) / n))
  / (1.0::DOUBLE + CAST({_Z * _Z!r} AS DOUBLE) / n) AS at_least FROM pr)"""
Q12C = f"WITH {CURVE_SQL} SELECT budget, hits, recall, at_least FROM cv"
Q12L = f"""WITH {CURVE_SQL} SELECT CAST(t AS DOUBLE) AS target, min(CASE WHEN recall >= t THEN budget END) AS budget,
  min(CASE WHEN at_least >= t THEN budget END) AS safe_budget FROM cv CROSS JOIN (SELECT unnest([{", ".join(f"CAST({t} AS DOUBLE)" for t in TARGETS)}]) AS t) x GROUP BY t"""


# ---- inverted lists ----------------------------------------------------------

#: Few lists and vectors to fit them on, so that small tables have both.
LISTS, PROBED, PER_LIST, FIT_ROUNDS = 16, 5, 20, 4


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stated query set: every vector whose id is divisible by 20."""
    return i.vector_queries(spark, sf_dir).filter(F.col("query_id").cast("long") % 20 == 0)


def inverted_lists(spark: SparkSession, sf_dir: str) -> InvertedLists:
    memories = i.vector_memories(spark, sf_dir)
    return InvertedLists.create(memories, scratch_path(spark, "lists"), i.CONFIG, LISTS, rounds=FIT_ROUNDS, per_list=PER_LIST)


def q7_list_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every memory is in the list of its nearest centroid."""
    return inverted_lists(spark, sf_dir).read().select("memory_id", "list")


def q7_inverted_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best five of the lists nearest to each query."""
    return _ranked(inverted_lists(spark, sf_dir).top_k(_asked(spark, sf_dir), i.CONFIG, PROBED))


def q12_list_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the lists that were looked into hold of the exact hits, per query."""
    asked = _asked(spark, sf_dir)
    exact = top_k(asked, i.vector_memories(spark, sf_dir), i.CONFIG)
    found = inverted_lists(spark, sf_dir).top_k(asked, i.CONFIG, PROBED)
    return approximate.recall(exact, found).drop(*TENANT)


def _lists_sql() -> str:
    def nearest_sql(rows: str, book: str) -> str:
        return f"""SELECT memory_id, any_value(r.x) AS x, min({LISTS} * list_sum(list_transform(list_zip(r.x, c.x),
  lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT + c.list) AS m FROM {rows} r CROSS JOIN {book} c GROUP BY memory_id"""

    parts = [f"""{VQ_SQL},
dr AS MATERIALIZED (SELECT memory_id, list_transform(v, lambda c: CAST(floor(c / sqrt(list_sum(list_transform(v, lambda a: a * a))) * 32768) AS BIGINT)) AS x FROM vm),
sm AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY md5(memory_id), memory_id) - 1 AS pos FROM dr QUALIFY pos < {LISTS * PER_LIST}),
c0 AS MATERIALIZED (SELECT pos AS list, x FROM sm WHERE pos < {LISTS})"""]
    for k in range(FIT_ROUNDS):
        parts.append(f"""n{k} AS MATERIALIZED ({nearest_sql("sm", f"c{k}")}),
t{k} AS (SELECT list, d, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM (
  SELECT m % {LISTS} AS list, unnest(x) AS x, unnest(range(len(x))) AS d FROM n{k}) u GROUP BY list, d),
c{k + 1} AS MATERIALIZED (SELECT c.list, coalesce(t.x, c.x) AS x FROM c{k} c
  LEFT JOIN (SELECT list, list(x ORDER BY d) AS x FROM t{k} GROUP BY list) t USING (list))""")
    return ", ".join(parts) + f""",
li AS MATERIALIZED (SELECT memory_id, CAST(m % {LISTS} AS INTEGER) AS list FROM ({nearest_sql("dr", f"c{FIT_ROUNDS}")}) a),
ml AS (SELECT vm.*, list FROM vm JOIN li USING (memory_id)),
ql AS (SELECT query_id, app_name, user_id, v, list FROM (
  SELECT query_id, app_name, user_id, v, c.list, row_number() OVER (PARTITION BY query_id ORDER BY list_sum(list_transform(list_zip(d.x, c.x),
    lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c.list) AS pos
  FROM vq JOIN dr d ON d.memory_id = query_id CROSS JOIN c{FIT_ROUNDS} c WHERE CAST(query_id AS BIGINT) % 20 = 0) p WHERE pos <= {PROBED}),
{i.top_k_sql("lh", "ql", "ml", tenant="q.app_name = m.app_name AND q.user_id = m.user_id AND q.list = m.list")}"""


LISTS_SQL = _lists_sql()
Q7N = f"WITH {LISTS_SQL} SELECT memory_id, list FROM li"
Q7I = f"WITH {LISTS_SQL} {RANKED_SQL} FROM lh"
Q12I = f"""WITH {LISTS_SQL}, aq AS (SELECT * FROM vq WHERE CAST(query_id AS BIGINT) % 20 = 0), {i.top_k_sql("hits", "aq", "vm")}
SELECT h.query_id, count(*) AS exact_hits, avg(CASE WHEN a.memory_id IS NULL THEN 0 ELSE 1 END) AS recall
FROM hits h LEFT JOIN lh a ON a.query_id = h.query_id AND a.memory_id = h.memory_id GROUP BY 1"""


QUERIES = {
    "q12_budget_curve": (q12_budget_curve, Q12C),
    "q12_least_budget": (q12_least_budget, Q12L),
    "q7_list_numbers": (q7_list_numbers, Q7N),
    "q7_inverted_lists": (q7_inverted_lists, Q7I),
    "q12_list_recall": (q12_list_recall, Q12I),
    "q1_blank_queries": (q1_blank_queries, Q1),
    "q2_tenant_filter": (q2_tenant_filter, Q2),
    "q3_cosine": (_pair_scores("cosine"), _pair_sql("cosine")),
    "q4_euclidean": (_pair_scores("euclidean"), _pair_sql("euclidean")),
    "q5_dot_product": (_pair_scores("dotProduct"), _pair_sql("dotProduct")),
    "q6_top_k_cosine": (_top_by("cosine"), _top_sql("cosine")),
    "q6_top_k_euclidean": (_top_by("euclidean"), _top_sql("euclidean")),
    "q6_top_k_dot_product": (_top_by("dotProduct"), _top_sql("dotProduct")),
    "q6_top_k_split_tenants": (q6_split_tenants, Q6B),
    "q6_local_query_ids": (_by_local_ids("exact"), Q6L),
    "q7_local_query_ids": (_by_local_ids("approximate"), Q7L),
    "q11_local_query_ids": (q11_local_query_ids, Q11L),
    "q7_candidates": (q7_candidates, Q7C),
    "q7_approximate_search": (q7_approximate_search, Q7),
    "q8_score_without_vector": (q8_score_without_vector, Q8),
    "q9_shape_results": (q9_shape_results, Q9),
    "q9_typed_results": (q9_typed_results, Q9T),
    "q10_skip_empty_text": (q10_skip_empty_text, Q10),
    "q11_search": (q11_search, Q11),
    "q11_search_memory": (q11_search_memory, Q11M),
    "q12_recall": (q12_recall, Q12),
}
