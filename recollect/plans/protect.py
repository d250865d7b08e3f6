"""Registered queries on field protection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect.config import TENANT
from recollect.functions import crypto
from recollect.operators import protect
from recollect.plans import inputs as i
from recollect.sources.scratch import stored

POLICY = {"segment": crypto.DETERMINISTIC, "name": crypto.RANDOM}
#: What counts as a mail address in a text.
MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
CM_SQL = """cm AS (SELECT CAST(doc_id AS VARCHAR) AS memory_id, lang, c_name AS name, c_mktsegment AS segment, text
FROM documents LEFT JOIN customer ON doc_id = c_custkey)"""


def _protected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return protect.encrypt_fields(
        i.customer_memories(spark, sf_dir), POLICY, i.session_key(spark)
    )


def _secured(path: str):
    return F.col("secure_metadata")[path]


def p1_deterministic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal values give one ciphertext, different ones different ones."""
    key = i.session_key(spark)
    rows = _protected(spark, sf_dir).select(
        protect.decrypt_field("segment", key).alias("segment"), _secured("segment").alias("ct")
    )
    return rows.groupBy("segment").agg(
        F.countDistinct("ct").alias("ciphertexts"), F.count(F.lit(1)).alias("memories")
    )


P1 = f"""WITH {CM_SQL} SELECT segment, count(DISTINCT segment) AS ciphertexts, count(*) AS memories FROM cm GROUP BY 1"""


def p2_randomised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same value encrypted for every row: no two ciphertexts are alike."""
    key, path = i.session_key(spark), F.lit("lang")
    lang = F.col("custom_metadata")["lang"]
    ct = crypto.encrypt(lang, key, crypto.RANDOM, path)
    rows = i.customer_memories(spark, sf_dir).select(ct.alias("ct"))
    return rows.groupBy(crypto.decrypt(F.col("ct"), key, path).alias("lang")).agg(
        F.countDistinct("ct").alias("ciphertexts"), F.count(F.lit(1)).alias("memories")
    )


P2 = f"WITH {CM_SQL} SELECT lang, count(*) AS ciphertexts, count(*) AS memories FROM cm GROUP BY 1"


def p3_decrypt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values come back; under another path's name they do not."""
    key = i.session_key(spark)
    opened = protect.decrypt_fields(_protected(spark, sf_dir), ["segment", "name"], key)
    misread = crypto.decrypt(_secured("segment"), key, F.lit("name"))
    return opened.select("memory_id", "segment", "name", misread.isNull().alias("path_is_bound"))


P3 = f"WITH {CM_SQL} SELECT memory_id, segment, name, true AS path_is_bound FROM cm"


def p4_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which memories hold each customer segment, found without decrypting any."""
    probes = i.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("value"))
    found = protect.lookup_encrypted(
        _protected(spark, sf_dir), probes.distinct(), "segment", i.session_key(spark)
    )
    return found.select("memory_id", "value")


P4 = f"WITH {CM_SQL} SELECT memory_id, segment AS value FROM cm WHERE segment IS NOT NULL"


def p5_still_ciphertext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over all rows: present, left in the clear, decrypting to the original."""
    before = i.customer_memories(spark, sf_dir).select(
        "memory_id", F.col("custom_metadata")["name"].alias("plain")
    )
    rows = _protected(spark, sf_dir).join(before, "memory_id")
    return protect.ciphertext_report(
        rows, _secured("name"), F.col("plain"), i.session_key(spark), "name"
    )


P5 = f"WITH {CM_SQL} SELECT count(name) AS present, CAST(0 AS BIGINT) AS in_clear, count(name) AS round_trips FROM cm"


def p6_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the policy leaves readable, what it moved, and that what it moved comes back."""
    rows = protect.decrypt_fields(_protected(spark, sf_dir), ["name", "segment"], i.session_key(spark))
    names = F.array_join(F.sort_array(F.map_keys("custom_metadata")), ",")
    moved = F.array_join(F.sort_array(F.map_keys("secure_metadata")), ",")
    return rows.select(
        "memory_id",
        F.col("custom_metadata")["lang"].alias("lang"),
        names.alias("readable"),
        moved.alias("secured"),
        "name",
        "segment",
    )


P6 = f"WITH {CM_SQL} SELECT memory_id, lang, 'lang' AS readable, CASE WHEN name IS NULL THEN '' ELSE 'name,segment' END AS secured, name, segment FROM cm"


def p7_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every mail address of a text is a protected field; English texts have them masked."""
    docs = i.table(spark, sf_dir, "documents")
    mails = F.array_distinct(F.regexp_extract_all("text", F.lit(MAIL), F.lit(0)))
    masked = F.when(F.col("lang") == "en", F.regexp_replace("text", MAIL, "")).otherwise(F.col("text"))
    rows = docs.select("doc_id", masked.alias("text"), F.explode(mails).alias("mail"))
    return protect.exposure(rows, F.col("mail"), "text").select("doc_id", "mail")


P7 = f"""SELECT doc_id, mail FROM (
  SELECT doc_id, lang, unnest(list_distinct(regexp_extract_all(text, '{MAIL}'))) AS mail,
         CASE WHEN lang = 'en' THEN regexp_replace(text, '{MAIL}', '', 'g') ELSE text END AS shown FROM documents) d
WHERE contains(shown, mail)"""


RULES = {"name": protect.FieldRule(crypto.RANDOM, 1), "segment": protect.FieldRule(crypto.DETERMINISTIC, 2)}
ROTATED = RULES | {"segment": protect.FieldRule(crypto.DETERMINISTIC, 3)}


def _by_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ring = crypto.key_ring(i.session_key(spark), [1, 2])
    return protect.encrypt_by_rules(i.customer_memories(spark, sf_dir), RULES, ring)


def p6_key_per_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which key each field is under, and that its own key alone opens it."""
    ring = crypto.key_ring(i.session_key(spark), [1, 2])
    opened = protect.decrypt_by_ring_fields(_by_rules(spark, sf_dir), ["name", "segment"], ring)
    swapped = {1: ring[2], 2: ring[1]}
    misread = [crypto.decrypt_by_ring(_secured(p), r, F.lit(p)).isNull() for p in RULES for r in (swapped, {9: ring[1]})]
    return opened.select(
        "memory_id", "name", "segment", crypto.key_number(_secured("name")).alias("name_key"),
        crypto.key_number(_secured("segment")).alias("segment_key"), (misread[0] & misread[1] & misread[2] & misread[3]).alias("others_fail"),
    )


P6K = f"""WITH {CM_SQL} SELECT memory_id, name, segment, CASE WHEN name IS NOT NULL THEN 1 END AS name_key,
  CASE WHEN segment IS NOT NULL THEN 2 END AS segment_key, true AS others_fail FROM cm"""


def p3_after_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments go from key 2 to key 3: with the new ring they read as before, with the old one
    not; names stay as they were, to the byte; and a second rotation changes nothing."""
    master = i.session_key(spark)
    before = stored(_by_rules(spark, sf_dir), "under-two")
    after = stored(protect.rotate(before, ROTATED, crypto.key_ring(master, [1, 2, 3])), "under-three")
    again = protect.rotate(after, ROTATED, crypto.key_ring(master, [1, 2, 3]))
    opened = protect.decrypt_by_ring_fields(after, ["name", "segment"], crypto.key_ring(master, [1, 3]))
    old = before.select("memory_id", F.col("secure_metadata").alias("old"))
    twice = again.select("memory_id", F.col("secure_metadata").alias("twice"))
    late = crypto.decrypt_by_ring(_secured("segment"), crypto.key_ring(master, [1, 2]), F.lit("segment"))
    return opened.join(old, "memory_id").join(twice, "memory_id").select(
        "memory_id", "name", "segment", crypto.key_number(_secured("segment")).alias("segment_key"),
        late.isNull().alias("old_ring_fails"), _secured("name").eqNullSafe(F.col("old")["name"]).alias("name_kept"),
        (_secured("segment").eqNullSafe(F.col("twice")["segment"]) & _secured("name").eqNullSafe(F.col("twice")["name"])).alias("settled"),
    )


P3R = f"""WITH {CM_SQL} SELECT memory_id, name, segment, CASE WHEN segment IS NOT NULL THEN 3 END AS segment_key,
  true AS old_ring_fails, true AS name_kept, true AS settled FROM cm"""

TENANT_SQL = "'app' || (doc_id % 3) AS app_name, 'u' || (doc_id % 20) AS user_id"


def p7_any_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every mail address of a tenant's texts is protected in all texts of that tenant, in which
    English ones have them masked; and every customer's segment is, in the customer's tenant."""
    docs = i.table(spark, sf_dir, "documents").withColumn("app_name", F.concat(F.lit("app"), (F.col("doc_id") % 3).cast("string")))
    docs = docs.withColumn("user_id", F.concat(F.lit("u"), (F.col("doc_id") % 20).cast("string")))
    mails = docs.select(*TENANT, F.explode(F.regexp_extract_all("text", F.lit(MAIL), F.lit(0))).alias("value"))
    held = i.customer_memories(spark, sf_dir).select(*TENANT, F.lower(F.col("custom_metadata")["segment"]).alias("value"))
    masked = F.when(F.col("lang") == "en", F.regexp_replace("text", MAIL, "")).otherwise(F.col("text"))
    shown = docs.select(*TENANT, F.col("doc_id").alias("memory_id"), masked.alias("transcript"))
    return protect.exposed_values(shown, mails.union(held), list(TENANT))


P7A = f"""WITH d AS (SELECT *, {TENANT_SQL} FROM documents),
v AS (SELECT DISTINCT app_name, user_id, value FROM (
  SELECT app_name, user_id, unnest(regexp_extract_all(text, '{MAIL}')) AS value FROM d
  UNION ALL SELECT app_name, user_id, lower(c_mktsegment) FROM d JOIN customer ON doc_id = c_custkey) u WHERE value <> ''),
s AS (SELECT app_name, user_id, doc_id AS memory_id,
  CASE WHEN lang = 'en' THEN regexp_replace(text, '{MAIL}', '', 'g') ELSE text END AS shown FROM d)
SELECT s.app_name, s.user_id, memory_id, value FROM s JOIN v ON s.app_name = v.app_name AND s.user_id = v.user_id
WHERE contains(shown, value)"""


QUERIES = {
    "p6_key_per_field": (p6_key_per_field, P6K),
    "p3_after_rotation": (p3_after_rotation, P3R),
    "p7_any_value": (p7_any_value, P7A),
    "p1_deterministic": (p1_deterministic, P1),
    "p2_randomised": (p2_randomised, P2),
    "p3_decrypt": (p3_decrypt, P3),
    "p4_lookup": (p4_lookup, P4),
    "p5_still_ciphertext": (p5_still_ciphertext, P5),
    "p6_policy": (p6_policy, P6),
    "p7_exposure": (p7_exposure, P7),
}
