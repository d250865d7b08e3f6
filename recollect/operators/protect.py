"""Protecting metadata fields that must be stored but never searched."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.functions.crypto import DETERMINISTIC, decrypt, decrypt_by_ring, encrypt, encrypt_under, key_number
from recollect.functions.grams import gram_places
from recollect.functions.maps import empty_map
from recollect.sources.scratch import stored

SECURE_MAP = "map<string,binary>"


@dataclass(frozen=True)
class FieldRule:
    """How one field is protected: the algorithm and the number of its key."""

    algorithm: str
    key: int


def encrypt_fields(memories: DataFrame, policy: Mapping[str, str], key: bytes) -> DataFrame:
    """Moves each metadata path of the policy from ``custom_metadata`` to
    ``secure_metadata``, encrypted by its algorithm; the path is authenticated too."""
    plain = F.col("custom_metadata")
    return _secured(memories, {path: encrypt(plain[path], key, algorithm, F.lit(path)) for path, algorithm in policy.items()})


def encrypt_by_rules(memories: DataFrame, rules: Mapping[str, FieldRule], ring: Mapping[int, bytes]) -> DataFrame:
    """Like ``encrypt_fields``, but each field has a key of its own, whose number stands in
    front of the ciphertext."""
    plain = F.col("custom_metadata")
    return _secured(memories, {p: encrypt_under(plain[p], ring, r.key, r.algorithm, F.lit(p)) for p, r in rules.items()})


def decrypt_by_ring_fields(memories: DataFrame, paths: list[str], ring: Mapping[int, bytes]) -> DataFrame:
    """A column for each path; null where absent, or under a key that the ring lacks."""
    held = F.col("secure_metadata")
    return memories.select("*", *[decrypt_by_ring(held[p], ring, F.lit(p)).alias(p) for p in paths])


def rotate(memories: DataFrame, rules: Mapping[str, FieldRule], ring: Mapping[int, bytes]) -> DataFrame:
    """Re-encrypts what is not yet under its rule's key. A row whose fields all are keeps its
    ciphertext; a value under a key that the ring lacks stays as it is rather than being lost."""
    held, fresh = F.col("secure_metadata"), F.col("secure_metadata")
    for path, rule in rules.items():
        plain = decrypt_by_ring(held[path], ring, F.lit(path))
        old = (key_number(held[path]) != rule.key) & plain.isNotNull()
        renewed = encrypt_under(plain, ring, rule.key, rule.algorithm, F.lit(path))
        others = F.map_filter(fresh, _other_than(path))
        fresh = F.when(old, F.map_concat(others, F.create_map(F.lit(path), renewed).cast(SECURE_MAP))).otherwise(fresh)
    return memories.withColumn("secure_metadata", fresh)


def _other_than(path: str):
    return lambda k, _: k != path


def _secured(memories: DataFrame, ciphertexts: Mapping[str, Column]) -> DataFrame:
    plain, policy = F.col("custom_metadata"), list(ciphertexts)
    secured = [cell for path, value in ciphertexts.items() for cell in (F.lit(path), value)]
    fresh = F.map_filter(F.create_map(*secured).cast(SECURE_MAP), lambda _, v: v.isNotNull())
    kept = F.map_filter(
        F.coalesce("secure_metadata", F.create_map().cast(SECURE_MAP)),
        lambda k, _: ~F.map_contains_key(fresh, k),
    )
    public = F.map_filter(plain, lambda k, _: ~k.isin(*policy))
    return memories.withColumn("secure_metadata", F.map_concat(kept, fresh)).withColumn(
        "custom_metadata", F.coalesce(public, empty_map())
    )


def decrypt_field(path: str, key: bytes) -> Column:
    """Plaintext of one secured path; null where absent or not decryptable."""
    return decrypt(F.col("secure_metadata")[path], key, F.lit(path))


def decrypt_fields(memories: DataFrame, paths: list[str], key: bytes) -> DataFrame:
    return memories.select("*", *[decrypt_field(p, key).alias(p) for p in paths])


def lookup_encrypted(
    memories: DataFrame, probes: DataFrame, path: str, key: bytes, value: str = "value"
) -> DataFrame:
    """Memories whose secured field equals a probe value, compared as ciphertext; the
    stored values are never decrypted. The field must be deterministically encrypted.
    A value that is asked repeatedly is looked up once."""
    asked = probes.dropDuplicates([value])
    sought = asked.withColumn("_ct", encrypt(F.col(value), key, DETERMINISTIC, F.lit(path)))
    held = memories.withColumn("_ct", F.col("secure_metadata")[path]).filter("_ct is not null")
    return held.join(sought, "_ct").drop("_ct")


def ciphertext_report(
    rows: DataFrame, ciphertext: Column, plain: Column, key: bytes, path: str
) -> DataFrame:
    """Counts of values present, stored in the clear by mistake, and decrypting well."""
    return rows.agg(
        F.count(plain).alias("present"),
        F.count_if(ciphertext == plain.cast("binary")).alias("in_clear"),
        F.count_if(decrypt(ciphertext, key, F.lit(path)) == plain).alias("round_trips"),
    )


def exposure(rows: DataFrame, plain: Column, transcript: str = "transcript") -> DataFrame:
    """Rows whose searchable text contains the value that should be protected."""
    return rows.filter((F.length(plain) > 0) & F.contains(F.col(transcript), plain))


# ---- any protected value of a tenant in any of its texts ---------------------

#: Characters of an anchor; shorter values are their own anchor.
ANCHOR = 6
#: Up to so many substrings of values are sent to the tasks (8 bytes each), which then hand on
#: nothing else; beyond, all places of all texts are joined by shuffle.
BROADCAST_GRAMS = 1_000_000


def exposed_values(
    memories: DataFrame, values: DataFrame, tenant: list[str], value: str = "value", transcript: str = "transcript",
    memory_id: str = "memory_id", length: int = ANCHOR,
) -> DataFrame:
    """``tenant, memory_id, value`` wherever a text of a tenant holds any protected value of that
    tenant, whichever memory the value belongs to.

    A value occurs only where its rarest substring of ``length`` characters does (by its count in
    the tenant's texts). These anchors are joined with the places of the texts by their hash,
    and where one matches the whole value is compared, so neither texts nor values are held
    against each other one by one. Null and empty values and texts hold nothing; a value that
    several memories share is sought once. Memory ids are unique within a tenant.
    """
    text = F.col("text")
    sought = values.select(*tenant, F.col(value).alias("value")).filter("value <> ''").distinct()
    sought = stored(sought, "values")
    texts = memories.select(*tenant, F.col(memory_id).alias("memory_id"), F.col(transcript).alias("text")).filter("text <> ''")
    own_length = F.least(F.lit(length), F.char_length("value"))
    lengths = sorted(r[0] for r in sought.select(own_length).distinct().collect())  # at most ``length`` numbers
    if not lengths:
        return texts.select(*tenant, "memory_id", text.alias("value")).limit(0)

    def placed(rows: DataFrame, name: str, keep: list[str], wanted) -> DataFrame:
        """``keep, gram, pos``: a row for each place of a substring."""
        found = rows.select(*keep, F.explode(gram_places(F.col(name), lengths, wanted)).alias("_g"))
        return found.select(*keep, "_g.*")

    # a value's substrings all have one length: the anchor's, or its own where it is shorter
    by_length = [
        sought.filter(own_length == n).select(*tenant, "value", F.explode(gram_places(F.col("value"), [n])).alias("_g")) for n in lengths
    ]
    grams = reduce(DataFrame.union, by_length).select(*tenant, "value", "_g.*")
    known = [r[0] for r in grams.select("gram").distinct().limit(BROADCAST_GRAMS + 1).collect()]
    few = len(known) <= BROADCAST_GRAMS
    wanted = np.sort(np.array(known, np.int64)) if few else None
    counts = placed(texts, "text", tenant, wanted).groupBy(*tenant, "gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = F.min(F.struct("_n", "gram", "pos")).alias("_m")
    anchors = grams.join(counts, [*tenant, "gram"]).groupBy(*tenant, "value").agg(rarest)
    anchors = stored(anchors.select(*tenant, "value", "_m.gram", F.col("_m.pos").alias("_offset")), "anchors")
    chosen = np.sort(np.array([r[0] for r in anchors.select("gram").distinct().collect()], np.int64)) if few else None
    if anchors.count() <= BROADCAST_GRAMS:
        anchors = F.broadcast(anchors)
    places = placed(texts, "text", [*tenant, "memory_id"], chosen).join(anchors, [*tenant, "gram"])
    start = (F.col("pos") - F.col("_offset") + 1).alias("_start")
    near = places.select(*tenant, "memory_id", "value", start).filter("_start >= 1").distinct()
    here = F.substr(text, F.col("_start"), F.char_length("value"))
    found = texts.join(near, [*tenant, "memory_id"]).filter(here == F.col("value"))
    return found.select(*tenant, "memory_id", "value").distinct()
