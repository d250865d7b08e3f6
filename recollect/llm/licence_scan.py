"""Licence notices in files: a positional index of rare licence words, on built-in functions.

Each notice is indexed by its words of highest inverse document frequency among all
notices. A file's places of such words vote for (notice, place in the file of the notice's
start); where the votes at one relative position carry enough of the notice's weight, its
mandatory phrases are checked in the file's own words.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect.llm.licences import NOTICES, PHRASES
from recollect.llm.store import stored
from recollect.llm.tokens import tokens

#: Words of a notice that are indexed, the rarest first.
INDEXED = 12
#: Share of a notice's indexed weight that must agree on one position.
MIN_SHARE = 0.7


def notice_words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


def postings() -> list[tuple[str, int, int, int]]:
    """``word, notice, place, weight``; weights are thousandths of the IDF, so sums are exact."""
    split = [notice_words(text) for _, text, _ in NOTICES]
    having = Counter(word for words in split for word in set(words))
    idf = {word: round(1000 * math.log(1 + len(split) / n)) for word, n in having.items()}
    found = []
    for notice, words in enumerate(split):
        rare = sorted(set(words), key=lambda w: (-idf[w], w))[:INDEXED]
        found += [(w, notice, place, idf[w]) for place, w in enumerate(words) if w in rare]
    return found


def notices() -> list[tuple[int, str, int, int, list[str]]]:
    """``notice, label, words, weight, phrases``."""
    weight = Counter()
    for _, notice, _, w in postings():
        weight[notice] += w
    return [
        (n, label, len(notice_words(text)), weight[n], phrases) for n, (label, text, phrases) in enumerate(NOTICES)
    ]


def _spaced(words: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))


def _places(spaced: Column, phrase: str) -> tuple[Column, Column, Column]:
    """Number of places of a phrase, and the words before the first and the last (or null)."""
    has = F.contains(spaced, F.lit(f" {phrase} "))
    pattern = f" {phrase}(?= )"

    def before(regex: str) -> Column:
        head = F.regexp_extract(spaced, regex, 1)
        return F.char_length(head) - F.char_length(F.replace(head, F.lit(" "), F.lit("")))

    return (
        F.when(has, F.regexp_count(spaced, F.lit(pattern))).otherwise(0),
        F.when(has, before(f"(?s)^(.*?){pattern}")),
        F.when(has, before(f"(?s)^(.*){pattern}")),
    )


def _indexed(words: Column) -> Column:
    """The distinct words of a file that some notice is indexed by."""
    return F.array_intersect(F.array(*[F.lit(w) for w in sorted({p[0] for p in postings()})]), words)


def _may_hold(present: Column) -> Column:
    """Whether the indexed words present could carry enough of some notice's weight,
    wherever they stand. Other files need not be looked up."""
    weight: dict[int, Counter] = {}
    for word, notice, _, w in postings():
        weight.setdefault(notice, Counter())[word] += w
    known = F.array(*[
        F.struct(
            F.lit(MIN_SHARE * sum(parts.values())).alias("least"),
            F.array(*[F.struct(F.lit(word).alias("word"), F.lit(w).alias("weight")) for word, w in parts.items()]).alias("parts"),
        )
        for parts in weight.values()
    ])
    held = lambda acc, part: acc + F.when(F.array_contains(present, part.word), part.weight).otherwise(0)
    return F.exists(known, lambda n: F.aggregate(n.parts, F.lit(0), held) >= n.least)


def _base(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    words = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.struct(docs[f"`{id_col}`"]).alias("doc"),
        tokens(F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))).alias("words"),
    )
    found = words.select("uid", "doc", "words", _spaced(F.col("words")).alias("spaced"), _indexed(F.col("words")).alias("present"))
    places = {label: _places(F.col("spaced"), phrase) for phrase, label in PHRASES}
    total = sum((p[0] for p in places.values()), F.lit(0))
    labels = F.array_compact(F.array(*[F.when(places[label][0] > 0, label) for label in sorted(places)]))
    return found.select(
        "uid", "doc", F.size("words").cast("long").alias("n_words"), total.cast("long").alias("n_base"),
        F.least(*[p[1] for p in places.values()]).cast("long").alias("first_word"),
        F.greatest(*[p[2] for p in places.values()]).cast("long").alias("last_word"),
        labels.alias("base"), F.when(_may_hold(F.col("present")), F.col("words")).alias("words"),
    )


def _regions(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``uid, label, share`` of every notice found."""
    # both tables hold the fixed notices above: some hundred rows, whatever the corpus
    index = F.broadcast(spark.createDataFrame(postings(), "word string, notice int, place int, weight long"))
    known = F.broadcast(spark.createDataFrame(notices(), "notice int, label string, len int, full long, phrases array<string>"))
    scanned = rows.filter("words is not null")
    votes = (
        scanned.select("uid", F.posexplode("words").alias("pos", "word")).join(index, "word")
        .groupBy("uid", "notice", (F.col("pos") - F.col("place")).alias("start")).agg(F.sum("weight").alias("got"))
        .join(known, "notice").filter(F.col("got") >= MIN_SHARE * F.col("full"))
    )
    # stored, so that its size decides how the words of the few files with votes are found
    votes = stored(votes, "licence-votes")
    from_word = F.greatest(F.col("start"), F.lit(0))
    region = _spaced(F.slice("words", from_word + 1, F.col("start") + F.col("len") - from_word))
    checked = votes.join(scanned.select("uid", "words"), "uid").withColumn("region", region)
    checked = checked.filter(F.forall("phrases", lambda p: F.contains(F.col("region"), F.concat(F.lit(" "), p, F.lit(" ")))))
    return checked.select("uid", "label", (F.col("got") / F.col("full")).alias("share"))


def licence_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for every row.

    ``n_base`` counts the places where the words of a phrase stand consecutively;
    ``first_word`` and ``last_word`` are the least and the greatest start (null without
    one). ``labels`` adds those of the notices found; ``score`` is the largest share of a
    found notice's indexed weight, 0 where none is found. Null and empty texts have no
    words. Repeated rows are rows of their own; other columns are not looked at.
    """
    rows = stored(_base(docs, id_col, text), "licence-words")
    found = _regions(docs.sparkSession, rows).groupBy("uid").agg(
        F.collect_set("label").alias("more"), F.max("share").alias("score")
    )
    none = F.array().cast("array<string>")
    return rows.drop("words").join(found, "uid", "left").select(
        F.col("doc")[id_col].alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", none)))), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
