"""Benchmark passages in documents: a prefix-filtered join of windows, on built-in functions.

A window must be contained in the document whole, so of its words ordered by rarity the
first one is a necessary prefix: only places of a window's rarest word are looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recollect.llm.store import beside, stored
from recollect.llm.tokens import tokens

#: Words of a window; an item of fewer words is one window.
WINDOW = 10
#: Benchmark tables are broadcast up to this number of rows (about 100 bytes each); beyond,
#: the joins are shuffled.
BROADCAST_ROWS = 200_000


def _few(df: DataFrame) -> bool:
    return df.count() <= BROADCAST_ROWS


def _small(df: DataFrame) -> DataFrame:
    """``df`` (a stored table), marked for broadcast if its rows are few enough."""
    return F.broadcast(df) if _few(df) else df


def _windows(benchmark: DataFrame, item_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """``wid, win, len`` of the distinct windows, and ``wid, item``."""
    items = benchmark.select(
        benchmark[f"`{item_id}`"].cast("string").alias("item"),
        tokens(F.coalesce(benchmark[f"`{text}`"].cast("string"), F.lit(""))).alias("words"),
    ).filter(F.size("words") > 0)
    last = F.greatest(F.size("words") - WINDOW, F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, WINDOW))
    placed = stored(items.select("item", F.explode(cut).alias("win")).distinct(), "items")
    wins = stored(
        placed.select("win").distinct().select(F.monotonically_increasing_id().alias("wid"), "win", F.size("win").alias("len")),
        "windows",
    )
    return wins, stored(placed.join(wins, "win").select("wid", "item"), "window-items")


def _prefixes(words: DataFrame, wins: DataFrame) -> DataFrame:
    """``word, p, len``: the rarest word of each window by its count in the corpus, and its
    first place in the window."""
    vocabulary = _small(stored(wins.select(F.explode("win").alias("word")).distinct(), "vocabulary"))
    counts = words.select(F.explode("words").alias("word")).join(vocabulary, "word", "left_semi").groupBy("word").count()
    placed = wins.select("wid", "len", F.posexplode("win").alias("p", "word"))
    # a word that no document has cannot lead to an occurrence
    ranked = placed.join(counts, "word", "left").groupBy("wid").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "word", "p", "len")).alias("m")
    )
    return ranked.filter("m.count > 0").select("m.word", "m.p", "m.len").distinct()


def _occurrences(words: DataFrame, wins: DataFrame) -> DataFrame:
    """``uid, start, len, wid`` of every occurrence of every window, some of them repeatedly."""
    prefix = stored(_prefixes(words, wins), "prefixes")
    start = (F.col("pos") - F.col("p")).alias("start")
    possible = "start >= 0 and start + len <= n"
    if _few(prefix):
        # places are found and checked in the row that has the words, so words are not shuffled
        places = words.select("uid", "n", "words", F.posexplode("words").alias("pos", "word")).join(F.broadcast(prefix), "word")
        near = places.select("uid", "n", "words", start, "len").filter(possible)
        # Spark may cut a window before it drops impossible starts
        win = F.slice("words", F.greatest("start", F.lit(0)) + 1, F.col("len")).alias("win")
        found = near.select("uid", "start", "len", win)
    else:
        places = words.select("uid", "n", F.posexplode("words").alias("pos", "word")).join(prefix, "word")
        near = places.select("uid", "n", start, "len").filter(possible)
        near = stored(near.groupBy("uid").agg(F.collect_set(F.struct("start", "len")).alias("at")), "candidates")
        slices = F.transform("at", lambda a: F.struct(a.start.alias("start"), a.len.alias("len"), F.slice("words", a.start + 1, a.len).alias("win")))
        # candidates grow with the documents, so no broadcast is asked for
        found = words.select("uid", "words").join(near, "uid").select("uid", F.explode(slices).alias("a")).select("uid", "a.*")
    return stored(found.join(_small(wins.drop("len")), "win").drop("win"), "occurrences")


def _hit(spans):
    """Words covered by a sorted array of ``start, len``."""
    zero = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("end"))

    def step(acc, span):
        stop = span.start + span.len
        return F.struct(
            (acc.sum + F.greatest(F.lit(0), stop - F.greatest(acc.end, span.start))).alias("sum"),
            F.greatest(acc.end, stop).alias("end"),
        )

    return F.aggregate(spans, zero, step, lambda acc: acc.sum)


def _words(docs: DataFrame, id_col: str, text: str, carry: bool) -> DataFrame:
    kept = F.struct(*[docs[f"`{c}`"] for c in (docs.columns if carry else [id_col])]).alias("doc")
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), kept,
        tokens(F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))).alias("words"),
    )
    return stored(rows.withColumn("n", F.size("words")), "words")


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``.

    A word is hit when it lies in an occurrence of a window: WINDOW consecutive words of an
    item, or all words of a shorter one. Null, empty and word-less texts have no words and,
    as items, no windows. Items that repeat an id count once; an item with a null id hits
    words but is not counted or listed. Repeated rows of ``docs`` are rows of their own;
    other columns are not looked at.
    """
    rows = _words(docs, id_col, text, carry=False)
    wins, items = _windows(benchmark, item_id, item_text)
    found = _occurrences(rows, wins)
    hits = found.groupBy("uid").agg(F.array_sort(F.collect_set(F.struct("start", "len"))).alias("spans"))
    hits = hits.select("uid", _hit(F.col("spans")).cast("long").alias("n_hit"))
    named = found.select("uid", "wid").distinct().join(_small(items), "wid").filter("item is not null")
    named = named.select("uid", "item").distinct().groupBy("uid").agg(F.array_sort(F.collect_list("item")).alias("items"))
    none = F.array().cast("array<string>")
    return (
        rows.select("uid", "doc", F.col("n").cast("long").alias("n_words")).join(hits, "uid", "left").join(named, "uid", "left")
        .select(
            F.col("doc")[id_col].alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
            F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0).cast("long")) > 0).alias("contaminated"),
        )
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` without an occurrence of a benchmark window, with all columns."""
    rows = _words(docs, id_col, text, carry=True)
    wins, _ = _windows(benchmark, item_id, item_text)
    hit = stored(_occurrences(rows, wins).select("uid").distinct(), "hit")
    return beside(rows.select("uid", "doc"), hit, "left_anti").select("doc.*")
