"""Small tables with everything that may go wrong in them."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid string, doc string, words string, kept string, key string, n_words string"


def table(spark, rows, partitions=3):
    """Rows of (doc_id, text[, source]); the other columns clash with names used inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, "u", "d", "w", "k", "y", "n") for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


def prose(rng, n, words=400):
    vocabulary = [f"w{k}{'aeiou'[k % 5]}" for k in range(words)]
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def messy(rng=None):
    rng = rng or random.Random(3)
    text = prose(rng, 60)
    return [
        (1, text, "a"), (2, text, "a"), (3, text + " more", None), (4, None, "a"), (5, "", "b"), (6, " \n\t ", "b"),
        (None, text, "b"), (None, None, None), (7, "one", "b"), (7, "one", "b"), (8, "日本語 の テキスト\n" * 5, "c"),
        (9, prose(rng, 30_000), "c"), (10, "\n".join([prose(rng, 20)] * 4), "c"),
    ]


def near(rng, text, changes):
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)
