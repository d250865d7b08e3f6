from recollect import MemoryConfig, hashing_embedder, schema

DIMS = 32
CONFIG = MemoryConfig(embedder=hashing_embedder(DIMS), dimensions=DIMS)


def event(session, seq, author, text, event_id=None, app="app", user="ann"):
    parts = None if text is None else [(t,) for t in ([text] if isinstance(text, str) else text)]
    return (app, user, session, seq, event_id, author, parts)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), schema.EVENTS)


def session(spark, turns, session_id="s", app="app", user="ann"):
    """A session from (author, text) pairs, with event ids e0, e1, ..."""
    rows = [event(session_id, n, a, t, f"e{n}", app, user) for n, (a, t) in enumerate(turns)]
    return events(spark, *rows)


def questions(spark, *rows):
    return spark.createDataFrame(list(rows), schema.QUERIES)


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]
