"""Each distinct text to the embedder once, in batches of about equal length."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recollect.config import DOCUMENT_INPUT, MemoryConfig
from recollect.operators import embedding as em
from recollect.sources.scratch import stored

#: Characters, and texts, that one call of a model gets at most (one text may be longer).
CALL_CHARS, CALL_TEXTS = 200_000, 2_048
#: Rows a text may be shared by before its vector is joined to them in pieces, and the pieces.
HOT_ROWS, PIECES = 100_000, 64


def embed_distinct(
    df: DataFrame, config: MemoryConfig, text_col: str = "stored_text", input_type: str = DOCUMENT_INPUT
) -> tuple[DataFrame, int]:
    """``df`` with ``embedding`` and ``embedding_ok``, like ``embed``, but each distinct text is
    sent to the model once instead of once per row; and how many were sent.

    Texts meet by a 256-bit digest: a row of digest, text and number of rows each goes to
    the embedder, its vectors are written once, and joined back to the rows. A text that very many
    rows share (a greeting, an error message) has its rows dealt to PIECES tasks. Null texts stay
    without a vector and are sent to nothing.
    """
    keyed = df.withColumn("_digest", F.unhex(F.sha2(F.col(text_col), 256)))
    once = keyed.filter("_digest is not null").groupBy("_digest").agg(F.first(text_col).alias("_text"), F.count(F.lit(1)).alias("_rows"))
    vector = config.embedder(F.col("_text"), input_type).alias("embedding")
    spread = once if config.embed_partitions is None else once.repartition(config.embed_partitions, "_digest")
    vectors = stored(spread.select("_digest", "_rows", vector), "vectors")
    hot = [r[0] for r in vectors.filter(F.col("_rows") > HOT_ROWS).select("_digest").limit(HOT_ROWS + 1).collect()]
    if hot and len(hot) <= HOT_ROWS:  # all of them are known, so only their rows are dealt out
        deal = F.when(F.col("_digest").isin(hot), F.pmod(F.monotonically_increasing_id(), F.lit(PIECES))).otherwise(0).cast("int")
        copies = F.when(F.col("_rows") > HOT_ROWS, PIECES).otherwise(1)
        each = vectors.withColumn("_piece", F.explode(F.sequence(F.lit(0), copies - 1)))
        both = keyed.withColumn("_piece", deal).join(each, ["_digest", "_piece"], "left").drop("_piece")
    else:
        both = keyed.join(vectors, "_digest", "left")
    kept = [c for c in df.columns if c not in ("embedding", "embedding_ok")]
    found = em.check_vectors(both.select(*[F.col(f"`{c}`") for c in kept], vectors["embedding"]), config)
    return found.withColumn("embedding_ok", em.embedding_ok("embedding", config.dimensions)), vectors.count()


def by_length(
    make_model: Callable[[], em.BatchFn], call_chars: int = CALL_CHARS, call_texts: int = CALL_TEXTS
):
    """An embedder around a Python model whose calls are cut by summed length.

    The texts of an Arrow batch are put in order of length, so that a call holds texts of about
    one length (models pad to the longest), and a call ends before it holds more than
    ``call_chars`` characters or ``call_texts`` texts; a longer text has a call of its own.
    Vectors come back in the order of the rows. Null texts are not sent.
    """

    def apply(text, input_type: str):
        @F.arrow_udf("array<float>")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = make_model()
            for column in batches:
                texts = column.to_pylist()
                found: list = [None] * len(texts)
                for call in calls([None if t is None else len(t) for t in texts], call_chars, call_texts):
                    vectors = model([texts[k] for k in call], input_type)
                    if len(vectors) != len(call):
                        raise ValueError(f"model returned {len(vectors)} vectors for {len(call)} texts")
                    for k, vector in zip(call, vectors):
                        found[k] = np.asarray(vector, dtype=np.float32)
                yield pa.array(found, pa.list_(pa.float32()))

        return run.asNondeterministic()(text)

    return apply


def calls(lengths: Sequence[int | None], chars: int, texts: int) -> list[list[int]]:
    """Places of the texts that each call gets, from the shortest on; null lengths get none."""
    found: list[list[int]] = []
    room = 0
    for k in sorted((k for k, n in enumerate(lengths) if n is not None), key=lambda k: (lengths[k], k)):
        if not found or lengths[k] > room or len(found[-1]) >= texts:
            found.append([])
            room = chars
        found[-1].append(k)
        room -= lengths[k]
    return found
