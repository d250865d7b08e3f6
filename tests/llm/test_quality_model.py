import random
import zlib

from recollect.llm import quality_model

from .corpus import messy, prose, table


def test_learns_from_the_other_folds_only(spark):
    rng = random.Random(15)
    good = {k: k % 3 != 0 for k in range(400)}
    rows = [(k, prose(rng, 50) if ok else f"buy {prose(rng, 10)} now!!! " * 4) for k, ok in good.items()]
    rows += [(k, None if k % 2 else "") for k in (1000, 1001)]
    # held-out labels are wrong on purpose: they must not be looked at
    labels = spark.createDataFrame(
        [(k, int(ok != (zlib.crc32(str(k).encode()) % 3 == 1)), 0, "x") for k, ok in good.items()],
        "doc_id long, quality int, toxic int, text string",
    )
    got = {r.doc_id: r for r in quality_model.quality(table(spark, rows), labels).collect()}
    held = [k for k in good if zlib.crc32(str(k).encode()) % 3 == 1]
    assert all(got[k].held_out == (k in held) for k in good)
    assert sum(got[k].predicted == good[k] for k in held) >= 0.95 * len(held)
    assert got[1000].score == got[1001].score
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_messy_texts_one_label_and_no_labels(spark):
    docs = table(spark, messy())
    schema = "doc_id long, quality int, toxic int"
    for labels in ([], [(1, 1, 0), (None, 0, 0), (2, None, 0)]):
        got = quality_model.quality(docs, spark.createDataFrame(labels, schema)).collect()
        assert len(got) == len(messy()) and all(0 <= r.score <= 1 for r in got)
    assert quality_model.quality(table(spark, []), spark.createDataFrame([], schema)).count() == 0
