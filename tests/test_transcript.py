import pytest
from helpers import event, events, one, session
from pyspark.sql import functions as F

from recollect.functions import text as tx
from recollect.operators.distill import (
    batch_distiller,
    compression_report,
    distill,
    keep_user_lines,
)
from recollect.operators.transcript import segments, transcripts

TRIP = [
    ("user", "We fly to Lisbon in the second week of May."),
    ("assistant", "Lovely, the jacarandas will be in bloom!"),
    ("user", "Please remember that I eat no fish."),
    ("assistant", "Noted: no fish."),
]


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("raw", ["  a b \n", " x　", "\x1c\x85y\xa0", "\t\r\n", ""])
def test_strip_is_unicode_aware(spark, raw):
    assert value(spark, tx.strip(F.lit(raw))) == raw.strip()


def test_events_without_text_are_dropped(spark):
    rows = events(
        spark,
        event("s", 0, "user", None),
        event("s", 1, "user", []),
        event("s", 2, "user", [None, "", " \n "]),
        event("s", 3, None, [" a", None, "b "], None),
        event("s", 4, "", "c", ""),
        event("s", 5, "user", "d", "e5"),
    )
    got = [(r.event_id, r.author, r.text) for r in segments(rows).orderBy("seq").collect()]
    assert got == [("", "unknown", "ab"), ("", "unknown", "c"), ("e5", "user", "d")]


def test_missing_session_becomes_the_shared_one(spark):
    rows = events(spark, event(None, 0, "u", "a"), event("", 1, "u", "b"), event("x", 2, "u", "c"))
    got = {r.text: r.session_id for r in segments(rows, default_session=True).collect()}
    assert got == {"a": "_default", "b": "_default", "c": "x"}


@pytest.mark.parametrize("block_turns", [0, 1, 3, 1024])
def test_transcript_is_in_order_whatever_the_blocks(spark, block_turns):
    rows = [event("s", n, "u", f"t{n}", f"e{n}" if n % 2 else "") for n in range(-4, 40)]
    got = one(transcripts(segments(events(spark, *reversed(rows))), block_turns))
    assert got.transcript == "\n".join(f"u: t{n}" for n in range(-4, 40))
    assert got.event_ids == [f"e{n}" for n in range(-4, 40) if n % 2]
    assert got.turns == 44


def test_built_in_distiller(spark):
    got = one(distill(transcripts(segments(session(spark, TRIP))), keep_user_lines))
    assert got.stored_text == f"user: {TRIP[0][1]}\nuser: {TRIP[2][1]}"


@pytest.mark.parametrize(
    ("raw", "kept"),
    [
        ("USER: a\nbot: b\nuser: c", "USER: a\nuser: c"),
        ("bot: b\r\nuser: c User: d", "user: c\nUser: d"),
        ("user: first line\nsecond line", "user: first line"),
        ("bot: only", "bot: only"),
        ("bot: " + "x" * 3000, ("bot: " + "x" * 3000)[:2000]),
    ],
)
def test_distiller_lines_and_cap(spark, raw, kept):
    assert value(spark, keep_user_lines(F.lit(raw))) == kept


def test_blank_distillate_falls_back_to_raw(spark):
    rows = transcripts(segments(session(spark, TRIP[:1])))
    assert one(distill(rows, lambda t: F.lit(" \n"))).stored_text.startswith("user: We fly")
    assert one(distill(rows, lambda t: F.lit(None).cast("string"))).stored_text.startswith("user:")
    assert one(distill(rows, lambda t: F.lit(" kept as is "))).stored_text == " kept as is "


def test_python_distiller_runs_in_batches(spark):
    rows = transcripts(segments(session(spark, TRIP)))
    upper = batch_distiller(lambda: lambda texts: [t.upper() for t in texts])
    assert one(distill(rows, upper)).stored_text.startswith("USER: WE FLY")


def test_compression_report(spark):
    done = distill(transcripts(segments(session(spark, TRIP))), keep_user_lines)
    got = one(compression_report(done, ["user_id"]))
    assert got.kept_chars < got.raw_chars
    assert got.kept_ratio == pytest.approx(got.kept_chars / got.raw_chars)


@pytest.mark.parametrize(
    ("prior", "delta", "want"),
    [("a", "b", "a\nb"), (None, " b ", " b "), ("", "b", "b"), (" a", "b \n", "a\nb")],
)
def test_append(spark, prior, delta, want):
    assert value(spark, tx.append_text(F.lit(prior).cast("string"), F.lit(delta))) == want


def test_masking(spark):
    url = "db://ann:s3cret@host/x and db://host/y"
    assert value(spark, tx.mask_credentials(F.lit(url))) == "db://ann:****@host/x and db://host/y"
    assert value(spark, tx.mask_secret(F.lit("k=abc, abc"), "abc")) == "k=***REDACTED***, ***REDACTED***"
    assert value(spark, tx.mask_secret(F.lit("abc"), "")) == "abc"


def test_iso_timestamp(spark):
    def iso(ts):
        return value(spark, tx.iso_timestamp(F.lit(ts).cast("timestamp")))

    assert iso("2024-05-01 10:00:00") == "2024-05-01T10:00:00+00:00"
    assert iso("2024-05-01 10:00:00.25") == "2024-05-01T10:00:00.250000+00:00"
    assert iso(None) is None
