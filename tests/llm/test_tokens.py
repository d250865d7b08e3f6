import base64
import hashlib
import random
import sys
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from recollect.llm import bpe, packing, pretokens, token_counts

from .corpus import messy, prose, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["it's we'll I'VE 'tis ''s  'd", "a \n\n b\t c  ", "x <|endoftext|> y<|endoftext|><|endof", "ééß 日本語 ½²٣", "a\u0085b　c", "𓑡𓑢 ꟍ"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def machine():
    return bpe.compile_tables(bpe.read_ranks(RANKS))


def rows():
    return messy() + [(20 + k, t) for k, t in enumerate(ODD)]


def test_round_trip_equals_the_library(spark, library):
    def want(text):
        ids = library.encode_ordinary(text or "")
        digests = ",".join(map(str, ids)), text or ""
        return (len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in digests))

    got = bpe.round_trip(table(spark, rows()), RANKS).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((r[0], *want(r[1]))) for r in rows())
    assert bpe.round_trip(table(spark, []), RANKS).count() == 0


def test_ids_and_decoding(spark, library):
    coded = bpe.decode_ids(bpe.encode_ids(table(spark, rows()), RANKS, "words"), RANKS, "kept", "words")
    for r in coded.collect():
        assert r.words == library.encode_ordinary(r.text or "") and r.kept == (r.text or "")


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=12))
def test_transducer_on_any_string(machine, library, text):
    import pyarrow as pa

    tables = machine | {"classes": pretokens.classes(True)} if "classes" not in machine else machine
    machine.update(tables)
    ids = [i for _, ids, *_ in bpe.encoded(pa.array([text]), machine) for i in ids.tolist()]
    assert ids == library.encode_ordinary(text)


def test_full_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "STATES", 20)
    machine = bpe.Transducer(bpe.compile_tables(bpe.read_ranks(RANKS)))
    rng = random.Random(2)
    for _ in range(500):
        word = "".join(rng.choice("abcdeéo") for _ in range(rng.randint(1, 20)))
        assert machine.encode(word.encode()) == library.encode_ordinary(word)


def test_encoder_takes_little_memory():
    """A known pre-token is two short byte strings, and a batch is split in small pieces."""
    def deep(value):
        inner = sum(map(deep, value)) if isinstance(value, (tuple, list)) else 0
        return sys.getsizeof(value) + inner

    import pyarrow as pa

    tables = bpe.compile_tables(bpe.read_ranks(RANKS)) | {"classes": pretokens.classes(True)}
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=9)) for _ in range(2000)]
    list(bpe.encoded(pa.array([" ".join(words)]), tables))
    assert len(tables["known"]) >= 1990
    assert sum(deep(k) + deep(v) for k, v in tables["known"].items()) < 130 * len(tables["known"])
    column = pa.array([" ".join(words[:100]) * 250] * 24)  # 6 MB
    tracemalloc.start()
    sizes = [len(ids) for _, ids, *_ in bpe.encoded(column, tables)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(sizes) > 4 and peak < 60e6


@given(text=st.text(max_size=30), cut=st.integers(1, 5))
def test_streaming_utf8(text, cut):
    raw, stream = text.encode(), bpe.Utf8Stream()
    out = "".join(stream.feed(raw[k : k + cut]) for k in range(0, len(raw), cut)) + stream.close()
    assert out == text


def test_invalid_utf8_is_replaced():
    stream = bpe.Utf8Stream()
    assert stream.feed(b"a\xe2\x82") == "a" and stream.feed(b"b") == "�b" and stream.close() == ""


def test_counts_equal_the_library(spark):
    tokenizer = Tokenizer.from_file(JSON)
    got = token_counts.token_counts(table(spark, rows()), JSON, limit=100).collect()
    want = [(r[0], len((r[1] or "").encode()), len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows()]
    assert sorted(str((r.doc_id, r.n_bytes, r.n_tokens)) for r in got) == sorted(map(str, want))
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)
    assert token_counts.token_counts(table(spark, []), JSON).count() == 0


def test_special_string_across_two_texts_is_none():
    tables = token_counts.load(JSON) | {"classes": pretokens.classes()}
    import pyarrow as pa

    from recollect.llm import arrays

    data, bounds = next(arrays.pieces(pa.array(["a<|endo", "ftext|>", "<|endoftext|>"])))
    tokenizer = Tokenizer.from_file(JSON)
    alone = pa.array(tables["alone"], pa.large_binary())
    want = [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in ("a<|endo", "ftext|>", "<|endoftext|>")]
    assert token_counts._counts(data, bounds, tables, alone).tolist() == want


def test_shortcut_strings_are_proved():
    tables = token_counts.load(JSON)
    assert all(token_counts.count_merged(t, tables["pairs"]) == 1 for t in random.Random(1).sample(tables["alone"], 300))


def test_best_fit_is_the_plain_algorithm():
    rng = random.Random(4)
    for _ in range(200):
        length = rng.randint(1, 40)
        sizes = np.array([rng.randint(1, length) for _ in range(rng.randint(0, 60))], np.int64)
        packed = packing.best_fit(sizes, length)
        assert sorted(i for row in packed for i in row) == list(range(len(sizes)))
        assert all(sizes[row].sum() <= length for row in packed)
        room = []
        for item in np.argsort(-sizes, kind="stable"):
            fits = [(r, k) for k, r in enumerate(room) if r >= sizes[item]]
            if fits:
                room[min(fits)[1]] -= sizes[item]
            else:
                room.append(length - sizes[item])
        assert len(room) == len(packed)


@pytest.mark.parametrize("block", [10**9, 50])
def test_packing_loses_nothing(spark, block):
    rng = random.Random(6)
    data = [(k, [rng.randrange(50_000) for _ in range(rng.choice([0, 1, 5, 30, 200]))]) for k in range(80)]
    data += [(99, None), (None, [1, 2, 3])]
    docs = spark.createDataFrame([(a, b, "x") for a, b in data], "doc_id long, ids array<int>, row string")
    found = {}
    for r in packing.pack(docs, length=64, pad=7, block=block).collect():
        ids, places = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(places) == 64
        for name, start, a, b in zip(r.seq_ids, r.seq_starts, r.cu_seqlens, r.cu_seqlens[1:]):
            found[name, start] = ids[a:b].tolist()
            assert places[a:b].tolist() == list(range(b - a))
        assert set(ids[r.cu_seqlens[-1] :]) <= {7}
    whole = {}
    for (name, start), part in sorted(found.items(), key=lambda x: (x[0][0] is None, x[0])):
        assert len(whole.setdefault(name, [])) == start
        whole[name] += part
    assert whole == {k: v for k, v in data if v}
    assert packing.pack(docs.limit(0)).count() == 0


def test_library_ids_also_of_texts_that_the_library_gives_up_on(spark, library):
    blank = " " * 1_000_000 + "x"
    with pytest.raises(ValueError):
        library.encode_to_numpy(blank, disallowed_special=())
    docs = table(spark, [*rows(), (99, blank)])
    ids = {r.doc_id: list(r.ids) for r in packing.library_ids(docs, RANKS, public_tokenizers.PATTERN).select("doc_id", "ids").collect()}
    assert b"".join(library.decode_single_token_bytes(i) for i in ids[99]).decode() == blank
    assert all(ids[k] == library.encode_ordinary(t) for k, t in enumerate(ODD, 20))


def test_long_words_are_counted_as_the_short_way_does(monkeypatch):
    rng = random.Random(12)
    tables = token_counts.load(public_tokenizers.path("byte_bpe_50k.json"))
    words = ["".join(rng.choice("abcdeinorst") for _ in range(rng.randrange(1, 200))).encode() for _ in range(300)]
    words += [b"a" * n for n in (1, 2, 3, 17, 64, 255, 256, 257)] + ["語".encode() * 40]
    short = [token_counts.count_merged(w, tables["pairs"]) for w in words]
    assert short == [token_counts._count_long(w, tables["pairs"]) for w in words]


def test_a_megabyte_without_a_space_ends():
    import time

    rng = random.Random(13)
    tables = token_counts.load(public_tokenizers.path("byte_bpe_50k.json"))
    word, began = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000)), time.time()
    assert token_counts.count_merged(word.encode(), tables["pairs"]) > 300_000
    assert time.time() - began < 60


@pytest.mark.parametrize("bad", [65_536, 70_000, -1])
def test_ids_beyond_16_bits_are_refused(spark, bad):
    docs = spark.createDataFrame([(1, [1, 65_535]), (2, [3, bad])], "doc_id long, ids array<int>")
    assert packing.pack(docs.filter("doc_id = 1"), length=8).count() == 1
    with pytest.raises(Exception, match="16 bits"):
        packing.pack(docs, length=8).collect()
