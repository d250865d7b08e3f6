"""Token alignment against a walk over both sides; packing against the library and lower bounds."""

import random
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from recollect.llm import gap_packing, token_alignment
from recollect.llm.chunks import Chunks, byte_level_encoder, word_encoder, word_split
from tests.llm.corpus import SCHEMA, messy, prose, table

BYTE, PIECE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))
A, C = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECE)
BYTES_A, BYTES_B = token_alignment.byte_level_bytes(A), token_alignment.piece_bytes(B)

ODD = [
    "a b", "a  b", " a", "a ", "  ", "\n a\n  b \t c", "a\n b", "don't stop 'til", "a  b", "é è", "日本 語", "1 2 ３", "a▁ b", "▁", "x  y",
    "<|endoftext|> and <|startoftext|>", "</s> <s> <0x41>", "\x00 nul", "é a", " ́", "ΑΣ ΑΣ.", "İ I", "ﬁ ﬂ", "﻿ a", "\U0001f600 \U0001f468‍\U0001f469",
    "a" * 5000, "ab " * 3000, " " * 300 + "x", "_ _ . , -- a", "a\x1c b", "a\x85 b", "\r\n x \r\n",
]


def walk(text):
    """Ids of both sides, groups and links, by moving along both token lists."""
    whole = (" " + text).encode()
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    if not text or b"".join(BYTES_A[i] for i in a) != whole or b"".join(BYTES_B[i] for i in b) != whole:
        return [], [], [], []
    links, groups, i, j = [], [([], [])], 0, 0
    end_a = end_b = -1
    while i < len(a) or j < len(b) or end_a != end_b:
        if end_a == end_b:
            if end_a >= 0:
                groups.append(([], []))
            end_a, end_b = max(end_a, 0) + len(BYTES_A[a[i]]), max(end_b, 0) + len(BYTES_B[b[j]])
            groups[-1][0].append(a[i]), groups[-1][1].append(b[j])
            i, j = i + 1, j + 1
        elif end_a < end_b:
            end_a += len(BYTES_A[a[i]])
            groups[-1][0].append(a[i])
            i += 1
        else:
            end_b += len(BYTES_B[b[j]])
            groups[-1][1].append(b[j])
            j += 1
        links.append((a[i - 1], b[j - 1]))
    return a, b, groups, links


def written(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def aligned(spark, rows, **options):
    found = token_alignment.align_tokens(table(spark, rows), BYTE, PIECE, **options).collect()
    walked = [(r[0], *walk(r[1] or "")) for r in rows]
    count = Counter(link for *_, links in walked for link in links)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    want = [
        (doc, len(a), len(b), len(groups), len(links), written(groups), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links))
        for doc, a, b, groups, links in walked
    ]
    order = lambda r: tuple((x is None, x) for x in r)
    return sorted((tuple(r) for r in found), key=order), sorted(want, key=order)


def test_alignment_of_messy_and_odd_texts(spark):
    got, want = aligned(spark, messy() + [(100 + k, text) for k, text in enumerate(ODD)])
    assert got == want
    assert sum(not r[5] for r in want) > 4  # some cannot be given back


def test_alignment_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK", 200)
    monkeypatch.setattr(token_alignment, "SIZE", 400)
    rng = random.Random(2)
    got, want = aligned(spark, [(k, prose(rng, rng.randrange(0, 60))) for k in range(80)] + [(99, "tie ties"), (98, "tied tie")])
    assert got == want


def test_digest_and_empty_table(spark):
    rows = [(1, "some text, some text"), (2, None)]
    found = {r.doc_id: r.groups_sha256 for r in token_alignment.align_tokens(table(spark, rows), BYTE, PIECE, written=False).collect()}
    assert found == {1: sha256(written(walk(rows[0][1])[2]).encode()).hexdigest(), 2: ""}
    empty = token_alignment.align_tokens(spark.createDataFrame([], SCHEMA), BYTE, PIECE)
    assert empty.count() == 0 and "groups" in empty.columns


SIZES = np.array([len(b) for b in BYTES_A])


def chunked(texts):
    """Ids by chunks against those of whole texts, for the three vocabularies."""
    both = Chunks(byte_level_encoder(A, SIZES), lambda t: B.encode(t))
    numbers, first, _ = both.numbers(texts)
    words = Chunks(word_encoder(C), split=word_split)
    found = [both.ids(k, numbers, first) for k in (0, 1)]
    numbers, first, _ = words.numbers(texts)
    found.append(words.ids(0, numbers, first))
    want = [
        [e.ids for e in A.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)], B.encode(texts),
        [e.ids for e in C.encode_batch_fast(texts, add_special_tokens=False)],
    ]
    for k, ((ids, ends), wholes) in enumerate(zip(found, want)):
        for text, x, y, whole in zip(texts, ends, ends[1:], wholes):
            if k != 1 or "▁" not in text:
                assert ids[x:y].tolist() == whole, (k, text)


def test_chunks_give_the_ids_of_whole_texts():
    rng = random.Random(5)
    glyphs = [*"aB1.,'-_ \n\t", " ", " ", "  ", "é", "ß", "語", " ", "́", "​", "\U0001f600", "'s", "<|endoftext|>", "<|ENDOFTEXT|>", "　", "\x85", "İ", "Σ", "ᄒ", "ᅡ", "ᆫ", "²", "#", "*", "٣", "̸", "<", "क़", "שּׁ", "が", "か", "゙", ".", "."]
    chunked(ODD + ["".join(rng.choice(glyphs) for _ in range(rng.randrange(1, 40))) for _ in range(8000)])


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30).filter(lambda t: t and not any(0xD800 <= ord(c) < 0xE000 for c in t)))
def test_chunks_of_any_text(text):
    chunked([text, text + " " + text])


def test_chunks_start_anew(monkeypatch):
    monkeypatch.setattr("recollect.llm.chunks.KEPT_CHUNKS", 3)
    chunks = Chunks(word_encoder(C), split=word_split)
    for text in ("one two three four", "four five six seven", "one"):
        numbers, first, _ = chunks.numbers([text])
        assert chunks.ids(0, numbers, first)[0].tolist() == C.encode(text, add_special_tokens=False).ids


def pieces_of(spark, rows, **options):
    return gap_packing.pack_documents(table(spark, rows), WORD, **options).collect()


def test_packing_of_messy_texts(spark):
    rows = messy() + [(200 + k, text) for k, text in enumerate(ODD)]
    found = pieces_of(spark, rows)
    by_doc = {}
    for r in sorted(found, key=lambda r: r.start):
        by_doc.setdefault((r.doc_id, r.piece), []).append(r)
    want = Counter()
    for doc, text, *_ in rows:
        ids = C.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            want[doc, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in found) == want
    assert (None, 0) in by_doc
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for each in places.values():
        ends = np.cumsum([n for _, n in sorted(each)])
        assert [o for o, _ in sorted(each)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_packing_does_not_depend_on_the_deal(spark):
    rng = random.Random(8)
    rows = [(k, prose(rng, rng.choice([3, 40, 300, 300, 700]))) for k in range(150)]
    counts = set()
    for parts in (1, 7):
        packed = gap_packing.pack_documents(table(spark, rows, parts), WORD)
        counts.add((packed.count(), packed.select("sequence_id").distinct().count()))
    assert len(counts) == 1
    whole = gap_packing.sequences(packed).collect()
    for r in whole:
        assert len(r.input_ids) == 4 * r.cu_seqlens[-1] and len(r.doc_ids) == len(r.cu_seqlens) - 1
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens == sorted(r.cu_seqlens)


def test_ranks_joined_by_shuffle_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(gap_packing, "BROADCAST_PARTS", 0)
    assert len(pieces_of(spark, [(k, "a b c") for k in range(50)])) == 50
    assert gap_packing.pack_documents(spark.createDataFrame([], SCHEMA), WORD).count() == 0


def spread(counts, capacity):
    rows, made = gap_packing.plan(counts, capacity)
    bins = [[] for _ in range(made)]
    for size, _, n, sequence, each, offset in rows.tolist():
        for k in range(n):
            bins[sequence + k // each].append((offset + k % each * size, size))
    return bins


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 30), st.data())
def test_plan_places_each_piece_once(capacity, data):
    counts = data.draw(st.dictionaries(st.integers(1, capacity), st.integers(0, 40), max_size=10))
    bins = spread(counts, capacity)
    assert Counter(s for b in bins for _, s in b) == Counter({s: n for s, n in counts.items() if n})
    for each in bins:
        ends = np.cumsum([s for _, s in sorted(each)])
        assert [o for o, _ in sorted(each)] == [0, *ends[:-1]] and ends[-1] <= capacity
        assert sum(3 * s > capacity for _, s in each) <= 2


def most_pairs(items, capacity):
    """The largest number of pairs that fit, by trying all."""
    if len(items) < 2:
        return 0
    first, rest = items[0], items[1:]
    best = most_pairs(rest, capacity)
    for k, other in enumerate(rest):
        if first + other <= capacity:
            best = max(best, 1 + most_pairs(rest[:k] + rest[k + 1 :], capacity))
    return best


def test_large_pieces_make_as_many_pairs_as_can_be():
    rng = random.Random(4)
    for _ in range(200):
        items = [rng.randrange(11, 31) for _ in range(rng.randrange(1, 8))]
        assert len(spread(Counter(items), 30)) == len(items) - most_pairs(items, 30)


def test_few_sequences():
    rng = random.Random(6)
    items = [min(2048, max(1, int(rng.lognormvariate(5.5, 1.3)))) for _ in range(20_000)]
    assert len(spread(Counter(items), 2048)) <= 1.002 * sum(items) / 2048 + 1


def test_plan_size_depends_on_lengths_alone():
    counts = {n: 1 + n * 7919 % 13 for n in range(1, 2049)}
    small, _ = gap_packing.plan(counts, 2048)
    large, _ = gap_packing.plan({n: c * 100_000 for n, c in counts.items()}, 2048)
    assert len(large) < 3 * len(small) + 100


@pytest.mark.parametrize("capacity", [1, 2, 7])
def test_small_capacities(spark, capacity):
    rows = [(1, "one two three four five six seven"), (2, "one"), (3, None)]
    found = pieces_of(spark, rows, capacity=capacity)
    assert max(r.length for r in found) <= capacity and sum(r.length for r in found) == 8 + 2 + 1
