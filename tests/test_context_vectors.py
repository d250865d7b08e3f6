"""Vectors from the company of words, against plain counting, and on texts without a shared word."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import count

import numpy as np
import pytest

from recollect.operators import context_vectors as cv
from recollect.sources import scratch

DIMS = 24

TALK = [
    "my favourite language is python", "my favourite language is rust", "I prefer coding in python", "I prefer coding in rust",
    "coding python tools", "language python tools", "coding rust tools", "language rust tools", "prefer python tools", "favourite python tools",
    "every morning coffee and running", "every morning tea and running", "breakfast coffee then walking", "breakfast tea then walking",
    "morning coffee cup", "breakfast coffee cup", "morning tea cup", "breakfast tea cup",
]


def words(text):
    return [w for w in re.sub(r"[^\w]+|_", " ", (text or "").lower()).split(" ") if w]


def brute(texts, dims=DIMS):
    df = Counter(w for t in texts for w in set(words(t)))
    weight = {w: math.floor(math.log2(len(texts) / n) * cv.WEIGHT + 0.5) for w, n in df.items()}
    context = defaultdict(Counter)
    for text in texts:
        own = words(text)
        for k, word in enumerate(own):
            for other in own[max(0, k - cv.WINDOW) : k] + own[k + 1 : k + 1 + cv.WINDOW]:
                if other != word and weight[other] > 0:
                    for j in range(cv.ENTRIES):
                        d = hashlib.md5(f"{other}:{j}".encode()).hexdigest()
                        context[word][int(d[:8], 16) % dims] += weight[other] * (1 if d[8] < "8" else -1)
    vectors = {}
    for word, x in context.items():
        top = max(map(abs, x.values()))
        if top and weight[word] > 0:
            vectors[word] = {d: v * cv.STEPS // top for d, v in x.items()}
    out = []
    for text in texts:
        if text is None:
            out.append(None)
            continue
        x = Counter()
        for word, tf in Counter(words(text)).items():
            for d, v in vectors.get(word, {}).items():
                x[d] += tf * weight[word] * v
        top = max(map(abs, x.values()), default=0) or 1
        out.append([x[d] / top for d in range(dims)])
    return out


def embedded(spark, texts, fit=None, dims=DIMS):
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    on = rows if fit is None else spark.createDataFrame([(t,) for t in fit], "text string")
    done = cv.embed_by_context(rows, cv.fit_words(on, dims), dims, "id").collect()
    return [r.embedding for r in sorted(done, key=lambda r: r.id)]


@pytest.mark.parametrize("few", [200_000, 0])
def test_equals_plain_counting(spark, monkeypatch, few):
    monkeypatch.setattr(cv, "BROADCAST_WORDS", few)
    texts = [*TALK, None, "", "!!", "once", "tea tea tea coffee tea", "Été à l'été", *TALK[:3]]
    for got, want in zip(embedded(spark, texts), brute(texts)):
        assert got is None if want is None else got == pytest.approx(want, abs=1e-6)


def test_related_texts_without_a_shared_word(spark):
    memories = ["favourite language", "breakfast tea"]
    asked = ["prefer coding", "morning coffee"]
    a, b, p, q = embedded(spark, [*memories, *asked], TALK, dims=256)
    assert not set(words(memories[0])) & set(words(asked[0]))

    def cosine(x, y):
        return sum(i * j for i, j in zip(x, y)) / math.sqrt(sum(i * i for i in x) * sum(j * j for j in y))

    assert cosine(p, a) > cosine(p, b) + 0.1 and cosine(q, b) > cosine(q, a) + 0.1


def test_unknown_words_and_empty_tables(spark):
    assert embedded(spark, ["nothing known", None], TALK) == [[0.0] * DIMS, None]
    assert embedded(spark, ["a b"], []) == [[0.0] * DIMS]
    assert embedded(spark, [], TALK) == []


@pytest.mark.parametrize("block", [1, 70])
def test_texts_in_many_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(cv, "BLOCK", block)
    texts = [*TALK, None, "", "tea tea tea coffee tea", *TALK[:3]]
    for got, want in zip(embedded(spark, texts), brute(texts)):
        assert got is None if want is None else got == pytest.approx(want, abs=1e-6)


def test_rows_of_one_id_share_their_words(spark):
    rows = spark.createDataFrame([(1, "tea cup"), (1, "coffee"), (None, "tea"), (2, "tea cup coffee")], "id long, text string")
    fitted = cv.fit_words(spark.createDataFrame([(t,) for t in TALK], "text string"), DIMS)
    got = [(r.id, r.embedding) for r in cv.embed_by_context(rows, fitted, DIMS, "id").collect()]
    both = dict(got)
    assert [v for k, v in got if k == 1] == [both[2]] * 2 and both[None] == [0.0] * DIMS and any(both[2])


def test_packed_rows_of_any_size():
    rows = np.array([[0, 0, 0], [1, -1, 0], [32768, 0, -32768], [32769, 0, 1], [0, -32769, 0], [2**31, -(2**31), 5], [2**31 + 1, 0, 0], [0, 0, -(2**50)], [0, 2**50, 7]], np.int64)
    some = np.array([8, 1, 2, 3, 4, 5, 6, 7, 0])
    for dims in (3, 8, 9):
        wide = np.pad(rows, ((0, 0), (0, dims - 3)))
        cells = cv._packed(wide, some)
        assert (cv._vectors(cells, dims) == wide[some]).all() and (cv._vectors(cells.slice(2, 3), dims) == wide[some[2:5]]).all()
        assert len(cv._vectors(cv._packed(wide, some[:0]), dims)) == 0
    assert len(cells[0].as_py()) == 1 + 2 + 2 * 8 and len(cells[1].as_py()) == 1 + 2 + 2 * 2


def test_lots_and_used_up_tables_are_deleted(spark, monkeypatch, tmp_path):
    """Shuffles and tables of the first pass were on disk until the second had ended: ten times the input."""
    for name, value in (("BLOCK", 70), ("LOTS", 3), ("LEAST", 2), ("PLACES", 4)):
        monkeypatch.setattr(cv, name, value)
    number = count()
    monkeypatch.setattr(scratch, "scratch_path", lambda spark, name: f"{tmp_path}/{name}-{next(number)}")
    before = spark.conf.get(scratch.CLEANUP, None)
    texts = [*TALK, None, "", "tea tea tea coffee tea", *TALK[:3]]
    done = embedded(spark, texts)
    assert {path.name.split("-")[0] for path in tmp_path.iterdir()} == {"words", "vectors"}
    assert spark.conf.get(scratch.CLEANUP, None) == before
    for got, want in zip(done, brute(texts)):
        assert got is None if want is None else got == pytest.approx(want, abs=1e-6)
