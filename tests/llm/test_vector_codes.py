"""Vector codes against plain loops over Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from recollect.llm.vector_codes import SPLITS, Gnat, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, salt string"


def brute(rows):
    """The contract, one number at a time."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], hashlib.sha256(b"").hexdigest()
    size = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == size]
    cut = [(p * size // 4, (p + 1) * size // 4) for p in range(4)]
    ints = [[math.floor(1024 * x) for x in r[1]] for r in kept]
    parts = [[v[a:b] for a, b in cut] for v in ints]
    books = [[row[p] for row in parts[:256]] for p in range(4)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(4):
        for p in range(4):
            members = {}
            for row in parts:
                members.setdefault(near(row[p], books[p])[1], []).append(row[p])
            books[p] = [
                [sum(c) // len(members[k]) for c in zip(*members[k])] if k in members else e for k, e in enumerate(books[p])
            ]
    found = [[near(row[p], books[p]) for p in range(4)] for row in parts]
    sums = {}
    for r, f in zip(kept, found):
        sums[r[2]] = sums.get(r[2], 0) + sum(d for d, _ in f)
    out = [(r[0], "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), sums[r[2]]) for r, f in zip(kept, found)]
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def same(spark, rows):
    table = spark.createDataFrame([(*r, "c", "e", "s") for r in rows], SCHEMA).repartition(3)
    got = vector_codes(table).collect()
    want, digest = brute([(a, [float(np.float32(x)) if x is not None else None for x in v] if v is not None else None, c) for a, v, c in rows])
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r)[:4] for r in got), key=order) == sorted(want, key=order)
    assert {r.codebooks_sha256 for r in got} <= {digest}


def test_many_vectors_with_ties(spark):
    rng = random.Random(1)
    rows = [(k, [rng.randrange(-3, 4) / 1024 * 2 for _ in range(8)], rng.choice([1, 2, None])) for k in range(700)]
    same(spark, rows)


def test_clusters_and_negative_floors(spark):
    rng = random.Random(2)
    centres = [[rng.gauss(0, 3) for _ in range(16)] for _ in range(9)]
    rows = [(1000 - k, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)], k % 3) for k in range(600)]
    same(spark, rows)


def test_messy_rows(spark):
    rows = [
        (5, [1.0, 2.0, 3.0, 4.0], 1), (5, [1.0, 2.0, 3.0, 4.0], 1), (None, [0.5, -0.5, 0.25, 9.0], None), (7, None, 1),
        (8, [1.0, None, 3.0, 4.0], 1), (9, [float("nan"), 0.0, 0.0, 0.0], 2), (10, [float("inf"), 0.0, 0.0, 0.0], 2),
        (11, [1.0, 2.0], 1), (12, [], 1), (13, [3e38, -3e38, 1e-40, 0.0], 3), (14, [1.0, 2.5, 3.0, -4.0], None),
    ]
    table = spark.createDataFrame([(*r, "c", "e", "s") for r in rows], SCHEMA)
    got = {(r.vec_id, r.error) for r in vector_codes(table).collect()}
    assert got == {(5, 0), (None, 0), (13, 0), (14, 0)}
    same(spark, [r for r in rows if r[0] != 13])


def test_large_components_stay_exact(spark):
    rows = [(k, [float(k % 7) * 1e6, -float(k % 5) * 1e7, 0.0, 1.0], 1) for k in range(300)]
    same(spark, rows)
    huge = spark.createDataFrame([(k, [3e38 if k > 255 else 0.0, 0.0, 0.0, float(k)], 1, "", "", "") for k in range(257)], SCHEMA)
    assert vector_codes(huge).filter("error is null or label_error is null").count() in (0, 1)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vector_codes(empty).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert vector_codes(empty).count() == 0


def test_labels_joined_in_pieces(spark, monkeypatch):
    monkeypatch.setattr("recollect.llm.vector_codes.BROADCAST_LABELS", 0)
    rng = random.Random(4)
    same(spark, [(k, [rng.random() for _ in range(4)], rng.choice([None, 1, 1, 1, 2])) for k in range(300)])


@pytest.mark.parametrize("spread, size", [(1, 2), (2000, 16), (2**31, 3), (2**60, 2)])
def test_tree_is_exact_and_leaves_out_subtrees(spread, size):
    rng = np.random.default_rng(spread % 97)
    points = np.array([[int(v) for v in row] for row in rng.integers(-spread, spread + 1, (200, size))], object)
    points = points if spread >= 2**60 else points.astype(np.int64)
    queries = np.concatenate([points, points + 1, rng.integers(-spread, spread + 1, (200, size)).astype(points.dtype)])
    entry, best, measured = Gnat(points).nearest(queries)
    for q, e, b in zip(queries.tolist(), entry.tolist(), best.tolist()):
        assert (b, e) == min((sum((x - y) ** 2 for x, y in zip(q, p)), k) for k, p in enumerate(points.tolist()))
    if size == 2:
        assert measured < 0.6 * len(queries) * len(points)


def test_range_bounds_are_those_of_the_subtree():
    points = np.random.default_rng(5).integers(-50, 50, (256, 2))
    top = Gnat(points).top
    assert len(top.entries) == SPLITS

    def below(node):
        return [*node.entries, *(e for *_, child in node.children for e in below(child))]

    assert sorted(below(top)) == list(range(256))
    for low, high, child in top.children:
        for k, split in enumerate(top.entries):
            reach = [math.dist(points[split], points[e]) for e in below(child)]
            assert low[k] <= min(reach) and max(reach) <= high[k]


def test_sums_of_large_negative_components(spark):
    same(spark, [(k, [-1.0 - k % 3, -7.25, 2.0**28, -(2.0**29)], 1) for k in range(40)])
