import random

import pytest

from recollect.llm import line_dedup, near_dup, store

from .corpus import messy, near, prose, table


def shingles(line):
    if len(line) < line_dedup.WIDTH:
        return {line}
    return {line[i : i + line_dedup.WIDTH] for i in range(len(line) - line_dedup.WIDTH + 1)}


def brute(rows):
    """Components of the lines that take part: lists of (id, row, place)."""
    lines = [
        (r[0] is None, r[0] or 0, k, p, line)
        for k, r in enumerate(rows) for p, line in enumerate((r[1] or "").split("\n"))
        if line.strip(" \t\n\x0b\x0c\r")
    ]
    root = list(range(len(lines)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    sets = [shingles(x[4]) for x in lines]
    for a in range(len(lines)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if lines[a][4] == lines[b][4] or 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[max(find(a), find(b))] = min(find(a), find(b))
    groups = {}
    for k, line in enumerate(lines):
        groups.setdefault(find(k), []).append(line)
    return groups


def rows():
    rng = random.Random(11)
    lines = [prose(rng, rng.randint(6, 60)) for _ in range(40)]
    found = []
    for k in range(60):
        own = [near(rng, rng.choice(lines), rng.choice([0, 0, 1])) for _ in range(rng.randint(1, 4))]
        found.append((k, "\n".join([*own, "short", "", prose(rng, 30)])))
    return found


def test_one_line_of_each_component_stays(spark):
    data = rows()
    got = {r.doc_id: r for r in line_dedup.line_report(table(spark, data)).collect()}
    groups = brute(data)
    want = {r[0]: [] for r in data}
    for group in groups.values():
        for line in sorted(group)[1:]:
            want[line[1]].append(line[3])
    assert {k: r.dropped for k, r in got.items()} == {k: ",".join(map(str, sorted(v))) for k, v in want.items()}
    assert all(r.n_dropped == len(want[k]) for k, r in got.items())


def test_texts_lose_exactly_those_lines(spark):
    data = rows() + [(100, data_text) for data_text in [rows()[0][1]]]
    docs = table(spark, data)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns
    report = {r.doc_id: {int(x) for x in r.dropped.split(",") if x} for r in line_dedup.line_report(docs).collect()}
    want = {k: "\n".join(x for p, x in enumerate(t.split("\n")) if p not in report[k]) for k, t in data}
    assert {r.doc_id: r.text for r in out.collect()} == {k: t for k, t in want.items() if t.strip() or not report[k]}


def test_messy_and_empty_tables(spark):
    docs = table(spark, messy())
    got = line_dedup.line_report(docs).collect()
    assert len(got) == len(messy())
    groups = brute(messy())
    assert sum(r.n_dropped for r in got) == sum(len(g) - 1 for g in groups.values())
    assert {r.doc_id: r.n_dropped for r in got if r.doc_id in (1, 2, 3, 4, 10)} == {1: 0, 2: 1, 3: 1, 4: 0, 10: 3}
    kept = line_dedup.dedup_lines(docs)
    assert {r.doc_id for r in kept.collect()} >= {1, 4, 5, 6, 7, 8, 9, 10}
    assert [r.text for r in kept.collect() if r.doc_id in (4, None) and r.text is None] == [None, None]
    assert line_dedup.line_report(table(spark, [])).count() == 0
    assert line_dedup.dedup_lines(table(spark, [])).count() == 0


def test_short_lines_take_part(spark):
    """Chinese sentences and list marks too: equal ones of any length, similar ones of eight characters."""
    cjk = "今天天气很好我们去公园散步吧"
    data = [(1, f"{cjk}\n- a\nab"), (2, f"- a\n{cjk}"), (3, f"{cjk}！\nac"), (4, "abcdefgh\nabcdefg"), (5, "abcdefg\nabcdefgh\n \n\t")]
    got = {r.doc_id: (r.n_lines, r.dropped) for r in line_dedup.line_report(table(spark, data)).collect()}
    assert got == {1: (3, ""), 2: (2, "0,1"), 3: (2, "0"), 4: (2, ""), 5: (2, "0,1")}
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(table(spark, data)).collect()} == {
        1: data[0][1], 3: "ac", 4: data[3][1]
    }


def test_many_lines_in_one_text(spark):
    """Linear in the lines of a text."""
    data = [(1, "\n".join(f"line number {k % 30_000} of the text" for k in range(60_000))), (2, None)]
    got = {r.doc_id: r for r in line_dedup.line_report(table(spark, data)).collect()}
    assert got[1].n_lines == 60_000 and got[1].n_dropped >= 30_000


@pytest.mark.parametrize("cells", [10_000_000, 60])
@pytest.mark.parametrize("shorten", [line_dedup.dedup_lines, near_dup.drop_near_duplicates])
def test_texts_are_not_shuffled_for_what_goes(spark, monkeypatch, capsys, shorten, cells):
    """Nor are they when what goes is more than Spark broadcasts by itself, or than is broadcast at once."""
    docs = table(spark, rows() + [(200 + k, prose(random.Random(k % 20), 30)) for k in range(40)])
    want = sorted(map(str, shorten(docs).collect()))
    monkeypatch.setattr(store, "CELLS", cells)
    seen = []
    real = store.stored

    def watched(df, name):
        capsys.readouterr()
        df.explain()
        seen.append((name, capsys.readouterr().out))
        return real(df, name)

    monkeypatch.setattr(store, "stored", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = shorten(docs)
        capsys.readouterr()
        got.explain()
        plans = [capsys.readouterr().out] + [plan for name, plan in seen if name == "beside"]
        assert sorted(map(str, got.collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not any("hashpartitioning" in plan for plan in plans)
    assert (len(plans) > 2) == (cells < 100)
