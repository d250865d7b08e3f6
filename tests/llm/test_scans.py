import hashlib
import random
import re

import pytest

from recollect.llm import decontaminate, host_rules, licence_scan, secret_scan
from recollect.llm.licences import NOTICES, PHRASES

from .corpus import messy, prose, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


# secrets


def plain_spans(text):
    kinds = [
        (r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 1),
        (r"AKIA[A-Z0-9]+", 20, 0), (r"[0-9a-f]+", 24, 0),
    ]
    found = [(m.start(), k, m.end()) for k, (p, n, g) in enumerate(kinds) for m in re.finditer(p, text) if len(m[g]) >= n]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))


def secret_rows():
    rng = random.Random(8)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rows = []
    for k in range(120):
        bits = [
            f"password = '{rng.randrange(10**9)}'", "api_key: abcde", "TOKEN=abcdef", "toKen : x", "AKIA" + "A1B2" * 4, "AKIA123",
            f"{rng.randrange(16**40):040x}", "".join(rng.choice(b64) for _ in range(40)), "a" * 30, "the-quick-brown-fox-jumps",
            "internationalizationandlocalization", "é\U0001F600", "secretſ=abcdefg", "paſſword=abcdefgh",
        ]
        rows.append((k, " ".join(rng.choice([prose(rng, 3), rng.choice(bits)]) for _ in range(12))))
    return rows + [(900 + k, r[1]) for k, r in enumerate(messy())]


def test_known_forms(spark):
    rows = secret_rows()
    got = {r.doc_id: r for r in secret_scan.find_secrets(table(spark, rows)).collect()}
    for key, text in rows:
        want = plain_spans(text or "")
        assert got[key].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [s for s in got[key].spans.split(",") if s and not s.startswith("random")] == [s for s in want.split(",") if s]
        assert got[key].n_assign == want.count("assign") and got[key].n_hex == want.count("hex")
    assert secret_scan.find_secrets(table(spark, [])).count() == 0
    assert secret_scan.find_secrets(table(spark, [(1, None)])).first().spans == ""


def test_random_strings_are_found_and_words_are_not(spark):
    rows = secret_rows()
    found = [
        dict(rows)[r.doc_id][int(a) : int(b)]
        for r in secret_scan.find_secrets(table(spark, rows)).collect() for s in r.spans.split(",") if s.startswith("random")
        for _, a, b in [s.split(":")]
    ]
    truly = [w for _, t in rows for w in (t or "").split(" ") if re.fullmatch(r"[A-Za-z0-9+/]{40}", w) and not re.fullmatch("[0-9a-f]+", w)]
    assert len(found) >= 0.8 * len(truly) > 10  # the threshold leaves out the least uniform
    assert not set(found) & {"a" * 30, "the-quick-brown-fox-jumps", "internationalizationandlocalization"}


def test_tokens_of_lower_case_letters_and_in_paths_are_found(spark):
    rng = random.Random(21)
    low, url = ("".join(a) for a in (secret_scan.ALPHABETS["base36 lower"], secret_scan.ALPHABETS["base64url"]))
    rows, want = [], {}
    for k in range(300):
        token = "".join(rng.choice(low) for _ in range(rng.choice([24, 32, 40, 64])))
        path = "".join(rng.choice(url) for _ in range(40))
        text = f"{prose(rng, 5)} key {token} or https://example.com/reset-password/{path}/a+b {prose(rng, 5)}"
        rows.append((k, text))
        want[k] = {token, path}
    found = {k: set() for k in want}
    for r in secret_scan.find_secrets(table(spark, rows)).collect():
        for s in filter(None, r.spans.split(",")):
            kind, a, b = s.split(":")
            found[r.doc_id].add(rows[r.doc_id][1][int(a) : int(b)])
    assert sum(len(found[k] & want[k]) for k in want) >= 0.85 * 600
    assert not any(f - want[k] for k, f in found.items() if any(len(x) < 20 for x in f))


def test_a_few_strings_that_are_not_random_stay_unreported(spark):
    rows = [(1, "a" * 130), (2, "internationalizationandlocalization " + "b" * 64), (3, "-" * 80), (4, "0123456789" * 5)]
    assert {r.n_random for r in secret_scan.find_secrets(table(spark, rows)).collect()} == {0}
    rng = random.Random(5)
    alone = "".join(rng.choice(secret_scan.ALPHABETS["base62"]) for _ in range(48))
    assert [r.n_random for r in secret_scan.find_secrets(table(spark, [(1, alone)])).collect()] == [1]


def test_thresholds_by_class_and_pooled():
    even, low = [50] * secret_scan.BINS, [900] + [0] * (secret_scan.BINS - 1)
    assert secret_scan.thresholds(even) == 0 and secret_scan.thresholds(low) is None
    mixed = [a + b for a, b in zip(even, low)]
    assert secret_scan.thresholds(mixed) == 1
    few = [1] + [0] * (secret_scan.BINS - 1)
    assert secret_scan.thresholds(few) is None
    found = secret_scan.limits({("hex", 32): mixed, ("hex", 64): few, ("base64", 20): few})
    assert found == {("hex", 32): 1, ("hex", 64): 1, ("base64", 20): 1}
    assert secret_scan.limits({("hex", 32): low, ("base64", 20): few}) == {}
    assert secret_scan.limits({("hex", 32): few}) == {("hex", 32): 1}


def test_many_digests_and_a_long_string_take_linear_time():
    import time

    rng = random.Random(3)
    text = " ".join(f"{rng.randrange(16**40):040x} x{rng.randrange(10**30)}y" for _ in range(40_000)) + " " + "Ab1" * 2_000_000
    began = time.time()
    base = secret_scan.base_spans(text)
    assert len(base) >= 40_000 and secret_scan.opaque_spans(text, base)
    assert time.time() - began < 20


def test_opaque_spans_overlap_no_known_form():
    rng = random.Random(30)
    for _ in range(300):
        text = " ".join(rng.choice(["token=" + "x" * 30, "f" * 24 + "Z" * 9, "AKIA" + "Q1" * 12, "q" * 25, "secret: " + "0a" * 20]) for _ in range(8))
        base = secret_scan.base_spans(text)
        want = [m.span() for m in re.finditer(secret_scan._OPAQUE, text) if not any(a < m.end() and m.start() < b for a, _, b in base)]
        assert [s[:2] for s in secret_scan.opaque_spans(text, base)] == want


@pytest.mark.parametrize("alphabet", sorted(secret_scan.ALPHABETS))
def test_p_values_of_random_strings_are_uniform(alphabet):
    rng = random.Random(9)
    for alphabet in (secret_scan.ALPHABETS[alphabet],):
        p = [secret_scan.randomness("".join(rng.choice(alphabet) for _ in range(64)))[1] for _ in range(1500)]
        assert 0.02 < sum(x < 0.05 for x in p) / 1500 < 0.09 and 0.4 < sum(x < 0.5 for x in p) / 1500 < 0.6


# licences


def licence_rows():
    rng = random.Random(10)
    notes = [f"{prose(rng, 20)}\n# {text.upper() if k % 2 else text}\n{prose(rng, 9)}" for k, (_, text, _) in enumerate(NOTICES)]
    notes += ["Mit license MIT-License", "cc by cc by", "gnu general public", "permission to use", "apache  license"]
    return [(k, t) for k, t in enumerate(notes)] + [(900 + k, r[1]) for k, r in enumerate(messy())]


def test_phrases_and_notices(spark):
    rows = licence_rows()
    got = {r.doc_id: r for r in licence_scan.licence_report(table(spark, rows)).collect()}
    for key, text in rows:
        own = words(text)
        places = [(i, label) for phrase, label in PHRASES for i in range(len(own)) if own[i : i + len(phrase.split())] == phrase.split()]
        r = got[key]
        assert (r.n_words, r.n_base) == (len(own), len(places))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        base = {label for _, label in places}
        assert r.base_labels == ",".join(sorted(base)) and set(filter(None, r.labels.split(","))) >= base
        if key < len(NOTICES):
            assert NOTICES[key][0] in r.labels.split(",") and r.score == 1.0
        elif key >= 900:
            assert r.score == 0 and r.labels == ""
    assert licence_scan.licence_report(table(spark, [])).count() == 0


# benchmark passages


def test_windows_equal_brute_force(spark):
    rng = random.Random(12)
    items = [(k, prose(rng, n, 60)) for k, n in enumerate([3, 9, 10, 11, 40, 40, 1, 25])]
    items += [(50, None), (51, ""), (52, "?!"), (None, prose(rng, 12, 60)), (4, items[4][1]), (60, items[5][1])]
    docs = []
    for k in range(60):
        item = words(rng.choice(items)[1])
        a = rng.randrange(len(item) + 1)
        docs.append((k, f"{prose(rng, 15, 60)} {'. '.join(item[a : a + rng.choice([5, 10, 14, 40])]).title()} {prose(rng, 5, 60)}"))
    docs += [(900 + k, r[1]) for k, r in enumerate(messy())]
    wins = {}
    for name, text in items:
        own = words(text)
        for i in range(max(1, len(own) - 9)) if own else []:
            wins.setdefault(tuple(own[i : i + 10]), set()).add(name)
    benchmark = spark.createDataFrame([(a, b, "x") for a, b in items], "item_id long, text string, words string")
    got = {r.doc_id: r for r in decontaminate.contamination(table(spark, docs), benchmark).collect()}
    clean = set()
    for key, text in docs:
        own, hit, names = words(text), set(), set()
        for i in range(len(own)):
            for size in range(1, 11):
                if (win := tuple(own[i : i + size])) in wins and len(win) == size:
                    hit |= set(range(i, i + size))
                    names |= {str(x) for x in wins[win] if x is not None}
        r = got[key]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(own), len(hit), len(names), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        clean |= {key} if not hit else set()
    assert 0 < len(clean) < len(docs)
    kept = decontaminate.drop_contaminated(table(spark, docs), benchmark)
    assert kept.columns == table(spark, []).columns and {r.doc_id for r in kept.collect()} == clean


@pytest.mark.parametrize("docs, items", [([], [(1, "a b")]), ([(1, "a b")], []), ([], [])])
def test_empty_tables(spark, docs, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(table(spark, docs), benchmark).collect()
    assert len(got) == len(docs) and not any(r.contaminated for r in got)


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    benchmark = spark.createDataFrame([(1, "w1e w2i w3o")], "item_id long, text string")
    docs = table(spark, [(k, "a w1e w2i w3o b" if k % 3 else "w1e w3o") for k in range(30)])
    want = sorted(map(tuple, decontaminate.contamination(docs, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    assert sorted(map(tuple, decontaminate.contamination(docs, benchmark).collect())) == want


def test_words_are_not_shuffled(spark, monkeypatch, capsys):
    """Places of a window's rarest word are checked in the row that has the words."""
    real, plans = decontaminate.stored, {}

    def watched(df, name):
        capsys.readouterr()
        df.explain()
        plans[name] = capsys.readouterr().out
        return real(df, name)

    monkeypatch.setattr(decontaminate, "stored", watched)
    benchmark = spark.createDataFrame([(1, "w1e w2i w3o")], "item_id long, text string")
    docs = table(spark, [(k, "a w1e w2i w3o b" if k % 3 else "w1e w3o") for k in range(30)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        kept = decontaminate.drop_contaminated(docs, benchmark)
        capsys.readouterr()
        kept.explain()
        plans["kept"] = capsys.readouterr().out
        assert {r.doc_id for r in kept.collect()} == set(range(0, 30, 3))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning" not in plans["occurrences"] + plans["kept"]


# quality rules


def counts(text):
    text = text or ""
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = [tuple(own[i : i + 8]) for i in range(len(own) - 7)]
    twice = {i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(8)} if len(wins) < 3000 else set()
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(twice)


def test_rule_counts_equal_brute_force(spark):
    rng = random.Random(13)
    rows = messy() + [(20, "a b c d e f g h " * 9), (21, "x|y <b> #1 *$%&\n" * 3 + prose(rng, 30)), (22, "a b c d e f g h i a b c d e f g h")]
    rows += [(30 + k, " ".join(rng.choice("ab") for _ in range(60))) for k in range(20)]
    got = host_rules.assess(table(spark, rows)).collect()
    assert sorted(str((r.doc_id, *[r[c] for c in host_rules._COUNTS])) for r in got) == sorted(str((r[0], *counts(r[1]))) for r in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)


def test_hosts_that_mostly_fail_take_their_documents_along(spark):
    rng = random.Random(14)
    rows = [(k, prose(rng, 40) if k % 10 == 0 else "junk", "bad") for k in range(200)]
    rows += [(1000 + k, prose(rng, 40) if k % 10 else "junk", f"good{k % 7}") for k in range(400)]
    rows += [(3000, prose(rng, 40), None), (3001, "junk", "once"), (3002, prose(rng, 40), "once")]
    docs = table(spark, rows)
    got = {r.doc_id: r for r in host_rules.assess(docs).collect()}
    assert not any(got[k].kept for k in range(200))
    assert all(got[k].kept == (not got[k].base_failed) for k in got if k >= 1000)
    assert got[3000].host_rate is None and 0.05 < got[3002].host_rate < 0.5
    kept = host_rules.drop_failing(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.kept}


def test_rules_on_an_empty_table(spark):
    assert host_rules.assess(table(spark, [])).count() == 0
    assert host_rules.drop_failing(table(spark, [])).count() == 0
