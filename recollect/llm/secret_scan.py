"""Secrets in texts: patterns of known forms, and strings that look random.

Each opaque string is tested against the alphabet of its encoding: chi-squared uniformity,
runs about the middle of the alphabet, and serial correlation. The combined p-value is
uniform for random strings and near 0 for others. For each encoding and class of length the
p-values of the whole corpus give the share of false alarms above a threshold, and
the least threshold that keeps this share under MAX_FALSE is applied; sparse classes are
judged together.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recollect.llm.store import stored

#: Accepted share of strings among the findings that are not random.
MAX_FALSE = 0.1
#: Bins of the p-value; thresholds are tried up to the middle, above which all is taken as random.
BINS = 20
#: Strings of a class from which its share of random ones can be told.
ENOUGH = 200
#: Least lengths of the classes; shorter strings leave the tests no power.
LENGTHS = (20, 24, 32, 48, 64, 128)

# Forms of secrets
_ASSIGN = r"""((?:(?ai:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]+"
_HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

_OPAQUE = r"[A-Za-z0-9+/_-]{20,}"
#: Pieces of an opaque run.
_PIECES = (r"[A-Za-z0-9_-]{20,}", r"[A-Za-z0-9+/]{20,}", r"[A-Za-z0-9]{20,}")
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Encodings, the narrowest first.
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "base32": _UPPER + "234567",
    "base32 lower": _LOWER + "234567",
    "base36": _DIGITS + _UPPER,
    "base36 lower": _DIGITS + _LOWER,
    "letters": _UPPER + _LOWER,
    "base62": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _uniformity(places: np.ndarray, size: int) -> float:
    """Upper tail of chi-squared by the cube-root normal approximation."""
    expected = len(places) / size
    chi = float(((np.bincount(places, minlength=size) - expected) ** 2).sum()) / expected
    spread = 2 / (9 * (size - 1))
    z = ((chi / (size - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread)
    return math.erfc(z / math.sqrt(2)) / 2


def _runs(places: np.ndarray, size: int) -> float:
    high = 2 * places >= size
    changes, n = int((high[1:] != high[:-1]).sum()), len(places)
    return _two_sided((changes - (n - 1) / 2) / math.sqrt((n - 1) / 4))


def _serial(places: np.ndarray) -> float:
    n, off = len(places), places - places.mean()
    var = float((off * off).sum())
    if not var:
        return 0.0
    r = float((off[1:] * off[:-1]).sum()) / var
    return _two_sided((r + 1 / n) * math.sqrt(n))


def randomness(text: str) -> tuple[str, float] | None:
    """The encoding of ``text`` and its combined p-value (Fisher), or None if it has none."""
    symbols = set(text)
    for name, alphabet in ALPHABETS.items():
        if symbols <= set(alphabet):
            table = np.zeros(128, np.int64)
            table[np.frombuffer(alphabet.encode(), np.uint8)] = np.arange(len(alphabet))
            places = table[np.frombuffer(text.encode(), np.uint8)]
            tests = (_uniformity(places, len(alphabet)), _runs(places, len(alphabet)), _serial(places))
            half = -sum(math.log(max(p, 1e-300)) for p in tests)
            return name, min(1.0, math.exp(-half) * (1 + half + half * half / 2))
    return None


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of the known forms, by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(_ASSIGN, text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(_ACCESS, text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(_HEX, text)]
    return sorted(found)


def _tested(text: str, at: int) -> list[tuple]:
    """``start, end, encoding, length class, p`` of an opaque run, or of its pieces.

    A run that fits no alphabet, or that is surely not random as a whole, may still hold a
    random piece, as a path or an address does: its pieces between ``/`` and ``+`` are
    tested, then those between ``-`` and ``_`` that overlap none of these.
    """
    whole = randomness(text)
    if whole is None or whole[1] < 1 / BINS:
        found: list[tuple] = []
        for pattern in _PIECES:
            for m in re.finditer(pattern, text):
                if len(m[0]) < len(text) and not any(a - at < m.end() and m.start() < b - at for a, b, *_ in found):
                    tested = randomness(m[0])
                    if tested and tested[1] >= 1 / BINS:
                        found.append((at + m.start(), at + m.end(), tested[0], _class(len(m[0])), tested[1]))
        if found:
            return sorted(found)
    return [] if whole is None else [(at, at + len(text), whole[0], _class(len(text)), whole[1])]


def _class(size: int) -> int:
    return max(x for x in LENGTHS if x <= size)


def opaque_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple]:
    """``start, end, encoding, length class, p`` of the strings that overlap no known form."""
    starts = [start for start, _, _ in base]
    reach = list(accumulate((end for _, _, end in base), max))  # how far the forms up to one go
    found = []
    for m in re.finditer(_OPAQUE, text):
        before = bisect_left(starts, m.end())
        if not before or reach[before - 1] <= m.start():
            found += _tested(m[0], m.start())
    return found


#: What a text must have for the patterns to be worth trying (a linear-time check).
_MAYBE = rf"(?i:password|passwd|secret|token|api_?key)|AKIA|{_OPAQUE}"

_FOUND = "struct<base:array<struct<start:int, kind:int, end:int>>, opaque:array<struct<start:int, end:int, encoding:string, size:int, p:double>>>"


def _scan(column: pa.Array) -> pa.Array:
    worth = pc.fill_null(pc.match_substring_regex(column, _MAYBE), False).to_pylist()
    base, opaque = [], []
    for k, flag in enumerate(worth):
        text = column[k].as_py() if flag else ""
        spans = base_spans(text) if flag else []
        base.append([{"start": a, "kind": kind, "end": b} for a, kind, b in spans])
        names = ("start", "end", "encoding", "size", "p")
        opaque.append([dict(zip(names, span)) for span in opaque_spans(text, spans)] if flag else [])
    base_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    opaque_type = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("encoding", pa.string()), ("size", pa.int32()), ("p", pa.float64())])
    )
    return pa.StructArray.from_arrays([pa.array(base, base_type), pa.array(opaque, opaque_type)], ["base", "opaque"])


def thresholds(counts: list[int]) -> int | None:
    """The least bin from which on at most MAX_FALSE of the strings are not random.

    ``counts`` are the strings by bin of the p-value. Random ones fill all bins alike, and
    as many as half of them lie in the upper half, where hardly any others do. One more
    than expected counts as not random, so that few strings prove nothing.
    """
    half = BINS // 2
    random = sum(counts[half:]) / 0.5
    for first in range(half + 1):
        above = sum(counts[first:])
        if above and (max(above - random * (BINS - first) / BINS, 0) + 1) / above <= MAX_FALSE:
            return first
    return None


def limits(table: dict[tuple[str, int], list[int]]) -> dict[tuple[str, int], int]:
    """The first accepted bin of each class. A class of fewer than ENOUGH strings is judged
    with all lengths of its encoding, or else with all strings; where even these are few, by
    the fixed level of one bin."""
    found = {}
    for (encoding, size), own in table.items():
        wider = [own, _pooled(c for (e, _), c in table.items() if e == encoding), _pooled(table.values())]
        enough = [counts for counts in wider if sum(counts) >= ENOUGH]
        first = thresholds(enough[0]) if enough else 1
        if first is not None:
            found[encoding, size] = max(first, 1)
    return found


def _pooled(counts) -> list[int]:
    return [sum(column) for column in zip(*counts)]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` for every row of ``docs``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind,
    comma-joined; ``base_sha256`` is the digest of those of the known forms. Null and empty
    texts have none; very long texts and strings are scanned whole, in linear time. Repeated rows are rows of their own; other columns are not looked at.
    """
    content = F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))
    own = F.struct(docs[f"`{id_col}`"]).alias("doc")
    rows = stored(docs.select(own, F.arrow_udf(_scan, _FOUND)(content).alias("f")).select("doc", "f.*"), "secrets")
    bin_of = F.least(F.floor(F.col("o.p") * BINS), F.lit(BINS - 1)).cast("int")
    counts = rows.select(F.explode("opaque").alias("o")).groupBy("o.encoding", "o.size", bin_of.alias("bin")).count()
    # encodings x classes x bins: some hundred rows whatever the corpus
    table: dict[tuple[str, int], list[int]] = {}
    for encoding, size, b, n in counts.collect():
        table.setdefault((encoding, size), [0] * BINS)[b] = n
    cells = [x for (e, s), first in limits(table).items() for x in (F.lit(f"{e}:{s}"), F.lit(first / BINS))]
    limit = F.create_map(*cells) if cells else None

    def is_secret(o):
        if limit is None:
            return F.lit(False)
        return F.coalesce(o.p >= limit[F.concat(o.encoding, F.lit(":"), o.size.cast("string"))], F.lit(False))

    added = F.transform(
        F.filter("opaque", is_secret), lambda o: F.struct(o.start.alias("start"), F.lit(KINDS.index("random")).alias("kind"), o.end.alias("end"))
    )
    names = F.array(*map(F.lit, KINDS))

    def joined(spans):
        named = F.transform(spans, lambda s: F.concat_ws(":", names[s.kind], s.start.cast("string"), s.end.cast("string")))
        return F.array_join(named, ",")

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s.kind == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return rows.select(
        F.col("doc")[id_col].alias(id_col), number("assign"), number("access"), number("hex"),
        F.size(added).cast("long").alias("n_random"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", added))).alias("spans"),
    )
