"""Token counts without making the tokens.

It is proved beforehand which strings of the vocabulary come out of the merges as one
token. A pre-token that is such a string counts one; only the others are merged.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recollect.llm import arrays, pretokens

#: Counts of pre-tokens kept in a worker; a full cache is emptied and built anew.
KNOWN = 400_000
LIMIT = 512
#: Bytes of a pre-token above which merges are taken from a heap.
LONG = 256
_NEVER = 1 << 60


def _byte_of() -> dict[str, int]:
    """The byte that each character stands for in the vocabulary: printable bytes stand for
    themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    found = {chr(b): b for b in plain}
    hidden = [b for b in range(256) if b not in plain]
    return found | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def load(path: str) -> dict:
    """Merges, vocabulary and special strings of a byte-level BPE file, as plain values."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    table = _byte_of()

    def raw(token: str) -> bytes:
        return bytes(table[c] for c in token)

    special = [t["content"] for t in spec["added_tokens"]]
    merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
    pairs = {(raw(a), raw(b)): rank for rank, (a, b) in enumerate(merges)}
    vocabulary = [raw(t) for t in spec["model"]["vocab"] if t not in special]
    return {
        "pairs": pairs,
        "alone": [t for t in vocabulary if count_merged(t, pairs) == 1],
        "special": [s.encode() for s in special],
        "known": {},
    }


def count_merged(text: bytes, pairs: dict) -> int:
    """How many tokens merging makes of one pre-token: lowest rank first, then leftmost."""
    if len(text) > LONG:
        return _count_long(text, pairs)
    parts = [text[i : i + 1] for i in range(len(text))]
    ranks = [pairs.get(p, _NEVER) for p in zip(parts, parts[1:])]
    while ranks:
        best = min(ranks)
        if best == _NEVER:
            break
        at = ranks.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del ranks[at]
        if at:
            ranks[at - 1] = pairs.get((parts[at - 1], parts[at]), _NEVER)
        if at < len(ranks):
            ranks[at] = pairs.get((parts[at], parts[at + 1]), _NEVER)
    return len(parts)


def _count_long(text: bytes, pairs: dict) -> int:
    """The same with a heap over a linked list, which long pre-tokens need: looking for the
    lowest rank anew after each merge grows with the square of the length."""
    size = len(text)
    parts: list[bytes | None] = [text[i : i + 1] for i in range(size)]
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap = [(rank, i, i + 1) for i in range(size - 1) if (rank := pairs.get((parts[i], parts[i + 1]))) is not None]
    heapq.heapify(heap)
    left = size
    while heap:
        rank, i, j = heapq.heappop(heap)
        # either side may have grown or gone since: then this is another pair, or none
        if parts[i] is None or after[i] != j or pairs.get((parts[i], parts[j])) != rank:
            continue
        parts[i], parts[j] = parts[i] + parts[j], None
        left -= 1
        after[i] = k = after[j]
        if k < size:
            before[k] = i
            if (rank := pairs.get((parts[i], parts[k]))) is not None:
                heapq.heappush(heap, (rank, i, k))
        h = before[i]
        if h >= 0 and (rank := pairs.get((parts[h], parts[i]))) is not None:
            heapq.heappush(heap, (rank, h, i))
    return left


def _cuts(data: np.ndarray, bounds: np.ndarray, special: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``bounds`` and the borders of special strings, sorted; where special strings start."""
    raw, found, at = data.tobytes(), [], 0
    while True:
        hits = [(p, -len(s)) for s in special if (p := raw.find(s, at)) >= 0]
        if not hits:
            break
        start, size = min(hits)
        end = start - size
        if np.searchsorted(bounds, start, "right") == np.searchsorted(bounds, end, "left"):
            found.append((start, end))
            at = end
        else:  # it only seems to stand here, across two texts
            at = start + 1
    if not found:
        return bounds, np.zeros(0, np.int64)
    return np.unique(np.concatenate([bounds, *map(np.array, found)])), np.array([f[0] for f in found])


def _counts(data: np.ndarray, bounds: np.ndarray, tables: dict, alone: pa.Array) -> np.ndarray:
    cuts, special = _cuts(data, bounds, tables["special"])
    starts = pretokens.split(data, cuts, tables["classes"])
    different, which = pretokens.distinct(data, starts)
    count = np.ones(len(different), np.int64)
    known, pairs = tables["known"], tables["pairs"]
    rest = np.flatnonzero(~pc.is_in(different, value_set=alone).to_numpy(zero_copy_only=False))
    for k, text in zip(rest.tolist(), different.take(pa.array(rest)).to_pylist()):
        n = known.get(text)
        if n is None:
            if len(known) > KNOWN:
                known.clear()
            n = known[text] = count_merged(text, pairs)
        count[k] = n
    made = count[which]
    if len(special):
        # the pre-tokens of a special string count nothing, but the first counts one
        place = cuts[np.searchsorted(cuts, starts, "right") - 1]
        inside = np.isin(place, special)
        made[inside] = (starts[inside] == place[inside]).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(made)])
    first = np.searchsorted(starts, bounds)
    return total[first[1:]] - total[first[:-1]]


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    ``n_tokens`` is what the byte-level BPE file at ``path`` (on the driver) makes of the
    whole text; a special string in a text is one token. Null is empty: no bytes, no
    tokens. Repeated rows are rows of their own; other columns are not looked at. Very long
    texts and words (a megabyte without a space) take time in proportion to ``n log n``.
    """
    tables = load(path)
    tables["classes"] = pretokens.classes()
    shared = docs.sparkSession.sparkContext.broadcast(tables)  # as large as the vocabulary

    @F.arrow_udf("long")
    def run(column: pa.Array) -> pa.Array:
        alone = pa.array(shared.value["alone"], pa.large_binary())
        parts = [_counts(*piece, shared.value, alone) for piece in arrays.pieces(column)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))

    content = F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))
    out = docs.select(docs[f"`{id_col}`"], F.octet_length(content).cast("long").alias("n_bytes"), run(content).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
