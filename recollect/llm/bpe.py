"""Byte-level BPE as a lazily determinised transducer, and streaming UTF-8 decoding."""

from __future__ import annotations

import base64
import gc
import hashlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recollect.llm import arrays, pretokens

#: States and pre-tokens kept in a worker; a full cache is emptied and built anew.
STATES, KNOWN = 150_000, 500_000
#: Bytes of text split at once; splitting takes some thirty times as much memory.
PIECE = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def merged(text: bytes, ranks: dict[bytes, int], down_to: int = 1) -> list[bytes]:
    """The tokens of one pre-token by merging: always the adjacent pair of lowest rank, the
    leftmost first; stops early at ``down_to`` tokens."""
    parts = [text[i : i + 1] for i in range(len(text))]
    while len(parts) > down_to:
        best, where = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, where = rank, i
        if best is None:
            break
        parts[where : where + 2] = [parts[where] + parts[where + 1]]
    return parts


def reachable(ranks: dict[bytes, int]) -> set[bytes]:
    """The tokens that merging makes of their own bytes."""
    return {token for token in ranks if len(token) == 1 or len(merged(token, ranks)) == 1}


def _halves(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two tokens whose merge makes ``token``."""
    left, right = merged(token, ranks, down_to=2)
    return left, right


def compile_tables(ranks: dict[bytes, int]) -> dict:
    """What the transducer needs, as plain values: sent to each worker once."""
    tokens = reachable(ranks)
    return {
        "ranks": ranks,
        "tokens": tokens,
        "prefixes": {t[:k] for t in tokens for k in range(len(t))},
        "halves": {t: _halves(t, ranks) for t in tokens if len(t) > 1},
        "moves": {}, "numbers": {}, "states": [], "endings": {}, "agree": {}, "known": {}, "decimals": {},
    }


class Transducer:
    """Bytes in, tokens out.

    A tokenisation is the one BPE makes exactly if each two neighbours are what BPE makes
    of their bytes; so each prefix of the input has one last token. A state is the last
    token emitted, the bytes pending, and the size of the last token of each pending prefix. The tokens
    that all prefixes which may still grow have in common are emitted. States are made when
    they are first met and are numbered.
    """

    def __init__(self, tables: dict):
        self.tokens, self.prefixes, self.endings = tables["tokens"], tables["prefixes"], tables["endings"]
        self.ranks, self.halves, self.agree = tables["ranks"], tables["halves"], tables["agree"]
        self.moves, self.numbers, self.states = tables["moves"], tables["numbers"], tables["states"]
        if not self.states:
            self._number((b"", b"", "", b""))

    def _number(self, state: tuple) -> int:
        found = self.numbers.get(state)
        if found is None:
            found = self.numbers[state] = len(self.states)
            self.states.append(state)
        return found

    def _fits(self, left: bytes, right: bytes) -> bool:
        """Whether BPE leaves ``left`` and ``right`` apart.

        They are joined, if at all, by a merge across the border that comes before the merges
        which hide its parts; so the parts next to the border are taken back merge by
        merge, the latest first.
        """
        known = self.agree.get((left, right))
        if known is None:
            if len(self.agree) > STATES:
                self.agree.clear()
            known = self.agree[left, right] = self._apart(left, right)
        return known

    def _apart(self, a: bytes, b: bytes) -> bool:
        ranks, halves = self.ranks, self.halves
        limit = len(ranks) + 1
        while True:
            across = ranks.get(a + b)
            if across is not None and across < limit:
                return False
            a_rank = ranks[a] if len(a) > 1 else -1
            b_rank = ranks[b] if len(b) > 1 else -1
            if a_rank < 0 and b_rank < 0:
                return True
            if a_rank > b_rank:  # of equal ranks the left one is merged first
                limit, a = a_rank, halves[a][1]
            else:
                limit, b = b_rank + 1, halves[b][0]

    def _ending(self, tail: bytes) -> tuple:
        """Of the suffixes of ``tail``: the tokens, longest first; the longest that can still
        grow; the lengths of all that can."""
        if len(self.endings) > 2 * STATES:
            self.endings.clear()
        suffixes = [tail[k:] for k in range(len(tail) + 1)]
        found = [(len(s), s) for s in suffixes if s in self.tokens]
        grow = [s for s in suffixes if s in self.prefixes]
        self.endings[tail] = ending = (found, grow[0], [len(s) for s in grow])
        return ending

    def _step(self, state: tuple, byte: bytes) -> int | tuple[list[int], int]:
        """The number of the next state, with the ids emitted if there are any. A state is the
        token before, the bytes pending, the sizes of their last tokens (characters of a string,
        which takes least memory), and the longest suffix that can still grow."""
        left, pending, last, tail = state
        pending += byte
        end = len(pending)
        found, tail, grow = self.endings.get(tail + byte) or self._ending(tail + byte)
        for size, token in found:
            at = end - size
            before = pending[at - ord(last[at - 1]) : at] if at else left
            if not before or self._fits(before, token):
                last += chr(size)
                break
        # where the paths of all prefixes that can still grow meet
        cut = end - grow[0]
        for size in grow[1:]:
            tip = end - size
            while tip != cut:
                if tip > cut:
                    tip -= ord(last[tip - 1])
                else:
                    cut -= ord(last[cut - 1])
        if not cut:
            return self._number((left, pending, last, tail))
        emitted, at = [], cut
        while at:
            size = ord(last[at - 1])
            emitted.append(pending[at - size : at])
            at -= size
        after = (emitted[0], pending[cut:], last[cut:], tail)
        return [self.ranks[t] for t in reversed(emitted)], self._number(after)

    def encode(self, text: bytes) -> list[int]:
        """The ids of one pre-token."""
        whole = self.ranks.get(text)
        if whole is not None:
            return [whole]
        if len(self.states) > STATES:
            self.moves.clear(), self.numbers.clear(), self.states.clear()
            self._number((b"", b"", "", b""))
        moves, found, state = self.moves, [], 0
        for byte in text:
            key = state << 8 | byte
            step = moves.get(key)
            if step is None:
                step = moves[key] = self._step(self.states[state], bytes((byte,)))
            if step.__class__ is int:
                state = step
            else:
                found += step[0]
                state = step[1]
        _, pending, last, _ = self.states[state]
        at, rest = len(pending), []
        while at:
            size = ord(last[at - 1])
            rest.append(self.ranks[pending[at - size : at]])
            at -= size
        return found + rest[::-1]


class Utf8Stream:
    """Incremental decoding: bytes in pieces of any size, text out as soon as it is complete.

    The machine's state is the unfinished character, at most three bytes. What cannot be
    part of a character is given as U+FFFD.
    """

    def __init__(self):
        self.held = b""

    def feed(self, piece: bytes) -> str:
        data = self.held + piece
        keep = self._unfinished(data)
        self.held = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """How many bytes at the end are the start of a character that is not complete."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:
                continue  # a following byte; its first byte stands further left
            need = 2 if 0xC2 <= byte < 0xE0 else 3 if 0xE0 <= byte < 0xF0 else 4 if 0xF0 <= byte < 0xF5 else 1
            return back if back < need else 0
        return 0


def _vocabulary(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all tokens in the order of ids, and where each starts."""
    size = max(ranks.values()) + 1
    by_id = [b""] * size
    for token, rank in ranks.items():
        by_id[rank] = token
    ends = np.cumsum([0, *map(len, by_id)])
    return np.frombuffer(b"".join(by_id), np.uint8), ends


def spread(flat: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The parts ``flat[bounds[w]:bounds[w + 1]]`` for each ``w`` of ``which``, one after another."""
    sizes = (bounds[1:] - bounds[:-1])[which]
    shift = np.repeat(bounds[:-1][which] - (np.cumsum(sizes) - sizes), sizes)
    return flat[shift + np.arange(int(sizes.sum()))]


def encoded(column: pa.Array, tables: dict):
    """For each piece of a batch: text bounds in tokens, all ids (32 bits), and the pre-tokens as
    ``(which, bounds in pre-tokens, bytes of the ids of the distinct ones)``. Known pre-tokens
    are kept as bytes, which take a quarter of the memory of tuples of numbers."""
    gc.disable()  # states and pre-tokens hold no cycles, and walking through them takes time
    machine, known, table = Transducer(tables), tables["known"], tables["classes"]
    for data, bounds in arrays.pieces(column, PIECE):
        starts = pretokens.split(data, bounds, table)
        different, which = pretokens.distinct(data, starts)
        lists = []
        for text in different.to_pylist():
            ids = known.get(text)
            if ids is None:
                if len(known) > KNOWN:
                    known.clear()
                ids = known[text] = array("i", machine.encode(text)).tobytes()
            lists.append(ids)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        flat = np.frombuffer(b"".join(lists), np.int32)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        first = np.searchsorted(starts, bounds)
        total = np.concatenate([[0], np.cumsum(sizes[which])]) if len(which) else np.zeros(1, np.int64)
        yield total[first], spread(flat, ends, which), which, first, lists


def _decimals(lists: list[bytes], tables: dict) -> np.ndarray:
    """The decimal ids, comma-joined, of each of ``lists``."""
    made, found = tables["decimals"], []
    for ids in lists:
        text = made.get(ids)
        if text is None:
            if len(made) > KNOWN:
                made.clear()
            text = made[ids] = ",".join(map(str, array("i", ids))).encode()
        found.append(text)
    return np.array(found, object)


def _digests(column: pa.Array, tables: dict, voc: np.ndarray, voc_ends: np.ndarray) -> list[tuple]:
    rows = []
    for first, ids, which, places, lists in encoded(column, tables):
        decimal = _decimals(lists, tables)
        for a, b, p, q in zip(first[:-1], first[1:], places[:-1], places[1:]):
            text = hashlib.sha256()
            stream = Utf8Stream()
            for k in range(a, b, 1 << 16):
                raw = spread(voc, voc_ends, ids[k : min(k + (1 << 16), b)]).tobytes()
                text.update(stream.feed(raw).encode())
            text.update(stream.close().encode())
            joined = b",".join(decimal[which[p:q]].tolist())
            rows.append((int(b - a), hashlib.sha256(joined).hexdigest(), text.hexdigest()))
    return rows


def prepared(spark, path: str):
    """The tables of a rank file as a broadcast value; its size is that of the vocabulary.

    Workers keep what they learn (states, pre-tokens) in it from task to task.
    """
    tables = compile_tables(read_ranks(path))
    tables["classes"] = pretokens.classes(unicode16=True)
    return spark.sparkContext.broadcast(tables)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``.

    Texts are encoded whole by the ranks in the file at ``path`` (on the driver), each
    pre-token by itself, without special tokens; null is empty. The ids are decoded again,
    and the digest is that of the bytes decoded. Repeated rows are rows of their own; other
    columns are not looked at.
    """
    shared = prepared(docs.sparkSession, path)

    @F.arrow_udf("struct<n_tokens:long, ids_sha256:string, decoded_sha256:string>")
    def run(column: pa.Array) -> pa.Array:
        voc, ends = _vocabulary(shared.value["ranks"])
        rows = _digests(column, shared.value, voc, ends)
        kinds = [pa.int64(), pa.string(), pa.string()]
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        return pa.StructArray.from_arrays(columns, ["n_tokens", "ids_sha256", "decoded_sha256"])

    out = docs.select(docs[f"`{id_col}`"], run(docs[f"`{text}`"].cast("string")).alias("r"))
    return out.select(F.col(f"`{id_col}`"), "r.*")


def _size(column: pa.Array) -> int:
    """Bytes of all texts of a batch."""
    return pc.sum(pc.binary_length(column).cast(pa.int64())).as_py() or 0


def encode_ids(docs: DataFrame, path: str, out: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` with the token ids of each whole text in a column ``out`` (``array<int>``).

    A column of that name is replaced; a null text has no ids. All other columns stay.
    """
    shared = prepared(docs.sparkSession, path)

    @F.arrow_udf("array<int>")
    def run(column: pa.Array) -> pa.Array:
        # a token has a byte at least; memory that is not written to is not taken
        flat, ends = np.empty(_size(column), np.int32), [np.zeros(1, np.int64)]
        for first, ids, *_ in encoded(column, shared.value):
            at = int(ends[-1][-1])
            flat[at : at + len(ids)] = ids
            ends.append(first[1:] + at)
        return pa.ListArray.from_arrays(
            pa.array(np.concatenate(ends).astype(np.int32)), pa.array(flat[: int(ends[-1][-1])])
        )

    return docs.withColumn(out, run(docs[f"`{text}`"].cast("string")))


def decode_ids(docs: DataFrame, path: str, out: str = "decoded", ids: str = "ids") -> DataFrame:
    """``docs`` with the text of the token ids in a column ``out``, decoded as a stream.

    A column of that name is replaced; null ids give a null text, no ids an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_vocabulary(read_ranks(path)))  # the vocabulary

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        voc, ends = shared.value
        flat, bounds = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        valid, texts, places = column.is_valid().to_numpy(zero_copy_only=False), bytearray(), [0]
        for a, b, there in zip(bounds[:-1].tolist(), bounds[1:].tolist(), valid.tolist()):
            if there:
                stream = Utf8Stream()
                for k in range(a, b, 1 << 16):
                    texts += stream.feed(spread(voc, ends, flat[k : min(k + (1 << 16), b)]).tobytes()).encode()
                texts += stream.close().encode()
            places.append(len(texts))
        offsets = pa.py_buffer(np.array(places, np.int32))
        mask = pa.py_buffer(np.packbits(valid, bitorder="little"))
        return pa.StringArray.from_buffers(len(column), offsets, pa.py_buffer(texts), mask)

    return docs.withColumn(out, run(docs[f"`{ids}`"]))
