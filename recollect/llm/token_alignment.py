"""Two tokenizers' tokens of a text held against each other by their byte ranges.

In a batch ``pandas.merge_asof``, keyed by document, finds for each token's start the other
side's token that covers it. Both directions together are all overlaps, and equal ends cut
the tokens into groups. How often two ids overlap in the corpus is counted per block of
texts first; a block gets its pairs' counts back and adds them up for its documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recollect.llm.chunks import CUT, MARK, Chunks, byte_level_encoder, groups, single_threaded, spans, whole
from recollect.llm.store import discard, stored

#: Characters aligned at once, and overlaps of a block (some 20 bytes each in its task).
SIZE, BLOCK = 1 << 19, 1_500_000
#: Ids of the second side fit so many bits.
B_BITS = 24

_ALIGNED = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "links array<int>, pairs array<long>, counts array<long>"
)


def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1
    for itself, the others in order from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(other)}


def byte_level_bytes(library) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    byte = _byte_level()
    names = [library.id_to_token(i) or "" for i in range(library.get_vocab_size(with_added_tokens=True))]
    return [bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode() for name in names]


def piece_bytes(library) -> list[bytes]:
    """The bytes of each id of a piece vocabulary with byte fallback."""
    names = [library.id_to_piece(i) for i in range(library.get_piece_size())]
    single = re.compile(r"<0x([0-9A-Fa-f]{2})>")
    return [bytes([int(m[1], 16)]) if (m := single.fullmatch(name)) else name.replace(MARK, " ").encode() for name in names]


def covering(doc: np.ndarray, start: np.ndarray, other_doc: np.ndarray, other_start: np.ndarray) -> np.ndarray:
    """For each start the number of the other side's token that covers it, by an as-of merge.

    Starts ascend over all documents, so the tokens of both sides are in order.
    """
    left = pd.DataFrame({"start": start, "doc": doc})
    right = pd.DataFrame({"start": other_start, "doc": other_doc, "token": np.arange(len(other_start))})
    return pd.merge_asof(left, right, on="start", by="doc", direction="backward")["token"].to_numpy().astype(np.int64)


class Aligned:
    """The tokens of some texts with their overlaps and groups, as flat arrays.

    ``a`` and ``b`` are ids, ``first_a`` and ``first_b`` the tokens before each text,
    ``left`` and ``right`` the tokens of each overlap, ``of`` its text, ``group_a`` and
    ``group_b`` the group of each token, counted over all texts."""

    def __init__(self, a: np.ndarray, first_a: np.ndarray, b: np.ndarray, first_b: np.ndarray, bytes_a: np.ndarray, bytes_b: np.ndarray):
        self.a, self.b, self.first_a, self.first_b = a, b, first_a, first_b
        texts = len(first_a) - 1
        ends_a, ends_b = np.cumsum(bytes_a[a]), np.cumsum(bytes_b[b])
        starts_a, starts_b = ends_a - bytes_a[a], ends_b - bytes_b[b]
        doc_a, doc_b = np.repeat(np.arange(texts), np.diff(first_a)), np.repeat(np.arange(texts), np.diff(first_b))
        under_a = covering(doc_a, starts_a, doc_b, starts_b)
        under_b = covering(doc_b, starts_b, doc_a, starts_a)
        extra = np.flatnonzero(starts_a[under_b] != starts_b)  # equal starts are in the first direction
        self.left = np.concatenate([np.arange(len(a)), under_b[extra]])
        self.right = np.concatenate([under_a, extra])
        self.of = np.concatenate([doc_a, doc_b[extra]])
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self.group_a, self.group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        last = np.searchsorted(ends_a, shared)  # the last token of each group
        self.n_groups = np.bincount(doc_a[last], minlength=texts)

    def written(self, names_a: np.ndarray, names_b: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text. ``names``: each id with the mark for inside its
        side of a group behind it, then each with the mark for the end."""
        ends_a = np.append(self.group_a[1:] != self.group_a[:-1], True)[: len(self.a)]
        ends_b = np.append(self.group_b[1:] != self.group_b[:-1], True)[: len(self.b)]
        at_a = np.arange(len(self.a)) + np.searchsorted(self.group_b, self.group_a)
        at_b = np.arange(len(self.b)) + np.searchsorted(self.group_a, self.group_b, "right")
        every = np.empty(len(self.a) + len(self.b), object)
        every[at_a] = names_a[self.a + ends_a * (len(names_a) // 2)]
        every[at_b] = names_b[self.b + ends_b * (len(names_b) // 2)]
        cuts = (self.first_a + self.first_b).tolist()
        return ["".join(every[x:y].tolist())[:-1] for x, y in zip(cuts, cuts[1:])]


def _names(n: int, inside: str, end: str) -> np.ndarray:
    return np.array([f"{i}{inside}" for i in range(n)] + [f"{i}{end}" for i in range(n)], object)


class _Aligner:
    """A task's tokenizers and their tables."""

    def __init__(self, byte_library, piece_model: bytes, cut: bool):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.tables = byte_level_bytes(byte_library), piece_bytes(pieces)
        self.sizes = [np.array([len(t) for t in table], np.int64) for table in self.tables]
        self.joined = [np.frombuffer(b"".join(table), np.uint8) for table in self.tables]
        self.starts = [np.cumsum(sizes) - sizes for sizes in self.sizes]
        self.names = _names(len(self.tables[0]), ",", "|"), _names(len(self.tables[1]), ",", ";")
        self.chunks = Chunks(
            byte_level_encoder(byte_library, self.sizes[0]),
            lambda texts: pieces.encode(texts, num_threads=1),
            split=CUT.split if cut else whole,
        )
        self.odd: set[int] = set()  # chunks that either side does not give back

    def align(self, texts: list[str]) -> tuple[np.ndarray, Aligned]:
        """Which texts have tokens (not empty, given back byte for byte), and those aligned."""
        numbers, first, fresh = self.chunks.numbers(texts)
        new = len(self.chunks.known) - len(fresh)
        self.odd = self.odd if new else set()
        self.odd.update(self._not_given_back(fresh, np.arange(new, new + len(fresh))))
        good = np.array([bool(text) for text in texts])
        if self.odd:
            odd = np.fromiter(self.odd, np.int64, len(self.odd))
            hit = np.flatnonzero(np.isin(numbers, odd))
            for t in np.unique(np.searchsorted(first, hit, "right") - 1).tolist():
                own, whole = numbers[first[t] : first[t + 1]], b" " + texts[t].encode()
                good[t] &= all(self._joined(k, own) == whole for k in (0, 1))
        kept = np.flatnonzero(good)
        size = np.diff(first)[kept]
        at = np.repeat(first[kept] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        first = np.concatenate([[0], np.cumsum(size)])
        (a, first_a), (b, first_b) = (self.chunks.ids(k, numbers[at], first) for k in (0, 1))
        return good, Aligned(a, first_a, b, first_b, *self.sizes)

    def _not_given_back(self, texts: list[str], numbers: np.ndarray) -> list[int]:
        """Which of the chunks differ from their bytes on either side."""
        raw = b" " + b" ".join(text.encode() for text in texts)
        want = np.fromiter((len(text.encode()) + 1 for text in texts), np.int64, len(texts))
        for k in (0, 1):
            ids, first = self.chunks.ids(k, numbers, np.arange(len(numbers) + 1))
            ends = np.concatenate([[0], np.cumsum(self.sizes[k][ids])])[first]
            if (np.diff(ends) != want).any() or self.joined[k][spans(self.starts[k][ids], self.sizes[k][ids])].tobytes() != raw:
                return [n for n, text in zip(numbers.tolist(), texts) if any(self._joined(k, np.array([n])) != b" " + text.encode() for k in (0, 1))]
        return []

    def _joined(self, k: int, numbers: np.ndarray) -> bytes:
        table, ends, flat = self.tables[k], self.chunks.ends[k], self.chunks.flat[k]
        return b"".join(table[i] for n in numbers.tolist() for i in flat[ends[n] : ends[n + 1]].tolist())


def aligned(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each text: counts, ``groups`` written out (empty without tokens), and ``links``,
    its overlaps as places in the block's pairs; and a row for each block: ``pairs`` and
    ``counts``. Blocks are numbered anew whenever this is computed: store it."""
    import sentencepiece
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(byte_path)
    library.encode_special_tokens = True
    library.no_truncation()
    library.no_padding()
    with open(piece_path, "rb") as file:
        model = file.read()
    vocabulary = sentencepiece.SentencePieceProcessor(model_proto=model)
    names = [vocabulary.id_to_piece(i) for i in range(vocabulary.get_piece_size())]
    cut = not any(MARK in name.lstrip(MARK) for name in names)  # else whole texts are chunks
    shared = docs.sparkSession.sparkContext.broadcast((library, model, cut))  # as large as the vocabularies

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single_threaded()
        library, model, cut = shared.value
        library.encode_special_tokens = True
        aligner, part, block = _Aligner(library, model, cut), TaskContext.get().partitionId(), 0
        held, size = [], 0

        def rows(**columns) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            arrays = [columns.get(f.name, pa.nulls(n, f.type)) for f in schema]
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) if not isinstance(x, pa.Array) else x for x, f in zip(arrays, schema)], schema=schema)

        def flush() -> Iterator[pa.RecordBatch]:
            number = (part << 32) | block
            pairs, inverse = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            counts, at = np.zeros(len(pairs), np.int64), 0
            for own, n, places, ends, columns in held:
                place = inverse[at : at + len(own)]
                at += len(own)
                counts[place] += n
                links = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place[places].astype(np.int32)))
                yield rows(block=np.full(len(ends) - 1, number), links=links, **columns)
            yield rows(block=np.array([number]), pairs=[pairs], counts=[counts])

        for names, texts in groups(batches, SIZE):
            good, found = aligner.align(texts)
            key = (found.a[found.left].astype(np.int64) << B_BITS) | found.b[found.right]
            order = np.argsort(found.of, kind="stable")
            own, places, n = np.unique(key[order], return_inverse=True, return_counts=True)
            where = np.flatnonzero(good)
            links = np.zeros(len(texts), np.int64)
            links[where] = np.bincount(found.of, minlength=len(where))
            columns = {"doc_id": pa.array(names, pa.int64()), "n_links": links.copy()}
            for name, values in (("n_a", np.diff(found.first_a)), ("n_b", np.diff(found.first_b)), ("n_groups", found.n_groups)):
                columns[name] = np.zeros(len(texts), np.int64)
                columns[name][where] = values
            written = np.full(len(texts), "", object)
            written[where] = found.written(*aligner.names)
            columns["groups"] = pa.array(written.tolist(), pa.string())
            held.append((own, n, places.astype(np.int32), np.concatenate([[0], np.cumsum(links)]), columns))
            size += len(places)
            if size >= BLOCK:
                yield from flush()
                held, size, block = [], 0, block + 1
        if held:
            yield from flush()

    schema = pa.schema([
        *((c, pa.int64()) for c in ("block", "doc_id", "n_a", "n_b", "n_groups", "n_links")), ("groups", pa.string()),
        ("links", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
    ])
    plain = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].cast("string").alias("text"))
    return plain.mapInArrow(run, _ALIGNED)


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair, n, best`` over all blocks: how many overlaps hold the two ids, and whether no
    other id of the first side overlaps that of the second more often."""
    each = found.filter("pairs is not null").select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    counts = stored(each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n")), "pair-counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1)).alias("b")
    most = counts.groupBy(b).agg(F.max("n").alias("most"))  # a row for each id of a vocabulary
    return counts.select("pair", "n", b).join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _summed(key, texts: pa.Table, values: pa.Table) -> pa.Table:
    """The documents of a block, with the sums over their links."""
    order = np.argsort(values.column("place").to_numpy())
    n, best = values.column("n").to_numpy()[order], values.column("best").to_numpy()[order]
    links = texts.column("links").combine_chunks()
    links = links.chunk(0) if isinstance(links, pa.ChunkedArray) else links
    flat, ends = links.flatten().to_numpy(), np.concatenate([[0], np.cumsum(links.value_lengths().to_numpy(zero_copy_only=False))])
    sums = [np.concatenate([[0], np.cumsum(each[flat], dtype=np.int64)]) for each in (best, n)]
    out = texts.drop_columns(["links", "block"])
    for name, total in zip(("n_best", "count_sum"), sums):
        out = out.append_column(name, pa.array(total[ends[1:]] - total[ends[:-1]]))
    return out


def align_tokens(
    docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text: str = "text", written: bool = True
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` for every row of ``docs``
    (``groups_sha256`` instead of the last, unless ``written``).

    A is the byte-level file at ``byte_path`` on a space and the text, B the piece model at
    ``piece_path`` on the text (it adds the space); both are read on the driver. Special
    strings are plain text. Overlaps are pairs of token occurrences whose byte ranges meet;
    ``count_sum`` adds up how many overlaps of the corpus hold the same two ids, ``n_best``
    counts those whose A id is the most frequent (or as frequent) for their B id. ``groups``
    are A ids and B ids between places where tokens of both end: ``a1,a2|b1;a3|b2``. Null and
    empty texts, and those that either side does not give back byte for byte, have no
    tokens: zeros, an empty string. Repeated rows count each; a null id is carried; an empty
    table gives no rows; other columns are not looked at.
    """
    found = aligned(docs, byte_path, piece_path, id_col, text)
    name = "groups" if written else "groups_sha256"
    if not written:
        found = found.withColumn("groups", F.when(F.col("n_links") > 0, F.sha2("groups", 256)).otherwise(F.lit("")))
    found = stored(found.withColumnRenamed("groups", name), "aligned")
    counts = stored(pair_counts(found), "pairs")
    each = found.filter("pairs is not null").select("block", F.posexplode("pairs").alias("place", "pair"))
    values = each.join(counts, "pair").select(F.col("block").alias("of"), "place", "n", "best")
    texts = found.filter("pairs is null").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", name, "links")
    schema = f"doc_id long, n_a long, n_b long, n_groups long, n_links long, {name} string, n_best long, count_sum long"
    out = stored(texts.groupBy("block").cogroup(values.groupBy("of")).applyInArrow(_summed, schema), "alignment")
    discard(found, counts)
    return out.withColumnRenamed("doc_id", id_col)
