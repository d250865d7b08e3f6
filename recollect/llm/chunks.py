"""Texts cut where tokenizers never join, so that equal chunks are encoded once.

A cut is a single space between a printable ASCII character or word character and a
character that is no space. The byte-level and word patterns take a space only in front of
a word or within white space, and a piece vocabulary in which the space mark stands in
front only never merges across one. So the ids of a text are those of its chunks in order.
"""

from __future__ import annotations

import os
import re
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa

#: The space that is cut out; the rest of the pattern only looks.
CUT = re.compile(r" (?<=[!-~\w] )(?=[^ ])")
#: Chunks and tokens that a task keeps before it starts anew.
KEPT_CHUNKS, KEPT_TOKENS = 250_000, 2_000_000
#: Chunks given to a library at once.
BATCH = 20_000
#: The space mark of piece vocabularies.
MARK = "▁"

#: For patterns that drop white space: runs of letters and of marks like full stops, as far as
#: nothing follows that could belong to them; where something does, all up to the next space.
#: Letters are those that stay letters when composed and lower-cased (not U+0130, for one).
_LETTERS = r"A-Za-zÀ-ÖØ-öø-\u012F\u0131-\u017F\u0391-\u03A1\u03A3-\u03C9\u0400-\u045F\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FFF\uAC00-\uD7A3"
_MARKS = r".,;:!?\n#$%&*"
_ON = rf"[^{_LETTERS} {_MARKS}][^ ]*"
WORDS = re.compile(rf"[{_LETTERS}]+(?:{_ON})?|[{_MARKS}]+(?:{_ON})?|{_ON}")
#: Chunks that are put together for one call where their ids can be told apart afterwards.
TOGETHER = 500

Encoder = Callable[[list[str]], Sequence[Sequence[int]]]


def single_threaded() -> None:
    """Keep a library's own threads out of a task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``first[k] .. first[k] + size[k]`` for each k, one after the other."""
    total = int(size.sum())
    return np.arange(total) + np.repeat(first - (np.cumsum(size) - size), size)


class Chunks:
    """Numbers of distinct chunks, with their ids under each of some encoders."""

    def __init__(self, *encoders: Encoder, split: Callable[[str], list[str]] = CUT.split):
        self.encoders, self.split = encoders, split
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = defaultdict(count().__next__)  # a new chunk gets the next number
        self.flat = [np.zeros(0, np.int32) for _ in self.encoders]
        self.ends = [np.zeros(1, np.int64) for _ in self.encoders]

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """The chunks of the texts by number, the chunks before each text (and all), and
        the chunks that are new. Numbers hold until the next call."""
        if len(self.known) > KEPT_CHUNKS or sum(map(len, self.flat)) > KEPT_TOKENS:
            self._clear()
        known, old, found, first = self.known, len(self.known), [], [0]
        for text in texts:
            found += map(known.__getitem__, self.split(text))
            first.append(len(found))
        fresh = list(islice(known, old, None))
        for at in range(0, len(fresh), BATCH):
            for k, encode in enumerate(self.encoders):
                made = encode(fresh[at : at + BATCH])
                size = np.fromiter(map(len, made), np.int64, len(made))
                flat = np.fromiter(chain.from_iterable(made), np.int32, int(size.sum()))
                self.flat[k] = np.concatenate([self.flat[k], flat])
                self.ends[k] = np.concatenate([self.ends[k], self.ends[k][-1] + np.cumsum(size)])
        return np.array(found, np.int64), np.array(first, np.int64), fresh

    def ids(self, k: int, numbers: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts under encoder ``k``, and the ids before each text (and all)."""
        low = self.ends[k][numbers]
        size = self.ends[k][numbers + 1] - low
        before = np.concatenate([[0], np.cumsum(size)])
        return self.flat[k][spans(low, size)], before[first]


def whole(text: str) -> list[str]:
    """For vocabularies that may join across any character."""
    return [text]


def word_split(text: str) -> list[str]:
    """Chunks for a vocabulary that drops white space and lower-cases. ASCII is lower-cased here
    already, so that fewer chunks differ, but where a special string may stand."""
    return WORDS.findall(text.lower() if text.isascii() and "<|" not in text else text)


def byte_level_encoder(library, sizes: np.ndarray) -> Encoder:
    """Ids of a space and each chunk, by a byte-level vocabulary whose ids have ``sizes`` bytes.

    Chunks with word characters at both ends are put together, as ids give back the bytes;
    what does not come apart at the chunks' ends is encoded one by one.
    """

    def single(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in library.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def run(texts: list[str]) -> list[list[int]]:
        return _together(texts, lambda t: t[:1] != " " and t[-1:].isalnum(), single, ends)

    def ends(texts: list[str], ids: np.ndarray) -> np.ndarray | None:
        want = np.cumsum([len(t.encode()) + 1 for t in texts])
        have = np.cumsum(sizes[ids])
        at = np.searchsorted(have, want)
        return at + 1 if have[-1] == want[-1] and (have[at] == want).all() else None

    return run


def word_encoder(library) -> Encoder:
    """Ids of each chunk, by a vocabulary that marks the ends of words. Chunks of
    letters, which are one word each, are put together."""
    last = np.array([(library.id_to_token(i) or "").endswith("</w>") for i in range(library.get_vocab_size(with_added_tokens=True))])

    def single(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]

    def ends(texts: list[str], ids: np.ndarray) -> np.ndarray | None:
        at = np.flatnonzero(last[ids]) + 1
        return at if len(at) == len(texts) and at[-1] == len(ids) else None

    return lambda texts: _together(texts, str.isalpha, single, ends)


def _together(texts: list[str], plain: Callable[[str], bool], single: Encoder, ends: Callable) -> list[list[int]]:
    """Ids of each text by ``single``, which gets many ``plain`` ones in one string; ``ends``
    tells behind which ids they end, or None."""
    found: list[list[int]] = [[]] * len(texts)
    easy = [k for k, text in enumerate(texts) if plain(text)]
    parts = [easy[k : k + TOGETHER] for k in range(0, len(easy), TOGETHER)]
    alone = [k for k, text in enumerate(texts) if not plain(text)]
    for part, ids in zip(parts, single([" ".join(texts[k] for k in part) for part in parts])):
        cuts = ends([texts[k] for k in part], np.array(ids, np.int64))
        if cuts is None:
            alone += part
            continue
        cuts = [0, *cuts.tolist()]
        for k, low, high in zip(part, cuts, cuts[1:]):
            found[k] = ids[low:high]
    for k, ids in zip(alone, single([texts[k] for k in alone])):
        found[k] = ids
    return found


def groups(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts (null: empty) of consecutive rows, some ``size`` characters at a time."""
    names, texts, held = [], [], 0
    for batch in batches:
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            names.append(name)
            texts.append(text.as_py() or "")
            held += len(texts[-1])
            if held >= size or len(texts) >= size // 64:
                yield names, texts
                names, texts, held = [], [], 0
    if texts:
        yield names, texts
