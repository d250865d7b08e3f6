"""Words of alphanumeric and non-ASCII characters, on built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def tokens(text: Column) -> Column:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z (and nothing else)."""

    def low(word: Column) -> Column:
        ascii_only = F.octet_length(word) == F.char_length(word)
        return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))

    return F.filter(F.transform(F.split(text, _BETWEEN, -1), low), lambda word: word != "")
