"""Bytes <-> printable symbols.

Fixed rule of the byte map: bytes 33-126, 161-172 and 174-255 stand for the code point of the
same number; the other 68 bytes, in byte order, stand for code points 256, 257, ...
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SAME = {*range(33, 127), *range(161, 173), *range(174, 256)}
_MOVED = [b for b in range(256) if b not in _SAME]
_MOVED_FROM = "".join(map(chr, _MOVED))
_MOVED_TO = "".join(chr(256 + i) for i in range(len(_MOVED)))


def encoder_rows() -> list[tuple[str, int]]:
    """All 256 `(character, byte)` pairs."""
    moved = dict(zip(_MOVED, _MOVED_TO))
    return [(moved.get(b, chr(b)), b) for b in range(256)]


def encoder_table(spark: SparkSession) -> DataFrame:
    """The byte map as a table `(character, byte)`; always 256 rows."""
    return spark.createDataFrame(encoder_rows(), "character string, byte int")


def symbols(text: Column | str) -> Column:
    """UTF-8 bytes of a string as a string with one printable symbol per byte.

    Decoding the bytes as Latin-1 gives one character per byte, and `translate` moves the 68
    unprintable ones: the whole map is one expression in the scan stage.
    """
    latin1 = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    return F.translate(latin1, _MOVED_FROM, _MOVED_TO)


def known_symbols(text: Column | str) -> Column:
    """The string without characters that stand for no byte."""
    return F.regexp_replace(text, "[^\\u0021-\\u007E\\u00A1-\\u00AC\\u00AE-\\u0143]", "")


def symbol_bytes(text: Column | str) -> Column:
    """Inverse of `symbols`: the bytes of a string of printable symbols.

    `translate` cannot produce the zero byte, so the string is taken apart at its symbol and put
    together again around it.
    """
    zero = _MOVED_TO[0]
    back = lambda s: F.translate(s, _MOVED_TO[1:], _MOVED_FROM[1:])
    pieces = F.transform(F.split(text, zero), back)
    return F.encode(F.array_join(pieces, "\0"), "ISO-8859-1")
