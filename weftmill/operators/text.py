"""Text to parts and byte symbols."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftmill.functions.bytesym import symbols

# The contractions, and the characters of the Unicode space classes that a locale-aware
# regular expression counts as blank. The three no-break spaces (A0, 2007, 202F) aren't blanks.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
BLANK = r"\x09-\x0D\x20\x{85}\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}"

# Contractions | optional space + word | optional space + punctuation | blanks. Contractions and
# punctuation can both start with an apostrophe, so contractions go first. The possessive quantifiers
# only save backtracking.
PART_PATTERN = (
    "|".join(CONTRACTIONS) + r"| ?[\p{L}\p{N}_]++| ?[^" + BLANK + r"\p{L}\p{N}_]++|[" + BLANK + "]++"
)


def parts_of(text: Column | str) -> Column:
    """All parts of a text, in order."""
    return F.regexp_extract_all(text, F.lit(PART_PATTERN), F.lit(0))


def pretokenize(df: DataFrame, text_col: str, id_cols: list[str]) -> DataFrame:
    """`(ids, part_position, part)`, positions from 1. Map side only."""
    return df.select(*id_cols, F.posexplode(parts_of(text_col)).alias("_i", "part")).select(
        *id_cols, (F.col("_i") + 1).alias("part_position"), "part"
    )


def distinct_parts(df: DataFrame, text_col: str) -> DataFrame:
    """`(part, n)`: every distinct part with its number of occurrences.

    Counts are combined before the shuffle, so frequent parts cost one row per task.
    """
    return (
        df.select(F.explode(parts_of(text_col)).alias("part"))
        .groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def byte_symbols(parts: DataFrame) -> DataFrame:
    """`(part, position, character)`: one row per UTF-8 byte of the part, positions from 1."""
    return parts.select(
        "part", F.posexplode(F.split(symbols("part"), "")).alias("_i", "character")
    ).select("part", (F.col("_i") + 1).alias("position"), "character")
