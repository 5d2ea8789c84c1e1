"""Column expressions for words, lines and keys. Words are runs of characters other than ASCII white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else (Spark's lower() also folds other letters)."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text in order; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    """How many words, from the pieces between runs of white space less the empty ends."""
    text = F.coalesce(text, F.lit(""))
    parts = F.split(text, SPACE)
    ends = F.when(text == "", 1).otherwise(
        F.when(text.rlike(r"\A[\x20\x09-\x0D]"), 1).otherwise(0) + F.when(text.rlike(r"[\x20\x09-\x0D]\z"), 1).otherwise(0)
    )
    # a text of white space alone splits into two empty pieces and both its ends count
    return (F.size(parts) - ends).cast("long")


def order_hash(key: Column, salt: str) -> Column:
    """60 bits of md5 over the salted key, the same in any engine; null has a value of its own."""
    salted = F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit("\u0000null")))
    return F.conv(F.substring(F.md5(salted), 1, 15), 16, 10).cast("long")
