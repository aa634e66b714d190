"""Small column helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of the contracts: space and the control characters 09 to 0D.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def spare(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (compared without case)."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def quoted(name: str) -> Column:
    """The column of that very name, dots included."""
    return F.col(f"`{name.replace('`', '``')}`")


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def words_of(text: Column) -> Column:
    """Array of the runs of characters that are no white space; empty for null or blank texts."""
    inner = trimmed(F.coalesce(text, F.lit("")))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def lower_ascii(text: Column) -> Column:
    """``text`` with A to Z lowered and every other character as it is."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def one_text(rows: DataFrame, id_column: str, text_column: str, *others: str) -> DataFrame:
    """One row for each id, before and after the shuffle: a text, if there is one, of least hash. ``others``: values that
    the id determines."""
    text = F.col(text_column)
    least = F.min(F.struct(text.isNull().alias("none"), F.xxhash64(text).alias("hash"), text.alias("text")))
    found = rows.groupBy(id_column, *others).agg(least.alias("_least"))
    return found.select(id_column, F.col("_least.text").alias(text_column), *others)
