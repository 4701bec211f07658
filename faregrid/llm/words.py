"""Words as maximal runs of characters other than the six ASCII blanks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
_BLANK_RUN = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text; none where it is null or blank."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, _BLANK_RUN, -1)
    )


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def computed_once(df: DataFrame, *carry: str, **columns: Column) -> DataFrame:
    """``carry`` columns and new ones that later filters and columns do not recompute.

    A plain projection would be substituted into every expression above it; the
    one-row ``inline`` keeps long list expressions evaluated once per row.
    """
    cells = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*[F.col(f"`{c}`") for c in carry], F.inline(F.array(cells)))


def set_aside(docs: DataFrame, *needed: str) -> tuple[DataFrame, dict[str, str]]:
    """All columns under names of their own, beside the ``needed`` ones.

    Returns the frame and the map from the names of ``docs`` to the others, so that an
    operator can add columns whatever the columns of its input are called.
    """
    names = {c: f"_in_{i}" for i, c in enumerate(docs.columns)}
    aside = [F.col(f"`{c}`").alias(other) for c, other in names.items()]
    return docs.select(*needed, *aside), names


def put_back(df: DataFrame, names: dict[str, str], **changed: Column) -> DataFrame:
    """The columns set aside under their old names, some with new values."""
    return df.select(*[changed.get(c, F.col(other)).alias(c) for c, other in names.items()])
