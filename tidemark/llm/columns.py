"""Small column helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space, as the word pattern [^\x20\x09-\x0D]+ leaves it out.
BLANKS = "\t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once per row however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text in order; an empty array for null or no words."""
    spaced = F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def text_of(docs: DataFrame, name: str = "text") -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(docs[name].cast("string"), F.lit(""))


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``docs`` has."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
