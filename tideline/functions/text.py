"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words_of(line: Column, lower: bool = True) -> Column:
    """Words of a line, split on single blanks.

    Inner and leading empty words stay, trailing ones go; an empty line is one empty word and
    a line of blanks has none.
    """
    text = F.lower(line) if lower else line
    words = F.split(F.rtrim(text), " ", -1)
    only_blanks = (line != "") & (F.ltrim(line) == "")
    return F.when(only_blanks, F.array().cast("array<string>")).otherwise(words)
