"""Vehicle identifiers as delivered, brought to one spelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\x0b\x0c 　﻿"


def bare_vehicle(col: Column | str, width: int = 8) -> Column:
    """The bare number of a vehicle: blanks around it and leading zeros go, the rest is padded to ``width``.

    Null, empty and blank spellings give null. A text that is no number keeps its characters.
    """
    col = F.col(col) if isinstance(col, str) else col
    text = F.btrim(col, F.lit(BLANKS))
    bare = F.call_function("ltrim", F.lit("0"), text)
    return F.when(F.length(text) > 0, F.when(F.length(bare) < width, F.lpad(bare, width, "0")).otherwise(bare))
