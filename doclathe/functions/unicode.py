"""Unicode composition and white space as Column functions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _compose(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None else unicodedata.normalize("NFC", x))


#: NFC leaves every text alone whose code points all lie below U+0300.
_COMPOSABLE = "[\\x{300}-\\x{10FFFF}]"


def nfc(c: Column) -> Column:
    """NFC of c; null stays null. Only texts that composition can alter cross to Python; the others are sent as nulls."""
    return F.coalesce(F.pandas_udf(_compose, StringType())(F.when(c.rlike(_COMPOSABLE), c)), c)


def squeeze(c: Column) -> Column:
    """Runs of Unicode white space (non-breaking included) become one space, ends trimmed; null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[\s\x1c-\x1f]+", " "))
