"""Message routing by key and status normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def message_flag(key: str | Column = "key") -> Column:
    """Second comma-separated field of the key as INT; null when absent or not
    an integer in plain digits (``get`` and ``try_cast`` never raise under
    ANSI mode; the cast alone would accept blanks)."""
    field = F.get(F.split(_col(key), ","), 1)
    return F.when(field.rlike(r"^[+-]?[0-9]+$"), field.try_cast(T.IntegerType()))


def normalized_status(status: str | Column = "status") -> Column:
    """Status compared the way the state machine does: trimmed, upper case."""
    return F.upper(F.trim(_col(status)))
