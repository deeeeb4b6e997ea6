"""Order and equality of names that fold A-Z only."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def nocase(c: Column) -> Column:
    """A-Z as a-z and all else as it is: É and é stay apart and come after Z."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def strip(c: Column) -> Column:
    """Without white space of any script at the ends, no-break spaces included."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def present(c: Column) -> Column:
    """Null for null and for the empty string."""
    return F.nullif(c, F.lit(""))
