"""Numbers in localized text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from polycat.functions.collation import strip


def parse_number(c: Column) -> Column:
    """The number that a text begins with, or null.

    No-break and plain spaces are left out. With both separators present and the last comma after the last point, points
    group and the comma is decimal; else commas group.
    """
    bare = F.regexp_replace(strip(c), "[\u00a0 ]", "")
    comma, point = F.locate(",", F.reverse(bare)), F.locate(".", F.reverse(bare))
    european = (comma > 0) & (point > 0) & (comma < point)
    plain = F.when(european, F.replace(F.replace(bare, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(F.replace(bare, F.lit(","), F.lit("")))
    return F.nullif(F.regexp_extract(plain, r"^-?[0-9]+(\.[0-9]+)?", 0), F.lit("")).try_cast("double")


def spec_value(raw: Column) -> Column:
    """Struct (value, unit): leading digits with separators, plain spaces left out, and the rest; text without digits is all value; null is two empty strings."""
    text = strip(raw)
    pattern = r"(?Us)^([0-9][0-9.,\s]*)\s*(.*)$"
    hit = text.rlike("^[0-9]")
    value = F.when(hit, F.replace(F.regexp_extract(text, pattern, 1), F.lit(" "), F.lit(""))).otherwise(text)
    unit = F.when(hit, strip(F.regexp_extract(text, pattern, 2))).otherwise("")
    return F.struct(F.coalesce(value, F.lit("")).alias("value"), F.coalesce(unit, F.lit("")).alias("unit"))
