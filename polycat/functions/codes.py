"""Years and codes from free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from polycat.functions.collation import present, strip

# Words that stand for an aspiration, looked for in this order.
NATURAL = ["自然", "naturally", "n/a", "na", "atmosfér", "atmosfer", "doğal", "dogal", "emişli", "ατμοσφαιρ", "سحب طبيعي", "ไม่ใช้ระบบอัดอากาศ"]
TURBO = ["涡轮", "渦輪", "turbo", "ターボ", "터보", "турбо"]
SUPER = ["机械", "機械", "supercharger", "スーパーチャージャ", "슈퍼차저", "kompresor", "kompresör"]
ELECTRIC = ["电", "電", "electric", "電気", "전기"]
# Drivetrain codes and their Chinese names.
DRIVETRAINS = ["FR", "FF", "MR", "RR", "4WD", "AWD"]
DRIVETRAIN_NAMES = {"前置后驱": "FR", "前置前驱": "FF", "中置后驱": "MR", "后置后驱": "RR", "四驱": "4WD"}


def any_in(c: Column, words: list[str]) -> Column:
    """Whether a text holds one of the words; one pattern, since a chain of tests repeats the text's expression in the generated code."""
    return c.rlike("|".join(rf"\Q{w}\E" for w in words))


def year_of(name: Column) -> Column:
    """A four-digit year from 1900 on, else an apostrophe's two digits: up to 29 in this century."""
    four = present(F.regexp_extract(name, r"(?U)\b(19\d{2}|20\d{2})\b", 1))
    two = present(F.regexp_extract(name, r"(?U)'(\d{2})\b", 1))
    return F.coalesce(four, F.when(two.try_cast("int") <= 29, F.concat(F.lit("20"), two)).otherwise(F.concat(F.lit("19"), two)))


def aspiration_label(raw: Column) -> Column:
    """What stands in parentheses, ASCII or full-width; else the text."""
    text = strip(present(raw))
    inner = strip(F.regexp_extract(text, r"(?U)[（(]\s*([^）)]+)\s*[）)]", 1))
    return F.coalesce(present(inner), text)


def aspiration_code(raw: Column) -> Column:
    text = strip(present(raw))
    clean = F.upper(F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("＋"), F.lit("+")))
    low = F.lower(text)
    out = F.when(text == "---", F.lit(None).cast("string")).when(clean.contains("TC+SC"), "TC+SC").when(clean.rlike(r"(?U)^T(\b|\+)"), "TC")
    for code in ("NA", "TC", "SC", "EV", "HV"):
        out = out.when(clean.startswith(code), code)
    for words, code in ((NATURAL, "NA"), (TURBO, "TC"), (SUPER, "SC"), (ELECTRIC, "EV")):
        out = out.when(any_in(low, words), code)
    return out


def drivetrain_code(raw: Column) -> Column:
    text = strip(present(raw))
    upper = F.replace(F.upper(text), F.lit(" "), F.lit(""))
    out = F.when(text == "---", F.lit(None).cast("string")).when(upper.isin(DRIVETRAINS), upper)
    for name, code in DRIVETRAIN_NAMES.items():
        out = out.when(text == name, code)
    return out
