"""Specification rows: codes from labels or units, values, units, and numbering."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from polycat.functions.codes import DRIVETRAINS, any_in
from polycat.functions.collation import strip
from polycat.functions.numbers import spec_value

# Units by which a value's code is inferred, and spellings of revolutions per minute.
POWER = ["hp", "ps", "bhp", "kw", "ch", "cv", "pk", "k.s.", "ks", "к.с", "л.с", "마력", "แรงม้า"]
TORQUE = ["nm", "n·m", "n.m", "нм", "kgm", "kgfm", "kgf·m", "kgf-m", "ft-lb", "lb-ft", "公斤力米"]
WEIGHT = ["kg", "公斤", "lbs", "lb", "кг"]
DISPLACEMENT = ["cc", "cm³", "cm3", "立方厘米", "см³"]
LENGTH = ["mm", "㎜", "мм", "公釐", "毫米", "in", "inch", "in.", "มม", "مم"]
PER_MINUTE = ["rpm", "r/min", "u/min", "tr/min", "g/min", "ob/min"]
PER_MINUTE_AS_IS = ["об/мин", "转每分", "轉每分", "รอบ/นาที"]
SPLITS = ["rpm", "r/min", "u/min", "tr/min", "g/min", "ob/min", "об/мин", "ot/min", "转每分", "轉每分", "รอบ/นาที", "รอบต่อนาที", "دورة في الدقيقة"]
SIDES = ["length", "width", "height"]
LENGTHS = "<length>"


def unit_text(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit(" "), F.lit(""))


def is_rpm(c: Column) -> Column:
    return any_in(F.lower(c), SPLITS)


def infer_code(raw: Column) -> Column:
    """The code that a value's form gives, null if none; LENGTHS for lengths, whose code depends on how many came before."""
    value = strip(raw)
    norm = unit_text(value)
    left = unit_text(F.substring_index(value, "/", 1))
    per_minute = value.contains("/") & (any_in(norm, PER_MINUTE) | any_in(value, PER_MINUTE_AS_IS))
    prefix = F.regexp_extract(value, "^([A-Z]{1,3})", 1)
    return (
        F.when(value.isin(DRIVETRAINS), "drivetrain")
        .when(prefix.isin("NA", "TC", "SC", "EV", "HV"), "aspiration")
        .when(any_in(norm, DISPLACEMENT), "displacement")
        .when(per_minute & any_in(left, POWER), "max_power")
        .when(per_minute & any_in(left, TORQUE), "max_torque")
        .when(any_in(norm, POWER), "max_power")
        .when(any_in(norm, TORQUE), "max_torque")
        .when(any_in(norm, WEIGHT), "weight")
        .when(any_in(norm, LENGTH), LENGTHS)
    )


def hashed_code(locale: Column, label: Column) -> Column:
    return F.concat(F.lit("raw_"), F.substring(F.sha1(F.concat(locale, F.lit(":"), label)), 1, 10))


def normalize_specs(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """car_id, locale, spec_key, spec_label, spec_value, spec_unit, spec_raw, sort_order.

    pairs: (car_id, locale, pos, label, raw), one row for each specification in its order; labels: (locale, label,
    code). A known label's code counts first, then what the value's form gives, then a hash of the label. The first three
    inferred lengths of a car are length, width and height. Power and torque with revolutions give two rows.
    """
    p = pairs.withColumn("_label", strip(F.col("label"))).withColumn("_raw", strip(F.coalesce("raw", F.lit("None"))))
    known = labels.groupBy("locale", F.col("label").alias("_label")).agg(F.min("code").alias("_known"))
    p = p.join(known, ["locale", "_label"], "left")
    p = p.withColumn("_inferred", F.when(F.col("_known").isNull() & F.col("raw").isNotNull(), infer_code(F.col("raw"))))
    nth = F.sum((F.coalesce("_inferred", F.lit("")) == LENGTHS).cast("int")).over(Window.partitionBy("car_id", "locale").orderBy("pos"))
    side = reduce(lambda out, i: out.when(nth == i + 1, SIDES[i]), range(1, len(SIDES)), F.when(nth == 1, SIDES[0])).otherwise("dimension")
    code = F.coalesce("_known", F.when(F.col("_inferred") == LENGTHS, side).otherwise(F.col("_inferred")), hashed_code(F.col("locale"), F.col("_label")))
    p = p.withColumn("_code", code)
    left, right = strip(F.substring_index("_raw", "/", 1)), strip(F.substring(F.col("_raw"), F.locate("/", F.col("_raw")) + 1, F.length("_raw")))
    row = lambda key, label, value, raw: F.struct(key.alias("spec_key"), label.alias("spec_label"), value["value"].alias("spec_value"), value["unit"].alias("spec_unit"), raw.alias("spec_raw"))
    split = F.col("_code").isin("max_power", "max_torque") & F.col("_raw").contains("/") & is_rpm(F.col("_raw")) & ((spec_value(left)["value"] != "") | (spec_value(right)["value"] != ""))
    rows = F.when(split, F.array(row(F.col("_code"), F.col("_label"), spec_value(left), left), row(F.concat("_code", F.lit("_rpm")), F.concat("_label", F.lit(" RPM")), spec_value(right), right))).otherwise(F.array(row(F.col("_code"), F.col("_label"), spec_value(F.col("raw")), F.col("_raw"))))
    out = p.select("car_id", "locale", "pos", F.posexplode(rows).alias("_part", "_row"))
    order = F.row_number().over(Window.partitionBy("car_id", "locale").orderBy("pos", "_part"))
    return out.select("car_id", "locale", "_row.*", order.alias("sort_order"))
