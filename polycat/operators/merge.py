"""Datasets of one locale each into one."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from polycat import schema
from polycat.functions.text import locale_order
from polycat.sources.lake import Lake, locales_of, scan_all

FIRST_WINS = ["manufacturers", "manufacturer_i18n", "aspiration_codes", "drivetrain_codes", "cars"]
BY_LOCALE = ["aspiration_i18n", "drivetrain_i18n", "spec_code_i18n", "country_i18n", "car_texts", "car_specs"]


def first_wins(sources: list[DataFrame], keys: list[str], not_null: list[str] = ()) -> DataFrame:
    """One row for each key: that of the first source that has it. Rows that lack a needed value don't count.

    The sources are tagged and unioned, so that all of them are read once and meet in one shuffle on the key, however
    many there are.
    """
    tagged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [s.withColumn("_from", F.lit(i)) for i, s in enumerate(sources)])
    return _first(tagged, sources[0].columns, keys, not_null)


def _first(tagged: DataFrame, columns: list[str], keys: list[str], not_null: list[str] = ()) -> DataFrame:
    """One row for each key of rows with _from: one of the smallest _from."""
    for c in not_null:
        tagged = tagged.where(F.col(c).isNotNull())
    order = Window.partitionBy(*keys).orderBy("_from", *[c for c in columns if c not in keys])
    return tagged.withColumn("_r", F.row_number().over(order)).where("_r = 1").select(columns)


def replace_locale(target: DataFrame, source: DataFrame, locale: str) -> DataFrame:
    """target with its rows of a locale replaced by source's."""
    return target.where(F.col("locale") != locale).unionByName(source.where(F.col("locale") == locale).select(target.columns))


def merged_images(sources: list[DataFrame]) -> DataFrame:
    """Images of all sources, each source's only if no source before it has them; no kind and an empty kind are the same, repeats within a source all count. The sources are tagged and meet in one shuffle, however many there are."""
    columns = sources[0].columns
    tagged = reduce(DataFrame.unionByName, [s.select(*columns, F.lit(i).alias("_from")) for i, s in enumerate(sources)])
    return _first_images(tagged).select(columns)


def _first_images(tagged: DataFrame) -> DataFrame:
    first = F.min("_from").over(Window.partitionBy("car_id", "image_path", F.coalesce("image_type", F.lit(""))))
    return tagged.withColumn("_first", first).where("_from = _first")


def new_images(target: DataFrame, source: DataFrame) -> DataFrame:
    """target and those images of source that it lacks."""
    return merged_images([target, source])


def merge_locale(target: Lake, source: Lake, locale: str, logs: bool = False) -> None:
    """A locale's dataset into another, in place.

    Rows of the first-wins tables whose key the target lacks are appended, the locale's partitions of the localized
    tables (with logs, of the log too) are replaced, and images that the target lacks are appended if both have images. Files
    of other locales, and those that rows are appended beside, are not written again.
    """
    for t in FIRST_WINS:
        target.append(t, first_wins([source.get(t)], schema.KEYS[t], schema.NOT_NULL.get(t, ())).join(target.table(t).select(schema.KEYS[t]), schema.KEYS[t], "left_anti"))
    for t in [*BY_LOCALE, *(["fetch_log"] if logs else [])]:
        target.write_locale(t, source.get(t), locale)
    if target.has_table("car_images") and source.has_table("car_images"):
        kind = F.coalesce("image_type", F.lit("")).alias("_kind")
        had = target.table("car_images").select("car_id", "image_path", kind)
        new = source.table("car_images").select("*", kind).join(had, ["car_id", "image_path", "_kind"], "left_anti")
        target.append("car_images", new.select(target.table("car_images").columns))


def merge(folder: str, out: str, spark, locales: list[str] | None = None, base: str | None = None, images: bool | None = None, logs: bool = False) -> Lake:
    """One dataset from folder/locale=<x>; the base locale's canonical rows count first, then the others' in their order.

    Localized rows are each dataset's own, and the base's for locales that are not merged. Images are merged if the base has some, unless
    images says otherwise; the base's other tables stay as they are. Each table of all datasets is one scan, with rows
    ranked by the dataset that their path names. Raises if no dataset is there, the base or a named locale has none, or
    out is there already.
    """
    found = locales_of(spark, folder)
    wanted = locale_order(locales or found)
    if not wanted:
        raise ValueError(f"no datasets in {folder}")
    if missing := [x for x in wanted if x not in found]:
        raise ValueError(f"no dataset for {', '.join(missing)}")
    base = base or wanted[0]
    if base not in wanted:
        raise ValueError(f"base locale {base} is not among {', '.join(wanted)}")
    if Lake(spark, out).has_table("cars"):
        raise ValueError(f"{out} is there already")
    wanted = locale_order(wanted, base)
    first, target = Lake(spark, f"{folder}/locale={base}"), Lake(spark, out)
    rank = F.element_at(F.create_map(*[F.lit(v) for i, x in enumerate(wanted) for v in (x, i)]), F.col("_dataset"))
    every = lambda t: scan_all(spark, folder, t, wanted)
    own = (F.col("_dataset") == F.col("locale")) | ((F.col("_dataset") == base) & ~F.col("locale").isin(wanted))
    for t in FIRST_WINS:
        target.write(t, _first(every(t).withColumn("_from", rank), list(schema.struct(t).names), schema.KEYS[t], schema.NOT_NULL.get(t, ())))
    for t in BY_LOCALE:
        target.write(t, every(t).where(own).drop("_dataset"))
    target.write("country_iso_map", first.get("country_iso_map"))
    target.write("fetch_log", every("fetch_log").where(own).drop("_dataset") if logs else first.get("fetch_log"))
    if first.has_table("car_images") if images is None else images:
        target.write("car_images", _first_images(every("car_images").withColumn("_from", rank)).select(schema.struct("car_images").names))
    target.write("meta", first.get("meta"))
    target.set_meta(build_base_locale=base, build_locales=json.dumps(wanted))
    return target
