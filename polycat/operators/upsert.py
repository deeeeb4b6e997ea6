"""Rows written over rows with the same key, with a rule for each column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from polycat.functions.collation import present

# Rules for a column where a key is in both tables.
NEW, OLD, NEW_OR_OLD, OLD_OR_NEW = "new", "old", "new or old", "old or new"


def upsert(old: DataFrame, new: DataFrame, keys: list[str], rules: dict[str, str] | None = None) -> DataFrame:
    """old with new's rows: unknown keys come in, known ones change by each column's rule (NEW if not named).

    new may hold a key once only. One shuffle join on the key, or a broadcast of the smaller table as Catalyst finds it.
    """
    rules = rules or {}
    has_new, has_old = F.col("n._new").isNotNull(), F.col("o._old").isNotNull()

    def value(c: str) -> Column:
        a, b = F.col(f"o.{c}"), F.col(f"n.{c}")
        if c in keys:
            return F.when(has_old, a).otherwise(b).alias(c)
        rule = rules.get(c, NEW)
        known = {NEW: b, OLD: a, NEW_OR_OLD: F.coalesce(b, a), OLD_OR_NEW: F.coalesce(a, b)}[rule]
        return F.when(has_new & has_old, known).when(has_new, b).otherwise(a).alias(c)

    o, n = old.withColumn("_old", F.lit(True)).alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
    both = o.join(n, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys], "full_outer")
    return both.select([value(c) for c in old.columns])


def insert_only(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old and those rows of new whose key it lacks; first come, first kept."""
    return old.unionByName(new.join(old.select(keys), keys, "left_anti").select(old.columns))


def add_labels(labels: DataFrame, new: DataFrame) -> DataFrame:
    """Labels (code, locale, label) with those of new (.., pos) whose code has none in the locale; the first by pos counts."""
    return insert_only(labels, new.groupBy("code", "locale").agg(F.min_by("label", "pos").alias("label")), ["code", "locale"])


def set_labels(labels: DataFrame, new: DataFrame) -> DataFrame:
    """Labels with those of new (.., pos) over them; the last by pos counts."""
    return upsert(labels, new.groupBy("code", "locale").agg(F.max_by("label", "pos").alias("label")), ["code", "locale"])


def manufacturers(old: DataFrame, new: DataFrame, update_name: bool) -> DataFrame:
    return upsert(old, new, ["id"], {"name": NEW if update_name else OLD, "logo_path": NEW_OR_OLD, "country_id": NEW_OR_OLD})


def cars(old: DataFrame, new: DataFrame, update_texts: bool) -> DataFrame:
    """Maker and codes always change; texts, class, points, year and payload only if asked."""
    kept = ["name", "intro", "detail", "car_class", "pp", "year", "raw_json"]
    return upsert(old, new, ["id"], {} if update_texts else dict.fromkeys(kept, OLD))


def codes(codes_: DataFrame, labels: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Code and label tables after new (code, locale, label, default_name); the default name is the code's if not given."""
    named = new.groupBy("code").agg(F.max_by("default_name", "locale").alias("default_name")).withColumn("default_name", F.coalesce("default_name", "code"))
    return upsert(codes_, named, ["code"]), upsert(labels, new.select("code", "locale", "label"), ["code", "locale"])


def replace_specs(old: DataFrame, new: DataFrame, cars_: DataFrame) -> DataFrame:
    """old with the specs of cars_ (car_id, locale) replaced by new; a car without any new row loses those of every locale."""
    empty = cars_.join(new.select("car_id", "locale").distinct(), ["car_id", "locale"], "left_anti").select("car_id").distinct()
    kept = old.join(cars_.select("car_id", "locale"), ["car_id", "locale"], "left_anti").join(empty, "car_id", "left_anti")
    return kept.select(old.columns).unionByName(new.join(empty, "car_id", "left_anti").select(old.columns))


def replace_images(old: DataFrame, new: DataFrame, cars_: DataFrame) -> DataFrame:
    return old.join(cars_.select("car_id"), "car_id", "left_anti").select(old.columns).unionByName(new.select(old.columns))


def image_rows(old: DataFrame, new: DataFrame, protected: tuple[str, ...] = ("hero", "thumb")) -> DataFrame:
    """For each car and kind of image either the old or the new rows.

    Protected kinds keep the old rows if there are fewer new ones; others take the new rows if there are any. Kinds are
    compared in lower case, none is 'unknown'. Rows come as (car_id, image_path, image_type, sort_order, position).
    """
    kind = F.coalesce(present(F.lower(F.trim("image_type"))), F.lit("unknown"))
    rows = old.select("car_id", "image_path", kind.alias("image_type"), "sort_order", F.lit(0).alias("_new")).unionByName(new.select("car_id", "image_path", kind.alias("image_type"), "sort_order", F.lit(1).alias("_new")))
    group = Window.partitionBy("car_id", "image_type")
    n_old, n_new = F.sum(1 - F.col("_new")).over(group), F.sum("_new").over(group)
    take_new = F.when(F.col("image_type").isin(*protected), n_new >= n_old).otherwise(n_new > 0)
    rank = F.when(F.col("image_type") == "hero", 0).when(F.col("image_type") == "thumb", 1).otherwise(2)
    kept = rows.withColumn("_take", take_new).where((F.col("_new") == 1) == F.col("_take"))
    order = Window.partitionBy("car_id").orderBy(rank, "image_type", F.col("sort_order").asc_nulls_last(), "image_path")
    return kept.select("car_id", "image_path", "image_type", "sort_order", F.row_number().over(order).alias("position"))
