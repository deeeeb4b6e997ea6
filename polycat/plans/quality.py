"""Completeness of images, references between tables, pending work."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from polycat import schema
from polycat.sources.files import write_report
from polycat.sources.lake import Lake, Refused
from polycat.sources.shared import tasks


def hero_counts(images: DataFrame) -> DataFrame:
    return images.where(F.col("image_type") == "hero").groupBy("car_id").agg(F.count(F.lit(1)).alias("actual"))


def hero_differences(cars: DataFrame, images: DataFrame, manifest: DataFrame, least: int) -> DataFrame:
    """car_id, expected, actual, reason: cars whose hero images are not as many as the manifest (car_id, expected) says, or fewer than least where it says nothing."""
    out = cars.select(F.col("id").alias("car_id")).join(manifest, "car_id", "left").join(hero_counts(images), "car_id", "left").withColumn("actual", F.coalesce("actual", F.lit(0)).cast("long"))
    reason = F.when(F.col("expected").isNotNull() & (F.col("actual") != F.col("expected")), "mismatch_with_reference").when(F.col("expected").isNull() & (F.col("actual") < least), "below_min_without_reference")
    text = F.coalesce(F.col("expected").cast("string"), F.lit(f">={least}"))
    return out.select("car_id", text.alias("expected"), F.col("expected").alias("expected_count"), "actual", reason.alias("reason")).where("reason is not null")


def outcome(mode: str, checked: int, mismatches: int, max_count: int = 20, max_ratio: float = 0.05) -> bool:
    """Whether a check passes: strict allows no mismatch, soft fails if count and ratio are both above their limits, off always passes."""
    if mode == "off":
        return True
    if mode == "strict":
        return mismatches == 0
    if mode == "soft":
        return not (mismatches > max_count and mismatches / max(1, checked) > max_ratio)
    raise ValueError(f"unknown mode {mode}")


def check_heroes(lakes: dict[str, Lake], manifest: DataFrame, least: int = 1, mode: str = "soft", report: str | None = None, max_count: int = 20, max_ratio: float = 0.05) -> int:
    """Checks datasets (by name) against a manifest and writes the differences as a report: 0 if all is well, 3 for a strict and 4 for a soft failure. An empty manifest raises."""
    if mode == "off":
        return 0
    if not manifest.limit(1).count():
        raise ValueError("the manifest is empty")
    parts = [hero_differences(x.table("cars"), x.get("car_images"), manifest, least).select(F.lit(name).alias("dataset"), "*") for name, x in lakes.items()]
    wrong = reduce(DataFrame.unionByName, parts)
    if report:
        write_report(wrong, report)
    checked = sum(x.table("cars").count() for x in lakes.values())
    return 0 if outcome(mode, checked, wrong.count(), max_count, max_ratio) else {"strict": 3, "soft": 4}[mode]


def load_images(lake: Lake, images: DataFrame, manifest: DataFrame, least: int = 1, mode: str = "soft", max_count: int = 20, max_ratio: float = 0.05) -> int:
    """Replaces a dataset's images by images (car_id, image_path, sort_order, image_type, with or without id) unless they fail the checks: 0, or 3 for a strict and 4 for a soft refusal, which leaves the old images.

    Differences from the manifest, as in hero_differences(), and images of no car are counted by the write itself: images,
    cars and manifest are one table, dealt by car to as many tasks as there are rows for and sorted once, and a car's
    difference is marked on one of its rows. A car or an expected number that is there twice counts once (of numbers the largest), and
    a row without id is no car. Images of no car are
    refused in every mode but off, where they are written.
    """
    parts = [
        images.select("car_id", "image_path", "sort_order", "image_type", F.lit(True).alias("_image"), F.lit(None).cast("boolean").alias("_car"), F.lit(None).cast("long").alias("_expected")),
        *[
            df.where(f"{key} is not null").select(F.col(key).alias("car_id"), *[F.lit(None).cast(images.schema[c].dataType).alias(c) for c in ("image_path", "sort_order", "image_type")], F.lit(None).cast("boolean").alias("_image"), car.alias("_car"), expected.cast("long").alias("_expected"))
            for df, key, car, expected in ((lake.table("cars"), "id", F.lit(True), F.lit(None)), (manifest, "car_id", F.lit(None).cast("boolean"), F.col("expected")))
        ],
    ]
    n = tasks(lake.spark, sum(df.count() for df in parts))
    of_car = Window.partitionBy("car_id")
    rows = reduce(DataFrame.unionByName, parts).repartition(n, "car_id")
    rows = rows.withColumn("_first", (F.row_number().over(of_car.orderBy(F.col("_car").desc_nulls_last(), "sort_order", "image_path")) == 1) & F.col("_car").isNotNull())
    rows = rows.withColumns({"_car": F.max("_car").over(of_car), "_expected": F.max("_expected").over(of_car), "_actual": F.count(F.when(F.col("image_type") == "hero", True)).over(of_car)})
    wrong = F.coalesce(F.col("_expected") != F.col("_actual"), F.col("_actual") < least)
    rows = rows.select(F.monotonically_increasing_id().alias("id"), "car_id", "image_path", "sort_order", "image_type", "_image", "_car", "_actual", "_expected", "_first")
    checks = {"checked": F.when(F.col("_first"), True), "mismatches": F.when(F.col("_first") & wrong, True), "orphans": F.when(F.col("_image") & F.col("_car").isNull(), True)}
    fine = lambda n: mode == "off" or (not n["orphans"] and outcome(mode, n["checked"], n["mismatches"], max_count, max_ratio))
    try:
        lake.write("car_images", rows, checks, fine, F.col("_image").isNotNull())
    except Refused:
        return {"strict": 3, "soft": 4}[mode]
    return 0


def orphans(lake: Lake) -> DataFrame:
    """table, column, value, rows: references to nothing."""
    out = lake.spark.createDataFrame([], "table string, column string, value string, rows long")
    for (t, c), (to, key) in schema.REFERENCES.items():
        if lake.has_table(t):
            lost = lake.table(t).where(F.col(c).isNotNull()).select(F.col(c).alias("value")).join(lake.get(to).select(F.col(key).alias("value")), "value", "left_anti")
            out = out.union(lost.groupBy("value").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t), F.lit(c), "value", "rows"))
    return out


def latest_status(log: DataFrame) -> DataFrame:
    """The last status of each car and locale: one aggregate, no look-up for each car."""
    return log.groupBy("car_id", "locale").agg(F.max_by("status", "id").alias("status"))


def pending(ids: DataFrame, log: DataFrame, locale: str) -> DataFrame:
    """ids (id, ...) whose last status in the locale isn't success."""
    done = latest_status(log.where(F.col("locale") == locale)).where("status = 'success'").select(F.col("car_id").alias("id"))
    return ids.join(done, "id", "left_anti")


def examples(cars: DataFrame) -> DataFrame:
    """The smallest id, as text, of each maker."""
    return cars.where("manufacturer_id is not null").groupBy("manufacturer_id").agg(F.min("id").alias("id"))
