"""Dimension files, id lists, manifests and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _json(spark: SparkSession, path: str) -> DataFrame:
    """The file's text as one row; none if there is no such file."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], "value string")
    return spark.read.text(path, wholetext=True)


def string_map(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """Rows of a flat JSON object, values as strings; a missing file or another kind of JSON has none."""
    return _json(spark, path).select(F.explode(F.from_json("value", "map<string,string>")).alias(key, value))


def nested_map(spark: SparkSession, path: str, outer: str, inner: str, value: str) -> DataFrame:
    """Rows of a JSON object of objects; entries that are no objects are dropped."""
    entries = _json(spark, path).select(F.explode(F.from_json("value", "map<string,string>")).alias(outer, "_v"))
    return entries.where(F.ltrim("_v").startswith("{")).select(outer, F.explode(F.from_json("_v", "map<string,string>")).alias(inner, value))


def label_map(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """locale, label, code from one JSON file for each locale."""
    parts = [string_map(spark, p, "label", "code").select(F.lit(locale).alias("locale"), "label", "code") for locale, p in paths.items()]
    out = spark.createDataFrame([], "locale string, label string, code string")
    for p in parts:
        out = out.union(p)
    return out


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """pos, id: lines without white space at the ends, blank ones and those that begin with # left out."""
    text = spark.read.text(path, wholetext=True)
    lines = text.select(F.posexplode(F.split("value", "\r\n|\r|\n")).alias("pos", "id")).select("pos", F.regexp_replace("id", r"(?U)^\s+|\s+$", "").alias("id"))
    return lines.where("id != '' and not startswith(id, '#')")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """car_id, expected from {"counts": {...}} or a flat object, or from a folder of lines {"car_id": .., "n": ..}; values that are no whole numbers are left out."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(at) and fs.getFileStatus(at).isDirectory():
        lines = spark.read.text(path).select(F.from_json("value", "car_id string, n int").alias("_l"))
        return lines.select("_l.car_id", F.col("_l.n").alias("expected")).where("expected is not null and car_id is not null")
    text = _json(spark, path)
    body = F.coalesce(F.get_json_object("value", "$.counts"), F.col("value"))
    rows = text.select(F.explode(F.from_json(body, "map<string,string>")).alias("car_id", "_n"))
    return rows.select("car_id", F.expr("try_cast(_n as int)").alias("expected")).where("expected is not null")


def hero_files(spark: SparkSession, folder: str) -> DataFrame:
    """car_id, n: files with _hero_ in their name for each car's folder; only names are read."""
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    parts = paths.select(F.regexp_extract("path", r"([^/]+)/[^/]*_hero_[^/]*$", 1).alias("car_id"))
    return parts.where("car_id != ''").groupBy("car_id").agg(F.count(F.lit(1)).alias("n"))


def write_report(df: DataFrame, folder: str) -> None:
    """df as CSV with a header and as JSON lines."""
    df.write.csv(f"{folder}/csv", header=True)
    df.write.json(f"{folder}/json")


def write_ids(df: DataFrame, folder: str) -> None:
    """The first column as lines of text."""
    df.select(F.col(df.columns[0]).cast("string")).write.text(folder)
