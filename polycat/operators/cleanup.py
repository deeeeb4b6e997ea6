"""Pruning, whitelists, repairs and back-filling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polycat import schema
from polycat.functions.collation import present

PRUNED = ["car_texts", "manufacturer_i18n", "aspiration_i18n", "drivetrain_i18n", "spec_code_i18n", "country_i18n", "car_specs", "fetch_log"]


def only_locale(df: DataFrame, locale: str) -> DataFrame:
    return df.where(F.col("locale") == locale)


def prune(lake, locale: str) -> None:
    """Leaves a dataset's localized tables with one locale: the folders of others go, no row is read or written."""
    for t in PRUNED:
        if lake.has_table(t):
            lake.drop_locales(t, lambda x: x == locale)


def whitelisted(df: DataFrame, codes: list[str], column: str = "code") -> DataFrame:
    """Without rows whose code is not in the list or '---'; rows without a code stay, as a comparison with nothing is unknown."""
    c = F.col(column)
    return df.where(c.isNull() | (c.isin(codes) & (c != "---")))


def clean_codes(lake) -> None:
    for kind, codes in (("aspiration", schema.ASPIRATION_CODES), ("drivetrain", schema.DRIVETRAIN_CODES)):
        for t in (f"{kind}_codes", f"{kind}_i18n"):
            lake.write(t, whitelisted(lake.get(t), codes))


def without_raw_labels(df: DataFrame, locale: str) -> DataFrame:
    """Without a locale's codes like raw_%, where _ is any character and A-Z count as a-z."""
    return df.where(~((F.col("locale") == locale) & F.coalesce(F.col("code").ilike("raw_%"), F.lit(False))))


def manufacturer_names(manufacturers: DataFrame, names: DataFrame, locale: str) -> DataFrame:
    """Canonical names as the locale has them, where it has them."""
    local = names.where(F.col("locale") == locale).select("id", F.col("name").alias("_name"))
    return manufacturers.join(local, "id", "left").withColumn("name", F.coalesce("_name", "name")).select(manufacturers.columns)


def country_of_payload(raw) -> F.Column:
    """countryId of a JSON payload; null if it is malformed, no object, or empty."""
    return present(F.get_json_object(raw, "$.countryId"))


def backfill_countries(manufacturers: DataFrame, cars: DataFrame) -> DataFrame:
    """Each maker's country as its first car (by id) with one says, over what it had; others keep theirs."""
    said = cars.withColumn("_c", country_of_payload(F.col("raw_json"))).where("_c is not null and manufacturer_id is not null")
    first = said.groupBy(F.col("manufacturer_id").alias("id")).agg(F.min_by("_c", "id").alias("_country"))
    return manufacturers.join(first, "id", "left").withColumn("country_id", F.coalesce("_country", "country_id")).select(manufacturers.columns)


def country_names(names: DataFrame, locale: str | None, fallback: str = "gb") -> DataFrame:
    """(iso3, locale, name): all of names, or one row for each country under the locale, the fallback's name where it has none."""
    if locale is None:
        return names
    own = names.where(F.col("locale") == locale).select("iso3", F.col("name").alias("_own"))
    other = names.where(F.col("locale") == fallback).select("iso3", F.col("name").alias("_other"))
    both = own.join(other, "iso3", "full_outer")
    return both.select("iso3", F.lit(locale).alias("locale"), F.coalesce(present(F.col("_own")), present(F.col("_other"))).alias("name")).where("name is not null")


def jpe_paths(df: DataFrame, column: str) -> DataFrame:
    """Paths that end in .jpe, in any case, with .jpg instead."""
    c = F.col(column)
    return df.withColumn(column, F.when(F.lower(c).endswith(".jpe"), F.concat(F.expr(f"substr(`{column}`, 1, length(`{column}`) - 4)"), F.lit(".jpg"))).otherwise(c))


def fix_paths(lake) -> int:
    """Repairs the image paths of a dataset that end in .jpe; how many did."""
    if not lake.has_table("car_images"):
        return 0
    wrong = lake.table("car_images").where(F.lower("image_path").endswith(".jpe")).count()
    if wrong:
        lake.write("car_images", jpe_paths(lake.table("car_images"), "image_path"))
    return wrong


def fix_files(spark, folder: str) -> int:
    """Renames the files below a folder that end in .jpe to .jpg, unless such a file is there already; how many there were. Names are listed and renamed in tasks."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path").where(F.lower("path").endswith(".jpe"))

    def rename(batches):
        from urllib.parse import unquote

        import pandas as pd
        from pyarrow import fs

        for b in batches:
            for p in b["path"]:
                store, at = fs.FileSystem.from_uri(p if "://" in p else p.replace("file:", "file://", 1))
                at = unquote(at)
                if store.get_file_info(f"{at[:-4]}.jpg").type == fs.FileType.NotFound:
                    store.move(at, f"{at[:-4]}.jpg")
            yield pd.DataFrame({"n": [len(b)]})

    return found.mapInPandas(rename, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def drop_empty_columns(lake) -> list[str]:
    """Drops what older datasets have beside the columns of today: an empty description of cars or texts (one with values stays), and the country of cars. Names the tables that were written again."""
    done = []
    for table in ("cars", "car_texts"):
        if lake.has_table(table):
            old = lake.table(table)
            new = drop_if_empty(old, "description")
            if table == "cars" and "country" in new.columns:
                new = new.drop("country")
            if new.columns != old.columns:
                lake.write(table, new)
                done.append(table)
    return done


def drop_if_empty(df: DataFrame, column: str) -> DataFrame:
    """Without a column that holds nothing but nulls and empty strings."""
    if column not in df.columns:
        return df
    return df.drop(column) if not df.where(present(F.col(column)).isNotNull()).limit(1).count() else df


def combined_label(labels: DataFrame) -> DataFrame:
    """For each locale with labels of both, the row of TC+SC."""
    side = lambda code, c: labels.where(F.col("code") == code).select("locale", present(F.col("label")).alias(c)).where(F.col(c).isNotNull())
    both = side("TC", "_t").join(side("SC", "_s"), "locale")
    return both.select(F.lit("TC+SC").alias("code"), "locale", F.concat_ws(" + ", "_t", "_s").alias("label"))
