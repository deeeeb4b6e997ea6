"""A dataset: a database of Spark's catalog at a path, with a Parquet table for each of its tables."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polycat import schema
from polycat.sources.shared import delete, filesystem


class Refused(ValueError):
    """A write whose checks failed; the table is as it was."""


class Lake:
    """Tables under a path that Spark can read and write, each in a folder of its name; tables with a locale are partitioned by it.

    Folders are registered as external tables with the columns of all their files, so that files of an older and a newer
    shape are read together, and columns that a file lacks are null. A session whose catalog doesn't know a dataset yet finds it by its folders.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.database = f"dataset_{hashlib.sha1(self.path.encode()).hexdigest()[:16]}"

    def at(self, table: str) -> str:
        return f"{self.path}/{table}"

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self) -> bool:
        fs, p = filesystem(self.spark, self.path)
        return fs.exists(p)

    def has_table(self, table: str) -> bool:
        fs, p = filesystem(self.spark, self.at(table))
        return fs.exists(p)

    def has_column(self, table: str, column: str) -> bool:
        return self.has_table(table) and column in self.table(table).columns

    def _by_locale(self, table: str, fields: T.StructType) -> bool:
        return table in schema.BY_LOCALE and "locale" in fields.names

    def _found(self, table: str) -> T.StructType:
        """The columns of all files of a table; of an empty one those that its kind has."""
        fs, p = filesystem(self.spark, self.at(table))
        if not any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p)):
            return schema.struct(table)
        found = self.spark.read.option("mergeSchema", "true").parquet(self.at(table)).schema
        return T.StructType([T.StructField("locale", T.StringType()) if f.name == "locale" else f for f in found])

    def _register(self, table: str, fields: T.StructType, parts: bool | None = None) -> None:
        """Tells the catalog of a table's folder, in place of what it knew."""
        parts = self._by_locale(table, fields) if parts is None else parts
        if not self.spark.catalog.databaseExists(self.database):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")  # its own folder stays empty: dropping it must not touch the tables
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        self.spark.sql(f"CREATE TABLE {self.name(table)} ({columns}) USING parquet {'PARTITIONED BY (locale)' if parts else ''} LOCATION '{self.at(table)}'")
        if parts:
            self.spark.sql(f"MSCK REPAIR TABLE {self.name(table)}")

    def table(self, table: str) -> DataFrame:
        """A table as it is now; raises if the dataset or the table isn't there."""
        if not self.has_table(table):
            raise FileNotFoundError(f"no table {table} in {self.path}")
        if not self.spark.catalog.tableExists(self.name(table)):
            fields = self._found(table)
            fs, p = filesystem(self.spark, self.at(table))
            parts = any(s.getPath().getName().startswith("locale=") for s in fs.listStatus(p))
            self._register(table, fields, parts or (self._by_locale(table, fields) and fields == schema.struct(table) and not self._has_files(table)))
        return self.spark.table(self.name(table))

    def _has_files(self, table: str) -> bool:
        fs, p = filesystem(self.spark, self.at(table))
        return any(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(p))

    def get(self, table: str) -> DataFrame:
        """A table, or an empty one of its type."""
        return self.table(table) if self.has_table(table) else self.spark.createDataFrame([], schema.struct(table))

    def write(self, table: str, df: DataFrame, checks: dict[str, Column] | None = None, accept: Callable[[dict[str, int]], bool] | None = None, keep: Column | None = None) -> dict[str, int]:
        """Replaces a table by df, which may be computed from the table itself.

        df is written beside the table and moved to its place when all of it is there, so that a failed write changes
        nothing. checks are columns whose non-null rows are counted by the write itself, without a second pass; rows that keep
        does not take are counted, but not written. If accept (default: none may be found) is not true of the counts, the write is
        refused and the table stays as it was. Returns the counts.
        """
        beside = f"{self.path}/_beside/{table}-{uuid.uuid4().hex}"
        counts: dict[str, int] = {}
        if checks:
            columns = [c for c in df.columns if not c.startswith("_")]
            seen = Observation()
            df = df.observe(seen, *[F.count(c).alias(n) for n, c in checks.items()])
            df = (df if keep is None else df.where(keep)).select(columns)
        (df.write.partitionBy("locale") if self._by_locale(table, df.schema) else df.write).parquet(beside)
        if checks:
            counts = dict(seen.get)
            if not (accept or (lambda n: not any(n.values())))(counts):
                delete(self.spark, beside)
                raise Refused(f"{table}: {', '.join(f'{n} {c}' for c, n in counts.items())}", counts)
        self._move(beside, self.at(table))
        self._register(table, df.schema)
        return counts

    def _move(self, source: str, target: str) -> None:
        fs, p = filesystem(self.spark, target)
        _, s = filesystem(self.spark, source)
        _, old = filesystem(self.spark, f"{source}-before")
        had = fs.exists(p)
        if had:
            fs.rename(p, old)
        else:
            fs.mkdirs(p.getParent())
        if not fs.rename(s, p):
            if had:
                fs.rename(old, p)
            raise OSError(f"{source} could not be moved to {target}")
        if had:
            fs.delete(old, True)

    def write_locale(self, table: str, df: DataFrame, locale: str) -> None:
        """Replaces a table's rows of a locale by those of df; the files of other locales are neither read nor touched.

        df may be computed from the table itself: partitions are staged by Spark and change place when all rows are written.
        """
        fields = self.table(table).schema
        before = [c for c in df.columns if c not in fields.names]
        seen = Observation()
        rows = df.where(F.col("locale") == locale).observe(seen, F.count(F.lit(1)).alias("n"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("locale").parquet(self.at(table))
        if not seen.get["n"]:
            self.drop_locales(table, lambda x: x != locale)
        self._register(table, T.StructType([*fields, *[df.schema[c] for c in before]]))

    def drop_locales(self, table: str, keep: Callable[[str], bool]) -> None:
        """Deletes the rows of all locales that keep does not take, by their folders; no row is read."""
        fields = self.table(table).schema
        fs, p = filesystem(self.spark, self.at(table))
        for s in fs.listStatus(p):
            folder = s.getPath().getName()
            if folder.startswith("locale=") and not keep(folder.removeprefix("locale=")):
                fs.delete(s.getPath(), True)
        self._register(table, fields)

    def append(self, table: str, df: DataFrame) -> None:
        """Adds rows; what was written before is not read. Rows may have columns that the table lacks, and lack some of its."""
        fields = self.table(table).schema
        out = df.write.mode("append")
        (out.partitionBy("locale") if self._by_locale(table, df.schema) else out).parquet(self.at(table))
        self._register(table, T.StructType([*fields, *[f for f in df.schema if f.name not in fields.names]]))

    def get_meta(self, key: str) -> str | None:
        row = self.get("meta").where(F.col("key") == key).select("value").first()
        return row[0] if row else None

    def set_meta(self, **values: str | None) -> None:
        """Sets values of the dataset's own table of facts; the last one set counts."""
        said = self.spark.createDataFrame(list(values.items()), schema.struct("meta"))
        self.write("meta", self.get("meta").where(~F.col("key").isin(list(values))).select("key", "value").unionByName(said).coalesce(1))

    def create(self, images: bool = False) -> Lake:
        """Makes the tables that aren't there yet, empty; adds columns that an older dataset lacks.

        A new column is one more file without rows, beside which the older ones are read as before. Only where the locale
        is missing, by which rows are laid out, is the table written again, with the default locale.
        """
        for table in schema.TABLES:
            if table in schema.OPTIONAL and not images:
                continue
            if not self.has_table(table):
                self.write(table, self.get(table))
                continue
            df = self.table(table)
            missing = [f for f in schema.struct(table) if f.name not in df.columns]
            if "locale" in [f.name for f in missing]:
                self.write(table, df.select("*", *[F.lit(schema.DEFAULT_LOCALE if f.name == "locale" else None).cast(f.dataType).alias(f.name) for f in missing]))
            elif missing:
                self.append(table, self.spark.createDataFrame([], T.StructType([*df.schema, *missing])))
                if self._by_locale(table, df.schema):  # no partition, no file: the catalog alone knows the column till rows have it
                    self._register(table, T.StructType([*df.schema, *missing]))
        return self

    def copy_to(self, path: str) -> Lake:
        """A copy of all tables at another path."""
        other = Lake(self.spark, path)
        for table in schema.TABLES:
            if self.has_table(table):
                other.write(table, self.table(table))
        return other

    def tables(self) -> dict[str, DataFrame]:
        return {t: self.table(t) for t in schema.TABLES if self.has_table(t)}


def locales_of(spark: SparkSession, folder: str) -> list[str]:
    """Locales with a dataset of their own under folder (locale=<x>), sorted."""
    fs, p = filesystem(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n.removeprefix("locale=") for n in names if n.startswith("locale=") and n.removeprefix("locale=").replace("_", "").isalnum())


def scan_all(spark: SparkSession, folder: str, table: str, datasets: list[str]) -> DataFrame:
    """A table of many datasets under folder as one scan, with _dataset (whose it is) and, if it has one, its own locale, both from the files' paths. Datasets without the table have no rows."""
    fields = schema.struct(table)
    paths = [f"{folder}/locale={x}/{table}" for x in datasets]
    paths = [p for p in paths if (fs := filesystem(spark, p))[0].exists(fs[1])]
    if not paths:
        return spark.createDataFrame([], T.StructType([*fields, T.StructField("_dataset", T.StringType())]))
    inside = T.StructType([f for f in fields if f.name != "locale"])
    rows = spark.read.schema(inside).option("recursiveFileLookup", "true").parquet(*paths)
    path = F.col("_metadata.file_path")
    out = rows.withColumn("_dataset", F.regexp_extract(path, rf"/locale=([^/]+)/{table}/", 1))
    if "locale" in fields.names:
        out = out.withColumn("locale", F.regexp_extract(path, r"/locale=([^/]+)/[^/]+$", 1))
    return out.select(*fields.names, "_dataset")
