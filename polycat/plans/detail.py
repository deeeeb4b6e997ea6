"""Everything about given cars, nested."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polycat import schema
from polycat.functions.collation import present
from polycat.operators.cleanup import country_of_payload
from polycat.plans.lists import country_labels, has_countries, of_locale
from polycat.sources.lake import Lake
from polycat.sources.shared import tasks


#: What a car's nested details are gathered from, and the column that holds the car.
BUCKETED = {"cars": "id", "car_texts": "car_id", "car_specs": "car_id", "car_images": "car_id"}


#: Ids in a table up to which rows are chosen first.
FEW = 100_000


class Bucketed:
    """A dataset whose large tables are also laid out in buckets by car, for details of many cars at once: texts, specifications and images then meet their cars without a shuffle.

    write() lays them out once, as tables of Spark's catalog under the dataset; localized ones in folders of locales too, so that
    only the locale asked for is read. They are a copy as of that time.
    """

    def __init__(self, lake: Lake, path: str, database: str):
        self.lake, self.spark, self.path, self.database = lake, lake.spark, path.rstrip("/"), database

    def write(self, buckets: int) -> Bucketed:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        for table, car in BUCKETED.items():
            if not self.lake.has_table(table):
                continue
            df = self.lake.table(table)
            # rows of a bucket come together first, so that a task writes one file for each bucket and locale
            out = df.repartition(buckets, car).write.format("parquet").mode("overwrite").bucketBy(buckets, car).sortBy(car).option("path", f"{self.path}/{table}")
            (out.partitionBy("locale") if "locale" in df.columns else out).saveAsTable(f"{self.database}.{table}")
        return self

    def has_table(self, table: str) -> bool:
        return self.lake.has_table(table)

    def table(self, table: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{table}") if table in BUCKETED else self.lake.table(table)

    def get(self, table: str) -> DataFrame:
        # one that isn't there is known to be empty before anything is planned, so that no join deals the others for it
        return self.table(table) if self.has_table(table) else self.lake.get(table).where(F.lit(False))


def details(lake: Lake | Bucketed, ids: list[str] | DataFrame, locale: str = "gb") -> DataFrame:
    """One row for each id that is there: texts, maker, codes with labels, country, arrays of specs and images.

    Name and texts fall back to the canonical ones where the locale's are null or empty. A code's label counts as soon as
    the locale has a row for it, even without label; else the code stands for it. Specs have no fallback. One plan for
    any number of ids: rows are chosen by a few, listed ids or those in buckets before they are gathered; for more, the
    whole tables are dealt by car, to as many tasks as there are rows for, and specs and images gathered as one.
    """
    wanted = lake.spark.createDataFrame([(i,) for i in ids], "id string") if isinstance(ids, list) else ids
    cars = lake.table("cars")
    cars = cars.select([c for c in schema.struct("cars").names if c in cars.columns])  # older datasets have others too
    texts = of_locale(lake.table("car_texts"), locale, car_id="_ct", name="_name", intro="_intro", detail="_detail")
    labels = of_locale(lake.table("spec_code_i18n"), locale, code="_code", label="_label")
    spec = F.struct("sort_order", "spec_key", F.coalesce("_label", "spec_key").alias("label"), "spec_value", "spec_unit", "spec_raw")
    # a locale's labels of codes are few, and the codes too few to deal specs by
    specs = lake.table("car_specs").where(F.col("locale") == locale).join(F.broadcast(labels), F.col("spec_key") == F.col("_code"), "left").select("car_id", spec.alias("spec"))
    images = lake.get("car_images").select("car_id", F.struct("image_type", "sort_order", "image_path").alias("image"))
    lists = {c: F.sort_array(F.collect_list(c)).alias(f"{c}s") for c in ("spec", "image")}
    # all that is dealt by car meets first, before other joins deal it otherwise
    if isinstance(ids, list) or isinstance(lake, Bucketed) or wanted.count() <= FEW:
        one = wanted.select(F.col("id").alias("car_id")).distinct()
        out = cars.join(wanted.distinct(), "id", "left_semi").join(texts, F.col("id") == F.col("_ct"), "left")
        for df, c in ((specs, "spec"), (images, "image")):
            of_car = df.join(one, "car_id", "left_semi").groupBy(F.col("car_id").alias(f"_{c}")).agg(lists[c])
            out = out.join(of_car, F.col("id") == F.col(f"_{c}"), "left")
    else:
        n = tasks(lake.spark, cars.count() + specs.count() + images.count())
        of_car = specs.unionByName(images, allowMissingColumns=True).repartition(n, "car_id").groupBy("car_id").agg(*lists.values())
        out = cars.repartition(n, "id").join(wanted.repartition(n, "id"), "id", "left_semi")
        out = out.join(texts.repartition(n, "_ct"), F.col("id") == F.col("_ct"), "left").join(of_car, F.col("id") == F.col("car_id"), "left")
    for c in ("name", "intro", "detail"):
        out = out.withColumn(c, F.coalesce(present(F.col(f"_{c}")), c))
    makers = lake.table("manufacturers")
    makers = makers.select(F.col("id").alias("_m"), F.col("name").alias("_mname"), "logo_path", F.col("country_id") if "country_id" in makers.columns else F.lit(None).cast("string").alias("country_id"))
    local = of_locale(lake.table("manufacturer_i18n"), locale, id="_mi", name="_mlocal")
    out = out.join(makers, F.col("manufacturer_id") == F.col("_m"), "left").join(local, F.col("_m") == F.col("_mi"), "left")
    for kind in ("aspiration", "drivetrain"):
        labels = of_locale(lake.table(f"{kind}_i18n"), locale, code=f"_{kind}", label=f"_{kind}_label")
        out = out.join(labels, F.col(f"{kind}_code") == F.col(f"_{kind}"), "left")
        label = F.when(F.col(f"_{kind}").isNotNull(), F.col(f"_{kind}_label")).otherwise(F.col(f"{kind}_code"))
        out = out.withColumn(kind, F.struct(F.col(f"{kind}_code").alias("code"), label.alias("label")))
    payload = country_of_payload(F.col("raw_json"))
    out = out.withColumn("_cid", F.coalesce(present(F.col("country_id")), payload))
    if has_countries(lake):
        out = out.join(country_labels(lake, locale), F.col("_cid") == F.col("_country"), "left")
    else:
        out = out.withColumn("iso3", F.lit(None).cast("string")).withColumn("country", F.lit(None).cast("string"))
    return out.select(
        "id", "name", "intro", "detail", "car_class", "pp", "year",
        F.struct(F.col("manufacturer_id").alias("id"), F.coalesce(present(F.col("_mlocal")), "_mname").alias("name"), "logo_path").alias("manufacturer"),
        F.struct(F.col("_cid").alias("id"), "iso3", F.coalesce("country", "_cid").alias("name")).alias("country"),
        "aspiration", "drivetrain",
        F.coalesce("specs", F.array().cast(out.schema["specs"].dataType)).alias("specs"),
        F.coalesce("images", F.array().cast(out.schema["images"].dataType)).alias("images"),
    )


def car_detail(lake: Lake, car_id: str, locale: str = "gb") -> dict:
    """One car as a nested dict; raises ValueError if there is none."""
    rows = details(lake, [car_id], locale).limit(1).collect()
    if not rows:
        raise ValueError(f"no car {car_id}")
    return rows[0].asDict(recursive=True)
