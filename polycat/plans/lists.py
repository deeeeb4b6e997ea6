"""Lists of cars in a locale, and counts of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from polycat.functions.collation import nocase, present
from polycat.functions.numbers import parse_number
from polycat.operators.cleanup import country_of_payload
from polycat.sources.lake import Lake
from polycat.sources.shared import written

SORTS = ("manufacturer", "country", "drivetrain", "max_power", "weight")


def of_locale(df: DataFrame, locale: str, **names: str) -> DataFrame:
    """Rows of a locale with columns renamed. The filter comes before the left join, so that unmatched rows survive and only the locale's partition is read."""
    return df.where(F.col("locale") == locale).select([F.col(c).alias(n) for c, n in names.items()])


def named_cars(lake: Lake, locale: str) -> DataFrame:
    """cars with name as the locale has it; the canonical one only where it has none (null)."""
    texts = of_locale(lake.table("car_texts"), locale, car_id="_ct", name="_name")
    cars = lake.table("cars")
    return cars.join(texts, cars["id"] == texts["_ct"], "left").withColumn("name", F.coalesce("_name", "name")).drop("_ct", "_name")


def named_makers(lake: Lake, locale: str) -> DataFrame:
    """_m, maker, country_id: makers with their name in the locale, else the canonical one."""
    makers = lake.table("manufacturers")
    local = of_locale(lake.table("manufacturer_i18n"), locale, id="_mi", name="_maker")
    country = F.col("country_id") if "country_id" in makers.columns else F.lit(None).cast("string").alias("country_id")
    return makers.join(local, makers["id"] == local["_mi"], "left").select(F.col("id").alias("_m"), F.coalesce("_maker", "name").alias("maker"), country)


def country_labels(lake: Lake, locale: str) -> DataFrame:
    """_country, iso3, country: the chain of the locale's name, gb's name and ISO3 for each mapped country id."""
    own = of_locale(lake.table("country_i18n"), locale, iso3="_i1", name="_own")
    gb = of_locale(lake.table("country_i18n"), "gb", iso3="_i2", name="_gb")
    m = lake.table("country_iso_map")
    m = m.join(own, m["iso3"] == own["_i1"], "left").join(gb, F.col("iso3") == gb["_i2"], "left")
    return m.select(F.col("country_id").alias("_country"), "iso3", F.coalesce("_own", "_gb", "iso3").alias("country"))


def has_countries(lake: Lake) -> bool:
    return lake.has_table("country_iso_map") and lake.has_table("country_i18n")


def payload_country(lake: Lake, cars: DataFrame, locale: str) -> DataFrame:
    """cars with country from their payload's country id: its name, else gb's, ISO3, or the id itself."""
    cars = cars.withColumn("_cid", country_of_payload(F.col("raw_json")))
    if not has_countries(lake):
        return cars.withColumn("country", F.col("_cid")).drop("_cid")
    labels = country_labels(lake, locale)
    return cars.join(labels, F.col("_cid") == F.col("_country"), "left").withColumn("country", F.coalesce(present(F.col("country")), "_cid")).drop("_cid", "_country", "iso3")


def _take(df: DataFrame, limit: int) -> DataFrame:
    """The first rows, if limit is positive; with the order before it one top-k step, not a whole sort."""
    return df.limit(limit) if limit > 0 else df


def by_manufacturer(lake: Lake, locale: str, limit: int = 0) -> DataFrame:
    cars = named_cars(lake, locale).join(named_makers(lake, locale), F.col("manufacturer_id") == F.col("_m"), "left")
    return _take(cars.orderBy(nocase(F.col("maker")).asc_nulls_first(), nocase(F.col("name")).asc_nulls_first(), "id"), limit).select("id", "name")


def by_country(lake: Lake, locale: str, limit: int = 0) -> DataFrame:
    """By the makers' country, countries without name first and A-Z as a-z; without country tables or column by the payload's country, those without last and in code point order."""
    cars = named_cars(lake, locale)
    if has_countries(lake) and lake.has_column("manufacturers", "country_id"):
        makers = named_makers(lake, locale).drop("maker")
        cars = cars.join(makers, F.col("manufacturer_id") == F.col("_m"), "left").join(country_labels(lake, locale), F.col("country_id") == F.col("_country"), "left")
        label = F.coalesce("country", "country_id")
        return _take(cars.orderBy(nocase(label).asc_nulls_first(), nocase(F.col("name")).asc_nulls_first(), "id"), limit).select("id", "name")
    cars = payload_country(lake, cars, locale)
    return _take(cars.orderBy(F.col("country").isNull(), F.coalesce("country", F.lit("")), F.coalesce("name", F.lit("")), "id"), limit).select("id", "name")


def drivetrain_label(lake: Lake, cars: DataFrame, locale: str) -> DataFrame:
    labels = of_locale(lake.table("drivetrain_i18n"), locale, code="_code", label="_label")
    return cars.join(labels, F.col("drivetrain_code") == F.col("_code"), "left").withColumn("drivetrain", F.coalesce("_label", "drivetrain_code")).drop("_code", "_label")


def by_drivetrain(lake: Lake, locale: str, limit: int = 0) -> DataFrame:
    cars = drivetrain_label(lake, named_cars(lake, locale), locale)
    return _take(cars.orderBy(nocase(F.col("drivetrain")).asc_nulls_first(), nocase(F.col("name")).asc_nulls_first(), "id"), limit).select("id", "name")


def by_spec(lake: Lake, locale: str, key: str, order: Column, limit: int = 0, dedupe: bool = False) -> DataFrame:
    """By a specification's number in the locale, else in gb. Repeated specifications repeat the car unless dedupe is set."""
    specs = lake.table("car_specs").where(F.col("spec_key") == key)
    if dedupe:
        specs = specs.groupBy("car_id", "locale").agg(F.min_by("spec_value", "sort_order").alias("spec_value"))
    own, gb = of_locale(specs, locale, car_id="_c1", spec_value="_v1"), of_locale(specs, "gb", car_id="_c2", spec_value="_v2")
    cars = named_cars(lake, locale).join(own, F.col("id") == F.col("_c1"), "left").join(gb, F.col("id") == F.col("_c2"), "left")
    cars = cars.withColumn("number", parse_number(F.coalesce("_v1", "_v2")))
    return _take(cars.orderBy(order, "id"), limit).select("id", "name")


def by_max_power(lake: Lake, locale: str, limit: int = 0) -> DataFrame:
    return by_spec(lake, locale, "max_power", F.desc_nulls_first("number"), limit)


def by_weight(lake: Lake, locale: str, limit: int = 0) -> DataFrame:
    return by_spec(lake, locale, "weight", F.asc_nulls_last("number"), limit)


def list_cars(lake: Lake, locale: str = "gb", sort_by: str = "manufacturer", limit: int = 0) -> DataFrame:
    """id, name in the order of sort_by (one of SORTS); ties by id."""
    how = {"manufacturer": by_manufacturer, "country": by_country, "drivetrain": by_drivetrain, "max_power": by_max_power, "weight": by_weight}
    if sort_by not in how:
        raise ValueError(f"unknown sort {sort_by}; one of {', '.join(SORTS)}")
    return how[sort_by](lake, locale, limit)


def stats_by_manufacturer(lake: Lake, locale: str = "gb") -> DataFrame:
    """label, count for each maker, two makers of one name apart."""
    cars = lake.table("cars").join(named_makers(lake, locale), F.col("manufacturer_id") == F.col("_m"), "left")
    out = cars.groupBy("_m").agg(F.first("maker").alias("label"), F.count(F.lit(1)).alias("count"))
    return out.orderBy(nocase(F.col("label")).asc_nulls_first(), "_m").select("label", "count")


def stats_by_country(lake: Lake, locale: str = "gb") -> DataFrame:
    """label, count for each pair of ISO3 and country id; without country tables for each label of the payload's country, 'Unknown' if it has none."""
    cars = lake.table("cars")
    if has_countries(lake) and lake.has_column("manufacturers", "country_id"):
        makers = named_makers(lake, locale).drop("maker")
        cars = cars.join(makers, F.col("manufacturer_id") == F.col("_m"), "left").join(country_labels(lake, locale), F.col("country_id") == F.col("_country"), "left")
        out = cars.groupBy("iso3", "country_id").agg(F.first(F.coalesce("country", "country_id")).alias("label"), F.count(F.lit(1)).alias("count"))
        return out.orderBy(nocase(F.col("label")).asc_nulls_first(), "iso3", "country_id").select("label", "count")
    out = payload_country(lake, cars, locale).groupBy(F.coalesce("country", F.lit("Unknown")).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy("label")


def stats_by_drivetrain(lake: Lake, locale: str = "gb") -> DataFrame:
    cars = drivetrain_label(lake, lake.table("cars"), locale)
    out = cars.groupBy("drivetrain_code").agg(F.first("drivetrain").alias("label"), F.count(F.lit(1)).alias("count"))
    return out.orderBy(nocase(F.col("label")).asc_nulls_first(), "drivetrain_code").select("label", "count")


def overview_stats(lake: Lake) -> DataFrame:
    """cars, manufacturers, specs, images (0 if there is no such table) and locales, sorted, in one row: scalar subqueries of one plan."""
    tables = {"cars": "cars", "manufacturers": "manufacturers", "specs": "car_specs", "images": "car_images"}
    some = lambda t: lake.table(t) if lake.has_table(t) else lake.get(t)
    count = lambda t: some(t).agg(F.count(F.lit(1))).scalar()
    locales = lake.table("car_texts").agg(F.sort_array(F.collect_set("locale"))).scalar()
    return lake.spark.range(1).select(*[count(t).alias(c) for c, t in tables.items()], locales.alias("locales"))


def with_positions(ordered: DataFrame, name: str = "pos") -> DataFrame:
    """An ordered table with its rows' positions from 1.

    Rows are written in the partitions of the sort, where each is numbered; the rows before a partition are one sum for each
    partition, so that nothing passes through one task.
    """
    rows = written(ordered.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # one row for each partition
    starts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    out = rows.join(starts, part == F.col("_part"))
    return out.select(*ordered.columns, (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).alias(name))
