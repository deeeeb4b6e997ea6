"""The library's operators over the driver's tables, each with the same question in SQL.

A catalog is derived from the tables by views whose text both engines read; queries then call the library's functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from polycat import schema
from polycat.extract import html as pages
from polycat.extract.payload import image_urls
from polycat.functions import codes, collation, numbers, specs, text
from polycat.operators import cleanup, merge, upsert
from polycat.plans import detail, ingest, lists, quality
from polycat.sources import shared
from polycat.sources.lake import Lake
from polycat.streaming import fetch_log

SOURCES = ["part", "supplier", "nation", "region", "orders", "lineitem", "customer", "events", "documents", "pages"]
FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

VIEWS = {
    "cars": """select cast(p_partkey as string) as id, case when p_partkey % 7 = 0 then upper(p_name) when p_partkey % 11 = 0 then concat('É', p_name) else p_name end as name,
        case when p_partkey % 97 = 0 then null else p_brand end as manufacturer_id, cast(null as string) as aspiration_code,
        case p_partkey % 8 when 0 then 'FR' when 1 then 'FF' when 2 then 'MR' when 3 then 'RR' when 4 then '4WD' when 5 then 'AWD' when 6 then 'xx' else null end as drivetrain_code,
        cast(null as string) as intro, concat('detail ', p_type) as detail, p_type as car_class, cast(p_size as string) as pp, cast(null as string) as year,
        case when p_partkey % 13 = 0 then '[]' when p_partkey % 17 = 0 then '{"countryId": ""}' else concat('{"countryId": "c', cast(p_size % 11 as string), '"}') end as raw_json from {part}""",
    "manufacturers": """select distinct p_brand as id, p_brand as name, cast(null as string) as logo_path, case when right(p_brand, 1) = '9' then null else concat('c', right(p_brand, 1)) end as country_id from {part} where p_brand <> 'Brand#4'""",
    "manufacturer_i18n": """select distinct p_brand as id, 'cn' as locale, case when right(p_brand, 1) = '1' then lower(p_brand) when right(p_brand, 1) = '3' then concat('Zz ', p_brand) else concat('é', p_brand) end as name from {part} where right(p_brand, 1) in ('1', '3', '5')""",
    "car_texts": """select cast(p_partkey as string) as car_id, 'cn' as locale, case when p_partkey % 9 = 0 then null when p_partkey % 6 = 0 then '' else concat('_', p_name) end as name, cast(null as string) as intro, case when p_partkey % 2 = 0 then '' else 'cn detail' end as detail from {part} where p_partkey % 3 = 0
        union all select cast(p_partkey as string), 'gb', p_name, 'intro', null from {part} where p_partkey % 5 = 0""",
    "drivetrain_i18n": """select * from (values ('FR', 'cn', 'front rear'), ('FF', 'cn', cast(null as string)), ('4WD', 'cn', 'All Four'), ('FR', 'gb', 'FR')) as t(code, locale, label)""",
    "aspiration_i18n": """select * from (values ('NA', 'cn', 'natural')) as t(code, locale, label)""",
    "car_specs": """select cast(p_partkey as bigint) as id, cast(p_partkey as string) as car_id, case when p_partkey % 2 = 0 then 'cn' else 'gb' end as locale, 'max_power' as spec_key, case when p_partkey % 10 = 0 then '' when p_partkey % 4 = 0 then concat('1.', cast(100 + p_size as string), ',5') else concat(cast(p_size as string), ',', cast(100 + p_partkey % 900 as string)) end as spec_value, 'HP' as spec_unit, cast(null as string) as spec_raw, 1 as sort_order from {part}
        union all select cast(p_partkey + 10000000 as bigint), cast(p_partkey as string), 'gb', 'weight', cast(p_size as string), 'kg', null, 2 from {part} where p_partkey % 4 <> 3
        union all select cast(p_partkey + 20000000 as bigint), cast(p_partkey as string), 'gb', 'weight', cast(p_size + 1 as string), 'kg', null, 3 from {part} where p_partkey % 25 = 0""",
    "spec_code_i18n": """select * from (values ('max_power', 'cn', 'power'), ('weight', 'gb', 'Weight'), ('raw_1', 'cn', 'a'), ('rawX1', 'cn', 'b'), ('RAW_2', 'cn', 'c')) as t(code, locale, label)""",
    "country_iso_map": """select * from (values ('c0', 'AAA'), ('c1', 'BBB'), ('c2', 'CCC'), ('c3', 'DDD'), ('c4', 'DDD'), ('c5', 'EEE'), ('c6', 'FFF')) as t(country_id, iso3)""",
    "country_i18n": """select * from (values ('AAA', 'cn', 'ah'), ('AAA', 'gb', 'Aland'), ('BBB', 'gb', 'bland'), ('CCC', 'cn', 'Çland'), ('DDD', 'cn', 'dee'), ('EEE', 'gb', 'Eland')) as t(iso3, locale, name)""",
    "car_images": """select cast(l_orderkey * 10 + l_linenumber as bigint) as id, cast(l_partkey as string) as car_id, concat('cars/', cast(l_suppkey as string), case when l_linenumber % 2 = 0 then '.jpe' else '.jpg' end) as image_path, l_linenumber as sort_order, case l_returnflag when 'A' then 'hero' when 'N' then 'thumb' else '' end as image_type from {lineitem}""",
    "fetch_log": """select event_id as id, cast(user_id as string) as car_id, 'gb' as locale, event_type as status, props as message, cast(ts as string) as updated_at from {events}""",
    "manifest": """select cast(p_partkey as string) as car_id, cast(p_size % 6 as int) as expected from {part} where p_partkey % 3 = 0""",
}


class Catalog:
    """The derived tables, with the interface of a dataset."""

    def __init__(self, spark: SparkSession, sf_dir: str, without: tuple[str, ...] = ()):
        self.spark, self.sf_dir, self.without = spark, sf_dir, without

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        used = {s: self.source(s) for s in SOURCES if "{" + s + "}" in VIEWS[name]}
        sql = VIEWS[name].replace("{", "{{").replace("}", "}}")
        for s in used:
            sql = sql.replace("{{" + s + "}}", "{" + s + "}")
        return self.spark.sql(sql, **used) if used else self.spark.sql(VIEWS[name])

    def has_table(self, name: str) -> bool:
        return name in VIEWS and name not in self.without

    def has_column(self, table: str, column: str) -> bool:
        return self.has_table(table) and column in self.table(table).columns

    def get(self, name: str) -> DataFrame:
        return self.table(name) if self.has_table(name) else self.spark.createDataFrame([], schema.struct(name))


def _sql(query: str) -> str:
    """A query with the views that it names before it."""
    used = [v for v in VIEWS if v in query]
    used = [v for v in VIEWS if v in used]
    views = [f"{v} as ({reduce(lambda s, t: s.replace('{' + t + '}', t), SOURCES, VIEWS[v])})" for v in used]
    return f"with {', '.join(views)} {query}" if views else query


def _ranked(df: DataFrame) -> DataFrame:
    """A list's rows with their positions."""
    return lists.with_positions(df)


QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(fn):
        QUERIES[fn.__name__] = fn
        SQL[fn.__name__] = _sql(sql)
        return fn

    return add


_CARS = "cars c left join (select * from car_texts where locale = 'cn') ct on ct.car_id = c.id"
_MAKER = "left join manufacturers m on m.id = c.manufacturer_id left join (select * from manufacturer_i18n where locale = 'cn') mi on mi.id = m.id"
_COUNTRY = "left join country_iso_map im on im.country_id = {id} left join (select * from country_i18n where locale = 'cn') ci on ci.iso3 = im.iso3 left join (select * from country_i18n where locale = 'gb') cg on cg.iso3 = im.iso3"
_NAME = "coalesce(ct.name, c.name)"


@query(f"""select id, name, row_number() over (order by k nulls first, n nulls first, id) as pos from (select c.id, {_NAME} as name, {FOLD.format('coalesce(mi.name, m.name)')} as k, {FOLD.format(_NAME)} as n from {_CARS} {_MAKER}) q""")
def list_by_maker_nocase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(lists.list_cars(Catalog(spark, sf_dir), "cn", "manufacturer"))


@query(f"""select id, name, row_number() over (order by k nulls first, n nulls first, id) as pos from (select c.id, {_NAME} as name, {FOLD.format('coalesce(ci.name, cg.name, im.iso3, m.country_id)')} as k, {FOLD.format(_NAME)} as n from {_CARS} {_MAKER} {_COUNTRY.format(id='m.country_id')}) q""")
def list_by_country_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(lists.list_cars(Catalog(spark, sf_dir), "cn", "country"))


@query(f"""select id, name, row_number() over (order by k is null, coalesce(k, ''), coalesce(name, ''), id) as pos from (select c.id, {_NAME} as name, case when c.raw_json = '[]' then null else nullif(json_extract_string(c.raw_json, '$.countryId'), '') end as k from {_CARS}) q""")
def list_by_country_nulls_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(lists.list_cars(Catalog(spark, sf_dir, ("country_iso_map",)), "cn", "country"))


@query(f"""select id, name, row_number() over (order by k nulls first, n nulls first, id) as pos from (select c.id, {_NAME} as name, {FOLD.format('coalesce(d.label, c.drivetrain_code)')} as k, {FOLD.format(_NAME)} as n from {_CARS} left join (select * from drivetrain_i18n where locale = 'cn') d on d.code = c.drivetrain_code) q""")
def list_by_code_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(lists.list_cars(Catalog(spark, sf_dir), "cn", "drivetrain"))


_NUMBER = """try_cast(nullif(regexp_extract(case when strpos({v}, ',') > 0 and strpos({v}, '.') > 0 and strpos(reverse({v}), ',') < strpos(reverse({v}), '.') then replace(replace({v}, '.', ''), ',', '.') else replace({v}, ',', '') end, '^-?[0-9]+(\\.[0-9]+)?'), '') as double)"""
_SPEC = """(select c.id, {name} as name, {number} as x from {cars} left join (select * from car_specs where locale = 'cn' and spec_key = '{key}') s on s.car_id = c.id left join (select * from car_specs where locale = 'gb' and spec_key = '{key}') g on g.car_id = c.id)"""


@query(f"""select id, name, row_number() over (order by x desc nulls first, id) as pos from {_SPEC.format(name=_NAME, number=_NUMBER.format(v='coalesce(s.spec_value, g.spec_value)'), cars=_CARS, key='max_power')} q""")
def list_by_spec_desc_nulls_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(lists.list_cars(Catalog(spark, sf_dir), "cn", "max_power"))


@query(f"""select id, name, row_number() over (order by x asc nulls last, id) as pos from {_SPEC.format(name=_NAME, number=_NUMBER.format(v='coalesce(s.spec_value, g.spec_value)'), cars=_CARS, key='weight')} q""")
def list_by_spec_asc_nulls_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(lists.list_cars(Catalog(spark, sf_dir), "cn", "weight"))


@query("""select c.id, count(*) as n from cars c left join (select * from car_specs where locale = 'gb' and spec_key = 'weight') a on a.car_id = c.id left join (select * from car_specs where locale = 'gb' and spec_key = 'weight') b on b.car_id = c.id group by c.id""")
def spec_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.by_weight(Catalog(spark, sf_dir), "gb").groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query(f"""select any_value(coalesce(mi.name, m.name)) as label, count(*) as "count" from cars c {_MAKER} group by m.id""")
def stats_by_maker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.stats_by_manufacturer(Catalog(spark, sf_dir), "cn")


@query(f"""select any_value(coalesce(ci.name, cg.name, im.iso3, m.country_id)) as label, count(*) as "count" from cars c {_MAKER} {_COUNTRY.format(id='m.country_id')} group by im.iso3, m.country_id""")
def stats_by_country_two_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.stats_by_country(Catalog(spark, sf_dir), "cn")


@query("""select coalesce(case when raw_json = '[]' then null else nullif(json_extract_string(raw_json, '$.countryId'), '') end, 'Unknown') as label, count(*) as "count" from cars group by 1""")
def stats_by_json_label_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.stats_by_country(Catalog(spark, sf_dir, ("country_i18n",)), "cn")


@query("""select any_value(coalesce(d.label, c.drivetrain_code)) as label, count(*) as "count" from cars c left join (select * from drivetrain_i18n where locale = 'cn') d on d.code = c.drivetrain_code group by c.drivetrain_code""")
def stats_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.stats_by_drivetrain(Catalog(spark, sf_dir), "cn")


@query("""select (select count(*) from cars) as cars, (select count(*) from manufacturers) as manufacturers, (select count(*) from car_specs) as specs, (select count(*) from car_images) as images, (select string_agg(distinct locale, ',' order by locale) from car_texts) as locales""")
def overview_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.overview_stats(Catalog(spark, sf_dir)).withColumn("locales", F.array_join("locales", ","))


_DETAIL = """select c.id, coalesce(nullif(ct.name, ''), c.name) as name, coalesce(nullif(ct.detail, ''), c.detail) as detail, coalesce(nullif(mi.name, ''), m.name) as maker,
    case when d.code is not null then d.label else c.drivetrain_code end as drivetrain, coalesce(s.n, 0) as n_specs, coalesce(s.first_label, '-') as first_label, coalesce(i.n, 0) as n_images
    from cars c left join (select * from car_texts where locale = 'cn') ct on ct.car_id = c.id left join manufacturers m on m.id = c.manufacturer_id left join (select * from manufacturer_i18n where locale = 'cn') mi on mi.id = m.id
    left join (select * from drivetrain_i18n where locale = 'cn') d on d.code = c.drivetrain_code
    left join (select car_id, count(*) n, arg_min(coalesce(l.label, s.spec_key), sort_order) as first_label from car_specs s left join (select * from spec_code_i18n where locale = 'cn') l on l.code = s.spec_key where s.locale = 'cn' group by car_id) s on s.car_id = c.id
    left join (select car_id, count(*) n from car_images group by car_id) i on i.car_id = c.id"""


def _details(d: DataFrame) -> DataFrame:
    return d.select("id", "name", "detail", F.col("manufacturer.name").alias("maker"), F.col("drivetrain.label").alias("drivetrain"), F.size("specs").cast("long").alias("n_specs"), F.coalesce(F.get("specs", F.lit(0))["label"], F.lit("-")).alias("first_label"), F.size("images").cast("long").alias("n_images"))


@query(_DETAIL + " where c.id in ('0', '3', '6', '8', '9', '18', '40', '97')")
def detail_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _details(detail.details(Catalog(spark, sf_dir), ["0", "3", "6", "8", "9", "18", "40", "97", "none"], "cn"))


@query(_DETAIL)
def detail_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Catalog(spark, sf_dir)
    return _details(detail.details(c, c.table("cars").select("id"), "cn"))


@query("""select car_id, locale, arg_max(status, id) as status from fetch_log group by car_id, locale""")
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.latest_status(Catalog(spark, sf_dir).table("fetch_log"))


@query("""select cast(c_custkey as string) as id from customer where cast(c_custkey as string) not in (select car_id from (select car_id, arg_max(status, id) as status from fetch_log group by car_id) where status = 'purchase')""")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Catalog(spark, sf_dir)
    log = c.table("fetch_log").withColumn("status", F.when(F.col("status") == "purchase", "success").otherwise(F.col("status")))
    return quality.pending(c.source("customer").select(F.col("c_custkey").cast("string").alias("id")), log, "gb")


@query("""select manufacturer_id, min(id) as id from cars where manufacturer_id is not null group by manufacturer_id""")
def min_id_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.examples(Catalog(spark, sf_dir).table("cars"))


_SAID = "select manufacturer_id as id, arg_min(cid, id) as cid from (select id, manufacturer_id, case when raw_json = '[]' then null else nullif(json_extract_string(raw_json, '$.countryId'), '') end as cid from cars) q where cid is not null and manufacturer_id is not null group by manufacturer_id"


@query(f"""select m.id, m.name, coalesce(s.cid, m.country_id) as country_id from manufacturers m left join ({_SAID}) s on s.id = m.id""")
def first_wins_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Catalog(spark, sf_dir)
    return cleanup.backfill_countries(c.table("manufacturers"), c.table("cars")).select("id", "name", "country_id")


@query("""select c_custkey, c_name, c_nationkey from (select *, row_number() over (partition by c_custkey order by src) as r from (
    select c_custkey, c_name, c_nationkey, 0 as src from customer where c_custkey % 3 <> 0 union all select c_custkey, upper(c_name), c_nationkey, 1 from customer where c_custkey % 2 = 0 union all select c_custkey, concat('third ', c_name), c_nationkey, 2 from customer) where c_name is not null) where r = 1""")
def merge_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Catalog(spark, sf_dir).source("customer").select("c_custkey", "c_name", "c_nationkey")
    parts = [c.where("c_custkey % 3 <> 0"), c.where("c_custkey % 2 = 0").withColumn("c_name", F.upper("c_name")), c.withColumn("c_name", F.concat(F.lit("third "), "c_name"))]
    return merge.first_wins(parts, ["c_custkey"], ["c_name"])


@query("""select doc_id, lang as locale, source from documents where lang <> 'fr' union all select doc_id + 1000000, lang, upper(source) from documents where lang = 'fr' and n_chars > 1000""")
def merge_replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Catalog(spark, sf_dir).source("documents").select("doc_id", F.col("lang").alias("locale"), "source", "n_chars")
    new = d.where("n_chars > 1000").select(F.col("doc_id") + 1000000, "locale", F.upper("source"), "n_chars").toDF("doc_id", "locale", "source", "n_chars")
    return merge.replace_locale(d, new, "fr").select("doc_id", "locale", "source")


@query("""select id, car_id, image_path, image_type from car_images where sort_order <= 2 union all select id, car_id, image_path, image_type from car_images a where sort_order > 2 and not exists (select 1 from car_images b where b.sort_order <= 2 and b.car_id = a.car_id and b.image_path = a.image_path and coalesce(b.image_type, '') = coalesce(a.image_type, ''))""")
def merge_images_not_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Catalog(spark, sf_dir).table("car_images")
    i = i.withColumn("image_type", F.when((F.col("image_type") == "") & (F.col("sort_order") > 2), F.lit(None)).otherwise(F.col("image_type")))
    return merge.new_images(i.where("sort_order <= 2"), i.where("sort_order > 2")).select("id", "car_id", "image_path", F.coalesce("image_type", F.lit("")).alias("image_type"))


_OLD_NEW = "(select s_suppkey as k, s_name as name, case when s_suppkey % 2 = 0 then cast(s_nationkey as string) end as c from supplier where s_suppkey % 4 <> 0) o full join (select s_suppkey as k, upper(s_name) as name, case when s_suppkey % 3 = 0 then 'new' end as c from supplier where s_suppkey % 5 <> 0) n on o.k = n.k"


@query(f"""select cast(coalesce(o.k, n.k) as string) as id, coalesce(o.name, n.name) as name, coalesce(n.c, o.c) as country_id from {_OLD_NEW}""")
def upsert_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Catalog(spark, sf_dir).source("supplier")
    old = s.where("s_suppkey % 4 <> 0").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), F.lit(None).cast("string").alias("logo_path"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey").cast("string")).alias("country_id"))
    new = s.where("s_suppkey % 5 <> 0").select(F.col("s_suppkey").cast("string").alias("id"), F.upper("s_name").alias("name"), F.lit(None).cast("string").alias("logo_path"), F.when(F.col("s_suppkey") % 3 == 0, F.lit("new")).alias("country_id"))
    return upsert.manufacturers(old, new, update_name=False).select("id", "name", "country_id")


@query("""select coalesce(o.id, n.id) as id, coalesce(o.name, n.name) as name, case when n.id is not null then n.manufacturer_id else o.manufacturer_id end as manufacturer_id, case when o.id is not null then o.detail else n.detail end as detail
    from (select * from cars where cast(id as int) % 3 <> 0) o full join (select id, upper(name) as name, 'm' || manufacturer_id as manufacturer_id, 'x' as detail from cars where cast(id as int) % 2 = 0) n on o.id = n.id""")
def upsert_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Catalog(spark, sf_dir).table("cars")
    new = c.where("cast(id as int) % 2 = 0").withColumn("name", F.upper("name")).withColumn("manufacturer_id", F.concat(F.lit("m"), "manufacturer_id")).withColumn("detail", F.lit("x"))
    return upsert.cars(c.where("cast(id as int) % 3 <> 0"), new, update_texts=False).select("id", "name", "manufacturer_id", "detail")


@query("""select doc_id, lang as locale from documents where lang = 'de'""")
def prune_except_locale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanup.only_locale(Catalog(spark, sf_dir).source("documents").select("doc_id", F.col("lang").alias("locale")), "de")


_PRIORITY = "case when o_orderkey % 11 = 0 then '---' when o_orderkey % 13 = 0 then null else o_orderpriority end"


@query(f"""select o_orderkey, code from (select o_orderkey, {_PRIORITY} as code from orders) where not coalesce(code not in ('1-URGENT', '2-HIGH', '---') or code = '---', false)""")
def whitelist_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Catalog(spark, sf_dir).source("orders").select("o_orderkey", F.expr(_PRIORITY).alias("code"))
    return cleanup.whitelisted(o, ["1-URGENT", "2-HIGH", "---"])


_RAW = "case p_partkey % 6 when 0 then concat('raw_', p_name) when 1 then concat('rawX', p_name) when 2 then concat('RAW_', p_name) when 3 then concat('xraw_', p_name) when 4 then null else p_name end"


@query(f"""select p_partkey, code from (select p_partkey, {_RAW} as code, p_partkey % 2 = 0 as here from part) where not (here and coalesce(code ilike 'raw_%', false))""")
def like_raw_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Catalog(spark, sf_dir).source("part").select("p_partkey", F.expr(_RAW).alias("code"), F.when(F.col("p_partkey") % 2 == 0, "cn").otherwise("gb").alias("locale"))
    return cleanup.without_raw_labels(p, "cn").select("p_partkey", "code")


@query("""select m.id, coalesce(i.name, m.name) as name from manufacturers m left join (select * from manufacturer_i18n where locale = 'cn') i on i.id = m.id""")
def sync_exists_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Catalog(spark, sf_dir)
    return cleanup.manufacturer_names(c.table("manufacturers"), c.table("manufacturer_i18n"), "cn").select("id", "name")


_KIND = "coalesce(nullif(image_type, ''), 'unknown')"


@query(f"""select car_id, image_type, count(*) as n, min(src) as src from (select *, sum(1 - src) over (partition by car_id, image_type) as n_old, sum(src) over (partition by car_id, image_type) as n_new from (
    select car_id, {_KIND} as image_type, 0 as src from car_images where sort_order <= 3 union all select car_id, {_KIND}, 1 from car_images where sort_order > 3)) where (src = 1) = (case when image_type in ('hero', 'thumb') then n_new >= n_old else n_new > 0 end) group by 1, 2""")
def image_nonregression(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Catalog(spark, sf_dir).table("car_images")
    old, new = i.where("sort_order <= 3"), i.where("sort_order > 3")
    out = upsert.image_rows(old, new)
    return out.groupBy("car_id", "image_type").agg(F.count(F.lit(1)).alias("n"), F.min((F.col("sort_order") > 3).cast("int")).alias("src"))


_HEROES = "cars c left join manifest m on m.car_id = c.id left join (select car_id, count(*) as n from car_images where image_type = 'hero' group by car_id) h on h.car_id = c.id"
_REASON = "case when m.expected is not null and coalesce(h.n, 0) <> m.expected then 'mismatch_with_reference' when m.expected is null and coalesce(h.n, 0) < 2 then 'below_min_without_reference' end"


@query(f"""select c.id as car_id, coalesce(cast(m.expected as string), '>=2') as expected, coalesce(h.n, 0) as actual, {_REASON} as reason from {_HEROES} where {_REASON} is not null""")
def quality_expected_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Catalog(spark, sf_dir)
    return quality.hero_differences(c.table("cars"), c.table("car_images"), c.table("manifest"), 2).drop("expected_count")


@query(f"""select count(*) as checked, count({_REASON}) as mismatches, round(count({_REASON}) / count(*), 4) as ratio from {_HEROES}""")
def quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Catalog(spark, sf_dir)
    wrong = quality.hero_differences(c.table("cars"), c.table("car_images"), c.table("manifest"), 2).agg(F.count(F.lit(1)).alias("mismatches"))
    out = c.table("cars").agg(F.count(F.lit(1)).alias("checked")).withColumn("mismatches", wrong.scalar())
    return out.select("checked", "mismatches", F.round(F.col("mismatches") / F.col("checked"), 4).alias("ratio"))


_PRICE = "case p_partkey % 6 when 0 then cast(p_partkey as string) when 1 then concat('1,', cast(100 + p_size as string), '.5') when 2 then concat('1.', cast(100 + p_size as string), ',5') when 3 then concat(' -', cast(p_size as string), ' ') when 4 then concat('+', cast(p_size as string)) else concat(cast(p_size as string), ' 5 kg') end"


@query(f"""select p_partkey, {_NUMBER.format(v="replace(trim(" + _PRICE + "), ' ', '')")} as x from part""")
def parse_number_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Catalog(spark, sf_dir).source("part").select("p_partkey", numbers.parse_number(F.expr(_PRICE)).alias("x"))


_RAW_VALUE = "case p_partkey % 4 when 0 then concat(cast(p_size as string), ' kg') when 1 then concat('1,', cast(100 + p_size as string), ' mm ') when 2 then p_name else concat(cast(p_size as string), ' 5HP') end"


@query(f"""select p_partkey, case when regexp_matches(r, '^[0-9]') then replace(regexp_extract(r, '^([0-9][0-9.,\\s]*)\\s*(.*)$', 1), ' ', '') else r end as value, case when regexp_matches(r, '^[0-9]') then trim(regexp_extract(r, '^([0-9][0-9.,\\s]*)\\s*(.*)$', 2)) else '' end as unit from (select p_partkey, trim({_RAW_VALUE}) as r from part)""")
def parse_value_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = numbers.spec_value(F.expr(_RAW_VALUE))
    return Catalog(spark, sf_dir).source("part").select("p_partkey", v["value"].alias("value"), v["unit"].alias("unit"))


@query("""select cast(p_partkey as string) as car_id, 'max_power' as spec_key, cast(p_size as string) as spec_value, 'HP' as spec_unit, 1 as sort_order from part
    union all select cast(p_partkey as string), 'max_power_rpm', cast(1000 + p_size as string), 'rpm', 2 from part
    union all select cast(p_partkey as string), case when p_partkey % 2 = 0 then 'weight' else 'length' end, cast(p_size as string), case when p_partkey % 2 = 0 then 'kg' else 'mm' end, 3 from part
    union all select cast(p_partkey as string), case when p_partkey % 2 = 0 then 'length' else 'width' end, '7', 'mm', 4 from part""")
def spec_split_rpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Catalog(spark, sf_dir).source("part")
    row = lambda n, label, raw: F.struct(F.lit(n).alias("pos"), F.lit(label).alias("label"), raw.alias("raw"))
    size = F.col("p_size").cast("string")
    rows = F.array(row(0, "Power", F.concat(size, F.lit(" HP / "), (F.col("p_size") + 1000).cast("string"), F.lit(" rpm"))), row(1, "Size", F.concat(size, F.when(F.col("p_partkey") % 2 == 0, " kg").otherwise(" mm"))), row(2, "Other", F.lit("7 mm")))
    pairs = p.select(F.col("p_partkey").cast("string").alias("car_id"), F.lit("gb").alias("locale"), F.explode(rows).alias("_r")).select("car_id", "locale", "_r.*")
    return specs.normalize_specs(pairs, spark.createDataFrame([], "locale string, label string, code string")).select("car_id", "spec_key", "spec_value", "spec_unit", "sort_order")


_FORM = "case p_partkey % 8 when 0 then '1,998 cc' when 1 then 'TC' when 2 then '4WD' when 3 then '300 Nm / 4000 rpm' when 4 then '250 PS' when 5 then '1,200 kg' when 6 then '4,500 mm' else 'yes' end"


@query("""select p_partkey, case p_partkey % 8 when 0 then 'displacement' when 1 then 'aspiration' when 2 then 'drivetrain' when 3 then 'max_torque' when 4 then 'max_power' when 5 then 'weight' when 6 then '<length>' else concat('raw_', substr(sha1(concat('gb:', p_name)), 1, 10)) end as code from part""")
def infer_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Catalog(spark, sf_dir).source("part").select("p_partkey", F.coalesce(specs.infer_code(F.expr(_FORM)), specs.hashed_code(F.lit("gb"), F.col("p_name"))).alias("code"))


_DATED = "case p_partkey % 4 when 0 then concat(p_name, ' ', cast(1980 + p_size as string)) when 1 then concat(p_name, ' ''', right(cast(100 + p_size as string), 2)) when 2 then concat(p_name, ' 12345') else p_name end"


@query(f"""select p_partkey, coalesce(nullif(regexp_extract(n, '\\b(19[0-9]{{2}}|20[0-9]{{2}})\\b', 1), ''), case when y <> '' then concat(case when cast(y as int) <= 29 then '20' else '19' end, y) end) as year from (select p_partkey, n, regexp_extract(n, '''([0-9]{{2}})\\b', 1) as y from (select p_partkey, {_DATED} as n from part))""")
def derive_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Catalog(spark, sf_dir).source("part").select("p_partkey", codes.year_of(F.expr(_DATED)).alias("year"))


_BREATH = "case p_partkey % 8 when 0 then 'Turbo' when 1 then 'na' when 2 then 'T+ x' when 3 then 'tc + sc' when 4 then '---' when 5 then '涡轮增压' when 6 then 'EV (electric)' else p_name end"
_DRIVE = "case p_partkey % 4 when 0 then 'f r' when 1 then '四驱' when 2 then '---' else p_name end"


@query(f"""select p_partkey, case p_partkey % 8 when 0 then 'TC' when 1 then 'NA' when 2 then 'TC' when 3 then 'TC+SC' when 4 then null when 5 then 'TC' when 6 then 'EV' else case when contains(p_name, 'na') then 'NA' end end as aspiration, case p_partkey % 4 when 0 then 'FR' when 1 then '4WD' end as drivetrain, case p_partkey % 8 when 6 then 'electric' else {_BREATH} end as label from part""")
def norm_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.expr(_BREATH)
    return Catalog(spark, sf_dir).source("part").select("p_partkey", codes.aspiration_code(b).alias("aspiration"), codes.drivetrain_code(F.expr(_DRIVE)).alias("drivetrain"), codes.aspiration_label(b).alias("label"))


@query("""select c_custkey, coalesce(nullif(trim(regexp_replace(lower(n), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown') as slug from (select c_custkey, case when c_custkey % 9 = 0 then ' -- ' else concat(' ', c_name, ' É! ', c_mktsegment) end as n from customer)""")
def slugify(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.when(F.col("c_custkey") % 9 == 0, " -- ").otherwise(F.concat(F.lit(" "), "c_name", F.lit(" É! "), "c_mktsegment"))
    return Catalog(spark, sf_dir).source("customer").select("c_custkey", text.slugify(n).alias("slug"))


@query("""select page_id, sha1(url) as file, '.jpg' as ext, case when page_id % 2 = 0 then '.webp' else '.jpg' end as ext2 from pages""")
def ext_and_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Catalog(spark, sf_dir).source("pages")
    named = F.concat(F.regexp_replace("url", "[?#].*$", ""), F.when(F.col("page_id") % 2 == 0, "/a.WEBP?x=1").otherwise("/a.jpe#y"))
    return p.select("page_id", text.file_name(F.col("url")).alias("file"), text.extension(F.lit("http://a/b"), F.lit("image/jpeg; q=1")).alias("ext"), text.extension(named, F.lit(None).cast("string")).alias("ext2"))


_TITLE = "regexp_extract(html, '<h1>([^<]*)</h1>', 1)"


@query(f"""select page_id, trim(replace(regexp_replace(regexp_replace({_TITLE}, '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), chr(160), ' ')) as title from pages""")
def page_title_h1(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pages.with_details(Catalog(spark, sf_dir).source("pages").withColumn("car_id", F.lit(None).cast("string")))
    return p.select("page_id", F.col("detail.name").alias("title"))


@query("""select user_id, string_agg(event_type, ',' order by first) as types from (select user_id, event_type, min(event_id) as first from events group by 1, 2) group by user_id""")
def ordered_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Catalog(spark, sf_dir).source("events")
    return text.ordered_distinct(e, ["user_id"], "event_type", "event_id", "types").withColumn("types", F.array_join("types", ","))


@query("""select cast(o_orderkey as string) as car_id, concat('hero_', cast(r as string)) as job_id, url, concat('cars/', cast(o_orderkey as string), '/', cast(o_orderkey as string), '_hero_', lpad(cast(r as string), 2, '0')) as dest_rel from (
    select l_orderkey as o_orderkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as r, case when l_linenumber % 3 = 0 then 'data:x' else concat('u', cast(l_partkey as string)) end as url from lineitem) where url <> 'data:x'""")
def image_jobs_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Catalog(spark, sf_dir).source("lineitem")
    url = F.when(F.col("l_linenumber") % 3 == 0, "data:x").otherwise(F.concat(F.lit("u"), F.col("l_partkey").cast("string")))
    by_car = rows.groupBy(F.col("l_orderkey").cast("string").alias("car_id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", url.alias("url"))))["url"].alias("heroes"))
    recs = by_car.select("car_id", "heroes", F.lit(None).cast("string").alias("logo_url"), F.lit("m").alias("manufacturer_id"), F.array().cast("array<string>").alias("thumbs"))
    return ingest.image_jobs(recs)


@query("""select id, case when lower(image_path) like '%.jpe' then concat(substr(image_path, 1, length(image_path) - 4), '.jpg') else image_path end as image_path from car_images""")
def jpe_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanup.jpe_paths(Catalog(spark, sf_dir).table("car_images"), "image_path").select("id", "image_path")


@query("""select distinct lang as locale from documents""")
def distinct_sorted_locales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Catalog(spark, sf_dir).source("documents").select(F.col("lang").alias("locale")).distinct().orderBy("locale")


@query(f"""select distinct {FOLD.format("concat('É', p_name, p_type)")} as folded, nullif(trim(case when p_size % 2 = 0 then '' else p_type end), '') as present from part""")
def collation_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Catalog(spark, sf_dir).source("part")
    return p.select(collation.nocase(F.concat(F.lit("É"), "p_name", "p_type")).alias("folded"), collation.present(F.when(F.col("p_size") % 2 == 0, "").otherwise(F.col("p_type"))).alias("present")).distinct()


_LOST = "select '{t}' as \"table\", '{c}' as \"column\", {c} as value, count(*) as rows from {t} where {c} is not null{known} group by {c}"
_LOST_OF = [("manufacturer_i18n", "id", " and id not in (select id from manufacturers)"), ("cars", "manufacturer_id", " and manufacturer_id not in (select id from manufacturers)"), ("aspiration_i18n", "code", ""), ("drivetrain_i18n", "code", ""), *[(t, "car_id", " and car_id not in (select id from cars where cast(id as int) % 4 <> 1)") for t in ("car_specs", "car_texts", "car_images")]]


@query(" union all ".join(_LOST.format(t=t, c=c, known=k.replace("cars", "cars") if t != "cars" else k + " and cast(id as int) % 4 <> 1") for t, c, k in _LOST_OF))
def orphan_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a catalog that lacks a quarter of its cars, and both tables of codes."""

    class Lacking(Catalog):
        def table(self, name: str) -> DataFrame:
            df = super().table(name)
            return df.where("cast(id as int) % 4 <> 1") if name == "cars" else df

    return quality.orphans(Lacking(spark, sf_dir))


# Scripts, payloads and pages made of rows of part by expressions that both engines read.
_K, _N, _SIZE = "cast(p_partkey as string)", "p_name", "cast(p_size as string)"
_SCRIPT = f"""concat('/* cars */ const d = {{', 'car', {_K}, ': {{name: ', chr(39), {_N}, chr(39), ', pp: ', {_SIZE}, ', tags: [', {_SIZE}, ', "a",], on: !0, no: null}},}};export {{d as CarList}};')"""


@query(f"""select concat('car', {_K}) as car_id, concat('{{"name": "', {_N}, '", "pp": ', {_SIZE}, ', "tags": [', {_SIZE}, ', "a"], "on": true, "no": null}}') as payload from part""")
def script_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.from_scripts(Catalog(spark, sf_dir).source("part").select(F.expr(_SCRIPT).alias("text")))


_TOLD = f"""case when p_partkey % 2 = 0 then concat('let q = [{{id: "car', {_K}, '", hero: `', {_N}, '`}}, {{hero: 1}}]; export {{q as Descriptions}}') else concat('x = {{a: 1}}; y = {{car', {_K}, ': {{hero: "', {_N}, '"}}, other: {{}}}}') end"""


@query(f"""select concat('car', {_K}) as car_id, concat(case when p_partkey % 2 = 0 then concat('{{"id": "car', {_K}, '", ') else '{{' end, '"hero": "', {_N}, '"}}') as payload from part union all select 'other', '{{}}' from part where p_partkey % 2 = 1""".replace("{{", "{").replace("}}", "}"))
def script_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.from_scripts(Catalog(spark, sf_dir).source("part").select(F.expr(_TOLD).alias("text")), kind="descriptions")


_PAYLOAD = f"""concat('{{', case when p_partkey % 5 <> 0 then concat('"nameShort": "', {_N}, '", ') else '"nameShort": "", ' end, '"nameLong": "', {_N}, ' ', chr(39), right(cast(100 + p_size as string), 2), '", "manufacturerId": "', p_brand, '", "makerName": "maker ', p_brand, '", "countryId": "c', {_SIZE}, '", "driveTrain": "', case when p_partkey % 3 = 0 then '四驱' else 'f r' end, '", "aspirationShort": "', case when p_partkey % 4 = 0 then 'T' else 'NA' end, '", "carClass": null, "class": "', p_type, '", "pp": ', {_SIZE}, ', "logo": "/l', {_K}, '.png", "list": {{"small": "/s.png"}}, "main": ["/m', {_SIZE}, '.jpg", "/m', {_SIZE}, '.jpg", "data:image/png", "x.txt"], "specs": {{"Weight": "', {_SIZE}, ' kg"}}, "weight": 7, "length": "4 mm"}}')"""


@query(f"""select {_K} as car_id, p_brand as manufacturer_id, concat('maker ', p_brand) as maker, case when p_partkey % 5 <> 0 then {_N} else {_K} end as name, concat(case when p_size % 100 <= 29 then '20' else '19' end, right(cast(100 + p_size as string), 2)) as year, concat('c', {_SIZE}) as country_id,
    case when p_partkey % 4 = 0 then 'TC' else 'NA' end as aspiration_code, case when p_partkey % 3 = 0 then '4WD' else 'FR' end as drivetrain_code, p_type as car_class, {_SIZE} as pp, concat('Weight=', {_SIZE}, ' kg;Drivetrain=', case when p_partkey % 3 = 0 then '四驱' else 'f r' end, ';Length=4 mm') as specs, concat('/l', {_K}, '.png') as logo_url, concat('/m', {_SIZE}, '.jpg') as heroes, '/s.png' as thumbs from part""")
def record_builder(spark: SparkSession, sf_dir: str) -> DataFrame:
    cars = Catalog(spark, sf_dir).source("part").select(F.col("p_partkey").cast("string").alias("car_id"), F.expr(_PAYLOAD).alias("payload"))
    r = ingest.records(ingest.Bundle(cars=cars), "gb")
    specs_ = F.array_join(F.transform("specs", lambda x: F.concat(x["label"], F.lit("="), x["raw"])), ";")
    return r.select("car_id", "manufacturer_id", "maker", "name", "year", "country_id", "aspiration_code", "drivetrain_code", "car_class", "pp", specs_.alias("specs"), "logo_url", F.array_join("heroes", ",").alias("heroes"), F.array_join("thumbs", ",").alias("thumbs"))


_PAGE = f"""concat('<meta property="og:image" content="/i/car', {_K}, '.png"><main><h1> A &amp; ', {_N}, '</h1><h2>Maker ', p_brand, '</h2>', case when p_partkey % 3 = 0 then concat('<div><h4>A heading long enough ', {_K}, '</h4><p>Its <b>own</b> text ', {_SIZE}, '</div>') else concat('<p>short</p><p>A paragraph that is long: ', {_N}, '</p><p>And a second one, of size ', {_SIZE}, '.</p>') end, case when p_partkey % 2 = 0 then concat('<table><tr><th>Weight</th><td>', {_SIZE}, ' kg</td></tr><tr><td>alone</td></tr></table>') else concat('<dl><dt>Size</dt><dd>', {_SIZE}, '</dd></dl>') end, case when p_partkey % 5 <> 0 then concat('<img src="/x/car', {_K}, '_1.jpg"><img src="/thumbnails/car', {_K}, '.jpg">') else '' end, '</main>')"""


@query(f"""select p_partkey, concat('A & ', {_N}) as name, concat('Maker ', p_brand) as maker, case when p_partkey % 3 = 0 then concat('A heading long enough ', {_K}) else concat('A paragraph that is long: ', {_N}) end as intro, case when p_partkey % 3 = 0 then concat('Its own text ', {_SIZE}) else concat('And a second one, of size ', {_SIZE}, '.') end as detail,
    case when p_partkey % 2 = 0 then concat('Weight=', {_SIZE}, ' kg') else concat('Size=', {_SIZE}) end as specs, case when p_partkey % 5 <> 0 then concat('/x/car', {_K}, '_1.jpg') else concat('/i/car', {_K}, '.png') end as images from part""")
def page_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Catalog(spark, sf_dir).source("part").select("p_partkey", F.expr(_PAGE).alias("html"), F.concat(F.lit("car"), F.col("p_partkey").cast("string")).alias("car_id"))
    d = pages.with_details(p)
    specs_ = F.array_join(F.transform("detail.specs", lambda x: F.concat(x["label"], F.lit("="), x["raw"])), ";")
    return d.select("p_partkey", "detail.name", F.col("detail.manufacturer_name").alias("maker"), "detail.intro", "detail.detail", specs_.alias("specs"), F.array_join("detail.hero_images", ",").alias("images"))


_LIST_PAGE = f"""concat('<img src="/thumbnails/car', {_K}, '.png"><a href="/id/car', {_K}, '"><img src="t', {_SIZE}, '.png"></a><p>12 Cars, then ', {_SIZE}, ' car</p><script src="/assets/index-', {_K}, '.js"></script>')"""


@query(f"""select concat('car', {_K}) as car_id, 1 as pos, concat('/thumbnails/car', {_K}, '.png') as url from part union all select concat('car', {_K}), 2, concat('t', {_SIZE}, '.png') from part""")
def page_thumbnails(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Catalog(spark, sf_dir).source("part").select(F.expr(_LIST_PAGE).alias("html"))
    return p.lateralJoin(pages.Thumbnails(F.col("html").outer())).select("car_id", "pos", "url")


@query(f"""select p_partkey, concat('/assets/index-', {_K}, '.js') as script, greatest(12, p_size) as total from part""")
def page_scripts_and_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Catalog(spark, sf_dir).source("part").select("p_partkey", F.expr(_LIST_PAGE).alias("html"))
    return p.select("p_partkey", pages.first_script(F.col("html"), "/assets/index-[^\"]+").alias("script"), pages.site_total(F.col("html")).alias("total"))


_MODULES = f"""concat('"x/car7_1_', {_SIZE}, '.jpg": () => e(() => import("./m', {_K}, '.js"), []), "x/car8_1_1.jpg": () => e(() => import("./no.js"), [])', ' "/a/car7_1_', {_SIZE}, '-x.jpg" "/b/car7_1_', {_SIZE}, '-y.jpg"')"""


@query(f"""select p_partkey, concat('m', {_K}, '.js') as modules, concat('/a/car7_1_', {_SIZE}, '-x.jpg') as urls from part""")
def script_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.expr(_MODULES)
    return Catalog(spark, sf_dir).source("part").select("p_partkey", F.array_join(pages.hero_modules(m, "car7"), ",").alias("modules"), F.array_join(pages.hero_urls(m, "car7"), ",").alias("urls"))


_NEW_SPECS = "select id + 50000000 as id, car_id, locale, 'n' as spec_key, spec_value from car_specs where spec_key = 'max_power' and cast(car_id as int) % 3 = 0 and locale = 'cn'"


@query(f"""select id, car_id, locale, spec_key, spec_value from car_specs o where not exists (select 1 from ({_NEW_SPECS}) n where n.car_id = o.car_id and n.locale = o.locale) and not (cast(car_id as int) % 6 = 3) union all {_NEW_SPECS}""")
def replace_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = Catalog(spark, sf_dir).table("car_specs")
    third = old.where("cast(car_id as int) % 3 = 0")  # of these the even ones have new rows in cn, the odd ones none
    new = third.where("spec_key = 'max_power' and locale = 'cn'").withColumn("id", F.col("id") + 50000000).withColumn("spec_key", F.lit("n"))
    done = third.select("car_id").distinct().withColumn("locale", F.lit("cn"))
    return upsert.replace_specs(old, new, done).select("id", "car_id", "locale", "spec_key", "spec_value")


@query("""select car_id, image_path, image_type from car_images where sort_order <= 3 and cast(car_id as int) % 2 = 1 union all select car_id, image_path, image_type from car_images where sort_order > 3 and cast(car_id as int) % 2 = 0""")
def replace_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Catalog(spark, sf_dir).table("car_images")
    even = i.where("cast(car_id as int) % 2 = 0")
    return upsert.replace_images(i.where("sort_order <= 3"), even.where("sort_order > 3"), even.select("car_id").distinct()).select("car_id", "image_path", "image_type")


@query("""select code, locale, label from (select p_type as code, p_brand as locale, p_name as label, row_number() over (partition by p_type, p_brand order by p_partkey) as f, row_number() over (partition by p_type, p_brand order by p_partkey desc) as l from part) where case when locale in ('Brand#1', 'Brand#2') then f = 1 else l = 1 end""")
def labels_first_and_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Catalog(spark, sf_dir).source("part").select(F.col("p_type").alias("code"), F.col("p_brand").alias("locale"), F.col("p_name").alias("label"), F.col("p_partkey").alias("pos"))
    known = F.col("locale").isin("Brand#1", "Brand#2")
    none = spark.createDataFrame([], schema.struct("spec_code_i18n"))
    return upsert.set_labels(none, p.where(~known)).unionByName(upsert.add_labels(none, p.where(known)))


@query("""select code, coalesce(i.label, c.code) as label from (select distinct p_type as code from part) c left join (select p_type as code, min(p_name) as label from part where p_size > 40 group by 1) i using (code)""")
def code_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Catalog(spark, sf_dir).source("part")
    old = p.select(F.col("p_type").alias("code")).distinct().withColumn("default_name", F.col("code"))
    new = p.where("p_size > 40").groupBy(F.col("p_type").alias("code")).agg(F.min("p_name").alias("label")).select("code", F.lit("gb").alias("locale"), "label", F.col("label").alias("default_name"))
    codes_, _ = upsert.codes(old, spark.createDataFrame([], schema.struct("drivetrain_i18n")), new)
    return codes_.select("code", F.col("default_name").alias("label"))


@query("""select cast(n_nationkey as string) as iso3, 'cn' as locale, case when n_nationkey % 3 = 1 then concat('cn ', n_name) else n_name end as name from nation where n_nationkey % 3 = 1 or n_nationkey % 4 <> 0""")
def country_names_of_locale(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = Catalog(spark, sf_dir).source("nation").withColumn("iso3", F.col("n_nationkey").cast("string"))
    own = F.when(F.col("n_nationkey") % 3 == 1, F.concat(F.lit("cn "), "n_name")).when(F.col("n_nationkey") % 3 == 2, "")
    gb = F.when(F.col("n_nationkey") % 4 != 0, F.col("n_name"))
    both = n.select("iso3", F.lit("cn").alias("locale"), own.alias("name")).unionByName(n.select("iso3", F.lit("gb").alias("locale"), gb.alias("name"))).where("name is not null")
    return cleanup.country_names(both, "cn")


@query("""select page_id, case when page_id % 2 = 0 then url else 'https://b.example/x/y.js' end as absolute, case when page_id % 2 = 0 then url else 'https://b.example/assets/x/y.js' end as asset, page_id % 3 = 0 as image, case page_id % 3 when 0 then '.jpg' when 1 then '.png' else '.jpg' end as ext from pages""")
def url_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.when(F.col("page_id") % 2 == 0, F.col("url"))
    name = F.when(F.col("page_id") % 3 == 0, "a.JPEG").otherwise("a.txt")
    ext = F.when(F.col("page_id") % 3 == 0, " .JPE").when(F.col("page_id") % 3 == 1, ".PNG")
    return Catalog(spark, sf_dir).source("pages").select("page_id", text.absolute(F.coalesce(u, F.lit("x/y.js")), "https://b.example").alias("absolute"), text.asset_url(F.coalesce(u, F.lit("../x/y.js")), "https://b.example", "/assets/").alias("asset"), text.is_image(name).alias("image"), text.image_extension(ext).alias("ext"))


@query("""select cast(user_id as string) as car_id, concat('p/', cast(event_id as string)) as image_path, cast(event_id as int) as sort_order, case when event_id % 2 = 0 then 'hero' else 'thumb' end as image_type from events where event_type in ('view', 'click')""")
def image_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Catalog(spark, sf_dir).source("events")
    car, number = F.col("user_id").cast("string").alias("car_id"), F.col("event_id").cast("string")
    job = F.concat(F.when(F.col("event_id") % 2 == 0, "hero_").otherwise("thumb_"), number).alias("job_id")
    status = F.when(F.col("event_type") == "view", "ok").when(F.col("event_type") == "click", "skipped").otherwise("failed")
    return ingest.image_results(e.select(car, job), e.select(car, job, status.alias("status"), F.concat(F.lit("p/"), number).alias("path_rel")))


@query("""select car_id, image_path, image_type, row_number() over (partition by car_id order by case image_type when 'hero' then 0 when 'thumb' then 1 else 2 end, image_type, sort_order nulls last, image_path) as position from (
    select car_id, image_path, coalesce(nullif(image_type, ''), 'unknown') as image_type, sort_order from car_images)""")
def image_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Catalog(spark, sf_dir).table("car_images")
    return upsert.image_rows(i.limit(0), i).select("car_id", "image_path", "image_type", "position")


@query("""select p_type as code, 'gb' as locale, max(case when p_size > 40 then p_name end) as label from part where p_size > 40 or p_size < 5 group by p_type having max(case when p_size > 40 then p_name end) is not null
    union all select p_type, 'gb', min(p_name) from part where p_size > 40 or p_size < 5 group by p_type having max(case when p_size > 40 then p_name end) is null union all select distinct p_type, 'cn', 'other' from part where p_size < 5""")
def code_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Catalog(spark, sf_dir).source("part").select(F.col("p_type").alias("code"), F.lit("gb").alias("locale"), F.col("p_name").alias("label"), "p_size")
    old = p.where("p_size < 5").groupBy("code", "locale").agg(F.min("label").alias("label"))
    old = old.unionByName(old.select("code", F.lit("cn").alias("locale"), F.lit("other").alias("label")))
    new = p.where("p_size > 40").groupBy("code", "locale").agg(F.max("label").alias("label")).withColumn("default_name", F.lit(None).cast("string"))
    return upsert.codes(spark.createDataFrame([], schema.struct("drivetrain_codes")), old, new)[1]


# Detail, dataset and stream queries that go through files in the shared folder.


def _lake(spark: SparkSession, tables: dict[str, DataFrame], at: str | None = None) -> Lake:
    """A dataset of its own that holds tables."""
    lake = Lake(spark, at or shared.new(spark, "dataset"))
    for name, df in tables.items():
        lake.write(name, df)
    return lake


@query(_DETAIL)
def detail_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Catalog(spark, sf_dir)
    at = shared.new(spark, "buckets")
    b = detail.Bucketed(c, at, f"buckets_{at[-8:]}").write(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return _details(detail.details(b, b.table("cars").select("id"), "cn"))


@query("""select s.car_id as id, 'spec' as kind, s.spec_key as key, coalesce(l.label, s.spec_key) as label, s.spec_value as value, row_number() over (partition by s.car_id order by sort_order, spec_key, coalesce(l.label, s.spec_key), spec_value) as pos from car_specs s left join (select * from spec_code_i18n where locale = 'cn') l on l.code = s.spec_key where s.locale = 'cn'
    union all select car_id, 'image', image_type, null, image_path, row_number() over (partition by car_id order by image_type, sort_order, image_path) from car_images where car_id in (select id from cars)""")
def detail_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Catalog(spark, sf_dir)
    d = detail.details(c, c.table("cars").select("id"), "cn")
    row = lambda kind, key, label, value: lambda s, i: F.struct(F.lit(kind).alias("kind"), s[key].alias("key"), label(s).alias("label"), s[value].alias("value"), (i + 1).cast("long").alias("pos"))
    of_spec = F.transform("specs", row("spec", "spec_key", lambda s: s["label"], "spec_value"))
    of_image = F.transform("images", row("image", "image_type", lambda s: F.lit(None).cast("string"), "image_path"))
    return d.select("id", F.inline(F.concat(of_spec, of_image)))


@query("""select c.id, coalesce(mi.name, m.name) as maker, case when cast(c.id as int) % 2 = 0 then c.drivetrain_code end as drivetrain from cars c left join manufacturers m on m.id = c.manufacturer_id left join (select * from manufacturer_i18n where locale = 'cn') mi on mi.id = m.id""")
def mixed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the cars in files without codes, as an older dataset has them, the others appended with all columns."""
    c = Catalog(spark, sf_dir)
    cars = c.table("cars")
    lake = _lake(spark, {"cars": cars.where("cast(id as int) % 2 = 1").select("id", "name", "manufacturer_id"), "manufacturers": c.table("manufacturers"), "manufacturer_i18n": c.table("manufacturer_i18n")}).create()
    lake.append("cars", cars.where("cast(id as int) % 2 = 0"))
    out = lake.table("cars").join(lists.named_makers(lake, "cn"), F.col("manufacturer_id") == F.col("_m"), "left")
    return out.select("id", "maker", F.col("drivetrain_code").alias("drivetrain"))


@query("""select car_id, locale, name, locale = 'gb' as untouched from car_texts where locale = 'gb' union all select concat('n', car_id), 'cn', upper(name), false from car_texts where locale = 'cn' and cast(car_id as int) % 2 = 0""")
def merge_locale_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """untouched: whether a row's file was there before the locale was merged."""
    texts = Catalog(spark, sf_dir).table("car_texts")
    new = texts.where("locale = 'cn' and cast(car_id as int) % 2 = 0").withColumn("car_id", F.concat(F.lit("n"), "car_id")).withColumn("name", F.upper("name"))
    target, source = _lake(spark, {"car_texts": texts}).create(), _lake(spark, {"car_texts": new}).create()
    before = shared.written(target.table("car_texts").select(F.col("_metadata.file_name").alias("file")).distinct())
    merge.merge_locale(target, source, "cn")
    rows = target.table("car_texts").select("car_id", "locale", "name", F.col("_metadata.file_name").alias("file"))
    return rows.join(F.broadcast(before.withColumn("untouched", F.lit(True))), "file", "left").select("car_id", "locale", "name", F.coalesce("untouched", F.lit(False)).alias("untouched"))


_OF = {"gb": "sort_order <= 2", "cn": "sort_order in (2, 3, 4)", "fr": "sort_order >= 4"}


@query(f"""select i.car_id, i.image_path, i.image_type, x from (select *, min(x) over (partition by car_id, image_path, coalesce(image_type, '')) as first from (select car_id, image_path, image_type, 1 as x from car_images where {_OF['gb']} union all select car_id, image_path, image_type, 2 from car_images where {_OF['cn']} union all select car_id, image_path, image_type, 3 from car_images where {_OF['fr']}) q) i where x = first""")
def merge_three_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of three datasets; x tells by the order of their names in the merge whose they are."""
    c, folder = Catalog(spark, sf_dir), shared.new(spark, "datasets")
    for n, (locale, where) in enumerate(_OF.items(), 1):
        images = c.table("car_images").where(where).withColumn("id", F.lit(n).cast("long"))
        _lake(spark, {"cars": c.table("cars").where(f"cast(id as int) % {n} = 0"), "car_images": images}, f"{folder}/locale={locale}").create()
    out = merge.merge(folder, shared.new(spark, "merged"), spark, base="gb")
    return out.table("car_images").select("car_id", "image_path", "image_type", F.col("id").cast("int").alias("x"))


@query(f"""select 'refused' as dataset, car_id, image_path from car_images where sort_order = 1 union all select 'accepted', car_id, image_path from car_images where sort_order > 1 union all select 'code', cast(case when (select count(*) from {_HEROES.replace("where image_type = 'hero'", "where image_type = 'hero' and sort_order > 1")} where {_REASON} is not null) = 0 then 0 else 3 end as string), null""")
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same images written in strict mode, which leaves the old ones, and without a check."""
    c = Catalog(spark, sf_dir)
    images = c.table("car_images")
    parts = []
    for mode, name in (("strict", "refused"), ("off", "accepted")):
        lake = _lake(spark, {"cars": c.table("cars"), "car_images": images.where("sort_order = 1")})
        code = quality.load_images(lake, images.where("sort_order > 1"), c.table("manifest"), 2, mode)
        parts.append(lake.table("car_images").select(F.lit(name).alias("dataset"), "car_id", "image_path"))
        if mode == "strict":
            parts.append(spark.range(1).select(F.lit("code").alias("dataset"), F.lit(str(code)).alias("car_id"), F.lit(None).cast("string").alias("image_path")))
    return reduce(DataFrame.unionByName, parts)


_NESTED = f"""concat('{{"a": {{"b": [{{"img": "/b', {_K}, '.PNG", "no": "x"}}, ["/c', {_SIZE}, '.webp", {{"deep": {{"er": ["image/', {_K}, '"]}}}}]]}}, "s": "{{not.jpg', {_K}, '", "t": "[1", "n": null, "x": ', {_SIZE}, case when p_partkey % 3 = 0 then ', "logo": "/l.jpeg"' else '' end, case when p_partkey % 7 = 0 then '' else '}}' end)"""


@query(f"""select id, i + 1 as pos, paths[i + 1] as path, urls[i + 1] as url from (select {_K} as id, unnest(range(case when p_partkey % 3 = 0 then 4 else 3 end)) as i, ['a.b.0.img', 'a.b.1.0', 'a.b.1.1.deep.er.0', 'logo'] as paths, ['/b' || {_K} || '.PNG', '/c' || {_SIZE} || '.webp', 'image/' || {_K}, '/l.jpeg'] as urls from part where p_partkey % 7 <> 0) q""")
def payload_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses at several depths with their paths, in the order of the text; a seventh of the payloads is cut short."""
    p = Catalog(spark, sf_dir).source("part").select(F.expr(_K).alias("id"), F.expr(_NESTED).alias("payload"))
    return p.select("id", F.posexplode(image_urls(F.col("payload"))).alias("i", "u")).select("id", (F.col("i") + 1).cast("long").alias("pos"), "u.path", "u.url")


_STATE = "case when p_partkey % 11 = 0 then '[1]' when p_partkey % 13 = 0 then null else " + _PAYLOAD + " end"


@query(f"""select {_K} as car_id, case when p_partkey % 11 = 0 or p_partkey % 13 = 0 then 'failed' else 'success' end as status, case when p_partkey % 11 = 0 or p_partkey % 13 = 0 then 'payload is no object' else '' end as message from part where p_partkey % 2 = 0 or p_partkey % 11 = 0 or p_partkey % 13 = 0
    union all select concat('absent', {_K}), 'failed', 'neither payload nor page' from part where p_partkey % 17 = 0 union all select 'bad.js', 'failed', 'no car data in script' union all select {_K}, 'failed', 'page could not be read' from part where p_partkey % 19 = 0""")
def build_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a build of listed cars, of which some have bad payloads, bad pages or nothing at all."""
    part = Catalog(spark, sf_dir).source("part")
    bad = "p_partkey % 11 = 0 or p_partkey % 13 = 0"
    cars = part.where(f"p_partkey % 2 = 0 or {bad}").select(F.expr(_K).alias("car_id"), F.expr(_STATE).alias("payload"))
    listed = part.where(f"p_partkey % 2 = 0 or {bad}").select(F.expr(_K).alias("id")).union(part.where("p_partkey % 17 = 0").select(F.expr(f"concat('absent', {_K})"))).withColumn("pos", F.monotonically_increasing_id())
    scripts = spark.createDataFrame([("bad.js", "let x = 1")], "name string, text string")
    pages_ = part.where("p_partkey % 19 = 0").select(F.expr(_K).alias("car_id"), F.lit(None).cast("string").alias("html"))
    lake = Lake(spark, shared.new(spark, "built"))
    ingest.build_locale(lake, ingest.Bundle(cars=cars, pages=pages_, failures=ingest.bad_scripts(scripts, "name")), "gb", options=ingest.Options(listed=listed))
    return lake.table("fetch_log").select("car_id", "status", "message")


def _followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last states that the stream leaves of the log: two files, a stop, two more and the first once again, and a start from the same checkpoint."""
    log, at = Catalog(spark, sf_dir).table("fetch_log"), shared.new(spark, "stream")
    files = log.repartitionByRange(4, "id").sortWithinPartitions("id")
    files = shared.written(files.withColumn("_part", F.spark_partition_id()))
    for parts in ((0, 1), (2, 3, 0)):
        for n in parts:
            files.where(F.col("_part") == n).drop("_part").coalesce(1).write.mode("append").parquet(f"{at}/log")
        fetch_log.into_table(fetch_log.read(spark, f"{at}/log", 2), f"{at}/states", f"{at}/checkpoint").awaitTermination()
    return fetch_log.states(spark, f"{at}/states")


@query("""select car_id, locale, arg_max(status, id) as status, max(id) as id from fetch_log group by car_id, locale""")
def stream_latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _followed(spark, sf_dir)


@query("""select cast(c_custkey as string) as id from customer where cast(c_custkey as string) not in (select car_id from (select car_id, arg_max(status, id) as status from fetch_log group by car_id) where status = 'purchase')""")
def stream_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left to do by the states that the stream leaves."""
    states = _followed(spark, sf_dir).withColumn("status", F.when(F.col("status") == "purchase", "success").otherwise(F.col("status")))
    return quality.pending(Catalog(spark, sf_dir).source("customer").select(F.col("c_custkey").cast("string").alias("id")), states, "gb")
