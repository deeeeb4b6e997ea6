"""Payloads, descriptions and pages of one locale into a dataset, and datasets of all locales into one."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from polycat.extract import html as pages_
from polycat.extract import js
from polycat.extract.payload import fields, image_urls, pick
from polycat.functions.codes import aspiration_code, aspiration_label, drivetrain_code, year_of
from polycat.functions.collation import present, strip
from polycat.functions.specs import infer_code, normalize_specs
from polycat.functions.text import slugify
from polycat.operators import cleanup, merge, upsert
from polycat.plans import quality
from polycat.sources import files
from polycat.sources.lake import Lake
from polycat.sources.shared import written

# Names under which payloads hold a field, in order of preference, and labels of single specifications.
MAKER = ["maker", "makerName", "manufacturer", "manufacturerName", "brand", "brandName"]
NAME = ["nameShort", "name", "carName", "model"]
LONG_NAME = ["nameLong", "carNameLong"]
SINGLE_SPECS = {"displacement": "Displacement", "driveTrain": "Drivetrain", "drivetrain": "Drivetrain", "maxPower": "Max Power", "maxTorque": "Max Torque", "weight": "Weight", "aspirationLong": "Aspiration", "length": "Length", "width": "Width", "height": "Height"}
CAR_EXPORTS, TUNER_EXPORTS, ID_EXPORTS, DESCRIPTION_EXPORTS = ["CarList", "Cars", "CarData"], ["TunerList", "Tuners"], ["CarIds", "IdList"], ["Descriptions", "Description", "CarDescriptions", "DescriptionsData"]


@dataclass
class Bundle:
    """What is known of a locale: cars (car_id, payload), descriptions (car_id, payload), tuners (id, name), pages (car_id, html), labels (locale, label, code), iso (country_id, iso3), countries (iso3, locale, name), thumbs (car_id, urls)."""

    cars: DataFrame
    descriptions: DataFrame | None = None
    tuners: DataFrame | None = None
    pages: DataFrame | None = None
    labels: DataFrame | None = None
    iso: DataFrame | None = None
    countries: DataFrame | None = None
    thumbs: DataFrame | None = None
    images: DataFrame | None = None  # (car_id, image_path, sort_order, image_type), as image_results() gives them
    site_total: int | None = None  # how many cars the site says it has
    failures: DataFrame | None = None  # (car_id, message): what could not be read before


@dataclass
class Options:
    """What a build works on: all cars or a limit or a list (pos, id) of them, all or those without a success yet, and whose images it keeps."""

    limit: int = 0
    listed: DataFrame | None = None
    resume: bool = False
    image_policy: str = "base-only"

    def __post_init__(self):
        if self.image_policy not in IMAGE_POLICIES:
            raise ValueError(f"unknown image policy {self.image_policy}; one of {', '.join(IMAGE_POLICIES)}")

    def images_of(self, first: bool) -> bool:
        """Whether the base locale (first) or another keeps images."""
        return first in IMAGE_POLICIES[self.image_policy]


# For each policy, whether the base locale (True) and others (False) keep images.
IMAGE_POLICIES = {"base-only": (True,), "all-locales": (True, False), "none": ()}


def from_scripts(scripts: DataFrame, column: str = "text", kind: str = "cars", strict: bool = True) -> DataFrame:
    """car_id, payload of the entries that scripts export. Where a car script holds no object, as nothing can be built from it, this raises if strict; else the script has no entries, and bad_scripts() names it."""
    fn = js.descriptions(DESCRIPTION_EXPORTS) if kind == "descriptions" else js.entries(CAR_EXPORTS if kind == "cars" else TUNER_EXPORTS)
    found = fn(F.col(column))
    if kind == "cars" and strict:
        found = F.when(found.isNull(), F.raise_error(F.lit("no car data in script"))).otherwise(found)
    return scripts.select(F.explode(found).alias("car_id", "payload"))


def bad_scripts(scripts: DataFrame, name: str, column: str = "text") -> DataFrame:
    """car_id (a script's name), message of the car scripts that hold no object."""
    return scripts.where(js.entries(CAR_EXPORTS)(F.col(column)).isNull()).select(F.col(name).alias("car_id"), F.lit("no car data in script").alias("message"))


def from_folder(spark: SparkSession, folder: str, locale: str) -> Bundle:
    """A locale's bundle from files: <locale>/cars.js or a folder of them, cars/, descriptions.js, tuners.js, labels.json, index.html (which says how many cars there are), pages/<car id>.html and images/cars/<car id>/<car id>_<kind>_<number>.<ext>, and iso.json and countries.json beside the locales. Only car scripts must be there; of a folder of them, those that hold no cars are failures."""
    at = f"{folder.rstrip('/')}/{locale}"
    there = lambda path: Lake(spark, path).exists()
    script = lambda n: spark.read.text(f"{at}/{n}", wholetext=True).withColumnRenamed("value", "text")
    if there(f"{at}/cars"):
        scripts = script("cars").withColumn("name", F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1))
        out = Bundle(cars=from_scripts(scripts, strict=False), failures=bad_scripts(scripts, "name"))
    elif there(f"{at}/cars.js"):
        out = Bundle(cars=from_scripts(script("cars.js")))
    else:
        raise FileNotFoundError(f"no cars.js in {at}")
    if there(f"{at}/index.html"):
        out.site_total = script("index.html").select(pages_.site_total(F.col("text"))).first()[0]
    if there(f"{at}/images"):
        out.images = image_files(spark, f"{at}/images")
    if there(f"{at}/descriptions.js"):
        out.descriptions = from_scripts(script("descriptions.js"), kind="descriptions")
    if there(f"{at}/tuners.js"):
        out.tuners = from_scripts(script("tuners.js"), kind="tuners").select(F.col("car_id").alias("id"), F.coalesce(pick(fields(F.col("payload")), ["name", "nameShort"]), F.regexp_extract("payload", '^"(.*)"$', 1)).alias("name"))
    if there(f"{at}/pages"):
        pages = spark.read.text(f"{at}/pages", wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.html$", 1).alias("car_id"), F.col("value").alias("html"))
        out.pages = pages.where("car_id != ''")
    if there(f"{at}/labels.json"):
        out.labels = files.label_map(spark, {locale: f"{at}/labels.json"})
    if there(f"{folder}/iso.json"):
        out.iso = files.string_map(spark, f"{folder}/iso.json", "country_id", "iso3")
    if there(f"{folder}/countries.json"):
        out.countries = files.nested_map(spark, f"{folder}/countries.json", "iso3", "locale", "name")
    return out


def payload_specs(found: Column) -> Column:
    """array<struct<label, raw>> of a payload's fields: the spec object, else the specs object, else the specs list, then single fields; each label once."""
    entries = lambda c: F.transform(F.map_entries(F.from_json(c, "map<string,string>")), lambda e: F.struct(e["key"].alias("label"), e["value"].alias("raw")))
    spec, specs = F.try_element_at(found, F.lit("spec")), F.try_element_at(found, F.lit("specs"))
    listed = F.transform(F.filter(F.from_json(specs, "array<struct<key:string,value:string>>"), lambda x: x["key"].isNotNull() & x["value"].isNotNull()), lambda x: F.struct(x["key"].alias("label"), x["value"].alias("raw")))
    none = F.array().cast("array<struct<label:string,raw:string>>")
    given = F.when(spec.startswith("{"), entries(spec)).when(specs.startswith("{"), entries(specs)).when(specs.startswith("["), listed).otherwise(none)
    single = F.array(*[F.struct(F.lit(label).alias("label"), F.try_element_at(found, F.lit(k)).alias("raw")) for k, label in SINGLE_SPECS.items()])
    every = F.concat(F.coalesce(given, none), F.filter(single, lambda x: x["raw"].isNotNull()))
    # bound to a variable, so that the list is made once and not for each of its rows
    first = lambda rows: F.filter(rows, lambda x, i: F.array_position(rows["label"], x["label"]) == i + 1)
    return F.element_at(F.transform(F.array(every), first), 1)


def image_files(spark: SparkSession, folder: str) -> DataFrame:
    """car_id, image_path, sort_order, image_type of the images in a folder, by their names alone."""
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    part = lambda i: F.regexp_extract("path", r"/(cars/([^/]+)/[^/]*_([A-Za-z]+)_([0-9]+)\.[^/.]+)$", i)
    return paths.select(part(2).alias("car_id"), part(1).alias("image_path"), part(4).try_cast("int").alias("sort_order"), part(3).alias("image_type")).where("car_id != ''")


def urls_of(images: Column, kind: str) -> Column:
    """Logos, thumbs or heroes among a payload's image addresses, by their paths; each once."""
    path = lambda x: F.lower(x["path"])
    logo, thumb = (lambda x: path(x).contains("logo")), (lambda x: path(x).rlike("thumb|list|card|small"))
    keep = {"logo": logo, "thumb": lambda x: ~logo(x) & thumb(x), "hero": lambda x: ~logo(x) & ~thumb(x)}[kind]
    return F.array_distinct(F.transform(F.filter(images, keep), lambda x: x["url"]))


def records(bundle: Bundle, locale: str) -> DataFrame:
    """One row for each car with all its fields by their order of preference, specs as pairs and image addresses.

    The maker is the tuner table's, then the payload's, and the page's over both; the name the payload's, the id, and the
    page's over both; texts are the description's and the page fills gaps; the page's specs replace the payload's, its
    images only if there are more of them. A payload is parsed once, into the map of its fields; what a bundle lacks is
    not joined.
    """
    null = lambda kind: F.lit(None).cast(kind)
    p, f, d = F.col("payload"), F.col("_f"), F.col("_df")
    out = bundle.cars.select("car_id", "payload").dropDuplicates(["car_id"]).withColumn("_f", fields(p)).withColumn("_maker_id", pick(f, ["manufacturerId"])).withColumn("_images", image_urls(p))

    def joined(out: DataFrame, side: DataFrame | None, key: str, column: str, kind: str) -> DataFrame:
        """out with a column of side (key, column), null where it has none."""
        return out.withColumn(column, null(kind)) if side is None else out.join(side.dropDuplicates([key]), key, "left")

    tuners = None if bundle.tuners is None else bundle.tuners.select(F.col("id").alias("_maker_id"), F.col("name").alias("_tuner"))
    told = None if bundle.descriptions is None else bundle.descriptions.select("car_id", fields(p).alias("_df"))
    pages = None if bundle.pages is None else pages_.with_details(bundle.pages).select("car_id", F.col("detail").alias("_page"))
    thumbs = None if bundle.thumbs is None else bundle.thumbs.select("car_id", F.col("urls").alias("_thumbs"))
    out = joined(out, tuners, "_maker_id", "_tuner", "string")
    out = joined(out, told, "car_id", "_df", "map<string,string>")
    out = joined(out, pages, "car_id", "_page", f"struct<{pages_.DETAIL.replace(' ', ':').replace(',:', ', ')}>")
    out = joined(out, thumbs, "car_id", "_thumbs", "array<string>")

    # what is used more than once has a column of its own, so that it is worked out once
    page = lambda c: present(F.col(f"_page.{c}"))
    picked = {"maker": MAKER, "own": NAME, "long": LONG_NAME, "year": ["year", "productionYear"], "raw": ["aspirationLong", "aspiration"], "short": ["aspirationShort"], "drive": ["driveTrain"], "class": ["carClass", "class"], "pp": ["pp", "performance", "performancePoint"], "country": ["countryId"]}
    urls = F.array().cast("array<string>")
    out = out.withColumns({f"_{c}": pick(f, names) for c, names in picked.items()} | {f"_{k}": urls_of(F.col("_images"), k) for k in ("logo", "hero", "thumb")} | {"_specs": payload_specs(f), "_page_heroes": F.coalesce("_page.hero_images", urls)})
    out = out.withColumns({"_maker": F.coalesce(page("manufacturer_name"), present(F.col("_tuner")), "_maker", F.lit("Unknown")), "_own": F.coalesce("_own", "car_id"), "_short": strip(F.coalesce("_short", "_raw")), "_drive": strip(F.col("_drive"))})
    drop_data = lambda c: F.filter(c, lambda u: ~u.startswith("data:") & (u != ""))
    return out.select(
        "car_id",
        F.coalesce("_maker_id", slugify(F.col("_maker"))).alias("manufacturer_id"),
        F.col("_maker").alias("maker"),
        F.coalesce(page("name"), "_own").alias("name"),
        F.coalesce("_year", year_of(F.coalesce("_long", "_own"))).alias("year"),
        F.col("_country").alias("country_id"),
        F.col("_raw").alias("aspiration_raw"),
        aspiration_code(F.col("_short")).alias("aspiration_code"),
        aspiration_label(F.col("_raw")).alias("aspiration_label"),
        drivetrain_code(F.col("_drive")).alias("drivetrain_code"),
        F.coalesce(pick(d, ["hero"]), page("intro")).alias("intro"),
        F.coalesce(pick(d, ["desc"]), page("detail")).alias("detail"),
        F.col("_class").alias("car_class"),
        F.col("_pp").alias("pp"),
        p.alias("raw_json"),
        F.when(F.size(F.coalesce("_page.specs", F.array().cast("array<struct<label:string,raw:string>>"))) > 0, F.col("_page.specs")).otherwise(F.col("_specs")).alias("specs"),
        F.get("_logo", F.lit(0)).alias("logo_url"),
        drop_data(F.when(F.size("_page_heroes") > F.size("_hero"), F.col("_page_heroes")).otherwise(F.col("_hero"))).alias("heroes"),
        drop_data(F.when(F.size(F.coalesce("_thumbs", urls)) > 0, F.col("_thumbs")).otherwise(F.col("_thumb"))).alias("thumbs"),
    )


def failures(bundle: Bundle, listed: DataFrame | None = None) -> DataFrame:
    """car_id, message of everything that can't be read: payloads that are no object, pages without text, listed ids (id) that have neither payload nor page, and what the bundle brings along."""
    cars = bundle.cars.select("car_id", "payload")
    out = cars.where(fields(F.col("payload")).isNull()).select("car_id", F.lit("payload is no object").alias("message"))
    if bundle.pages is not None:
        out = out.unionByName(bundle.pages.where("html is null and car_id is not null").select("car_id", F.lit("page could not be read").alias("message")))
    if listed is not None:
        known = cars.select("car_id") if bundle.pages is None else cars.select("car_id").union(bundle.pages.where("html is not null").select("car_id"))
        out = out.unionByName(listed.select(F.col("id").alias("car_id")).distinct().join(known.distinct(), "car_id", "left_anti").select("car_id", F.lit("neither payload nor page").alias("message")))
    if bundle.failures is not None:
        out = out.unionByName(bundle.failures.select("car_id", "message"))
    return out.distinct()


def image_jobs(recs: DataFrame) -> DataFrame:
    """car_id, job_id, url, dest_rel for logos, heroes and thumbs. Numbers count all addresses of a kind from 1, also those left out, so that they may have gaps."""
    logo = recs.where(F.col("logo_url").isNotNull() & ~F.col("logo_url").startswith("data:")).select("car_id", F.lit("logo").alias("job_id"), F.col("logo_url").alias("url"), F.concat(F.lit("manufacturers/"), "manufacturer_id", F.lit("/logo")).alias("dest_rel"))
    out = logo
    for kind in ("hero", "thumb"):
        rows = recs.select("car_id", F.posexplode("heroes" if kind == "hero" else "thumbs").alias("_i", "url")).where(F.col("url").isNotNull() & (F.col("url") != "") & ~F.col("url").startswith("data:"))
        n = F.col("_i") + 1
        out = out.union(rows.select("car_id", F.concat(F.lit(f"{kind}_"), n.cast("string")), "url", F.format_string(f"cars/%s/%s_{kind}_%02d", "car_id", "car_id", n)))
    return out


def image_results(jobs: DataFrame, results: DataFrame) -> DataFrame:
    """car_id, image_path, sort_order, image_type of jobs that ended well: results are (car_id, job_id, status, path_rel)."""
    done = jobs.select("car_id", "job_id").join(results, ["car_id", "job_id"]).where(F.col("status").isin("ok", "skipped") & present(F.col("path_rel")).isNotNull())
    number = F.regexp_extract("job_id", "_([0-9]+)$", 1)
    return done.where("job_id != 'logo'").select("car_id", F.col("path_rel").alias("image_path"), number.cast("int").alias("sort_order"), F.substring_index("job_id", "_", 1).alias("image_type"))


def choose(ids: DataFrame | None, listed: DataFrame | None = None, limit: int = 0) -> DataFrame:
    """pos, id to work on: a list replaces the catalog's ids, then a positive limit cuts."""
    out = listed if listed is not None else ids
    return out.orderBy("pos").limit(limit) if limit > 0 else out


def chosen(bundle: Bundle, options: Options, log_rows: DataFrame, locale: str) -> Bundle:
    """bundle with the cars to work on. A list replaces the catalog's ids: listed ids without payload are built from their page, if they have one; then a limit cuts, and with resume what already ended well is left out."""
    cars = bundle.cars.select("car_id", "payload").dropDuplicates(["car_id"])
    if options.listed is not None:
        ids = choose(None, options.listed, options.limit).select(F.col("id").alias("car_id")).distinct()
        cars = ids.join(cars.withColumn("_known", F.lit(True)), "car_id", "left")
        if bundle.pages is not None:
            read = bundle.pages.where("html is not null").select("car_id", F.lit(True).alias("_read")).distinct()
            cars = cars.join(read, "car_id", "left").withColumn("payload", F.when(F.col("_known").isNull() & F.col("_read").isNotNull(), "{}").otherwise(F.col("payload")))
        cars = cars.where("_known is not null or payload is not null").select("car_id", "payload")
    elif options.limit > 0:
        cars = cars.orderBy("car_id").limit(options.limit)
    if options.resume:
        left = quality.pending(cars.select(F.col("car_id").alias("id")), log_rows, locale).select(F.col("id").alias("car_id"))
        cars = cars.join(left, "car_id", "left_semi")
    return replace(bundle, cars=cars)


def build_locale(lake: Lake, bundle: Bundle, locale: str, base: str = "gb", resume: bool = False, options: Options | None = None) -> int:
    """Writes a locale's records into a dataset; 0 if all went well, 2 if the dataset's cars are not as many as the site says it has.

    The base locale sets canonical names and texts; others add their overlays but set codes and makers. What can't be
    read fails by itself: it gets a log row that says why, and all else is built; a car that is built in spite of an
    unreadable page gets its success after that. The count is compared for whole builds only, not with a limit or a list; the
    dataset's facts "status" and "built_cars" say how it went.

    Records and normalized specifications are written once to the shared folder and read from there by all tables' writes. Only the
    locale's partitions of the localized tables are written; the log is appended to.
    """
    options = options or Options(resume=resume)
    spark, first = lake.spark, locale == base
    lake.create(images=options.images_of(first) and bundle.images is not None)
    bundle = chosen(bundle, options, lake.table("fetch_log"), locale)
    failed = failures(bundle, None if options.listed is None else choose(None, options.listed, options.limit))
    if options.resume:
        failed = failed.join(quality.pending(failed.select(F.col("car_id").alias("id")), lake.table("fetch_log"), locale).select(F.col("id").alias("car_id")), "car_id", "left_semi")
    failed = written(failed)
    cars = bundle.cars.where(fields(F.col("payload")).isNotNull())
    if options.resume and not cars.limit(1).count() and not failed.limit(1).count():
        return 0
    labels = bundle.labels if bundle.labels is not None else spark.createDataFrame([], "locale string, label string, code string")
    recs = records(replace(bundle, cars=cars), locale)
    recs = written(recs)
    pairs = recs.select("car_id", F.lit(locale).alias("locale"), F.posexplode("specs").alias("pos", "_s")).select("car_id", "locale", "pos", F.col("_s.label").alias("label"), F.col("_s.raw").alias("raw"))
    # drivetrain and aspiration given as specifications fill the codes that are missing, and are no specifications of their own
    code = _code_of(pairs, labels)
    said = lambda kind: F.min_by(strip(F.col("raw")), F.when(F.col("_code") == kind, F.col("pos")))
    side = code.where(F.col("_code").isin("drivetrain", "aspiration")).groupBy("car_id").agg(said("drivetrain").alias("_drive"), said("aspiration").alias("_breath"))
    kept = written(normalize_specs(code.where(~F.coalesce("_code", F.lit("")).isin("drivetrain", "aspiration")).select(pairs.columns), labels))
    recs = recs.join(side, "car_id", "left").withColumn("drivetrain_code", F.coalesce("drivetrain_code", drivetrain_code(F.col("_drive")))).withColumn("aspiration_code", F.coalesce("aspiration_code", aspiration_code(F.coalesce("aspiration_raw", "_breath"))))
    recs = written(recs)
    log(lake, failed, locale, "failed")
    write(lake, recs, kept, labels, locale, first)
    if bundle.iso is not None:
        lake.write("country_iso_map", bundle.iso.select("country_id", "iso3"))
    if bundle.countries is not None:
        lake.write("country_i18n", cleanup.country_names(bundle.countries, locale))
    lake.write("manufacturers", cleanup.manufacturer_names(lake.table("manufacturers"), lake.table("manufacturer_i18n"), base))
    if options.images_of(first) and bundle.images is not None:
        write_images(lake, bundle.images.join(recs.select("car_id"), "car_id", "left_semi"), keep_better=not first)
    made = lake.table("cars").count()
    whole = options.limit <= 0 and options.listed is None
    wrong = whole and bundle.site_total is not None and made != bundle.site_total
    lake.set_meta(status="count_mismatch" if wrong else "ok", built_cars=str(made))
    return 2 if wrong else 0


def write_images(lake: Lake, images: DataFrame, keep_better: bool) -> None:
    """Replaces the images of the cars in images; with keep_better, kinds of which there are fewer new ones stay as they are."""
    old, new = lake.get("car_images"), images
    if keep_better:
        new = upsert.image_rows(old.join(images.select("car_id").distinct(), "car_id", "left_semi"), images)
    last = old.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    rows = new.select((F.monotonically_increasing_id() + last + 1).alias("id"), "car_id", "image_path", "sort_order", "image_type")
    lake.write("car_images", upsert.replace_images(old, rows, images.select("car_id").distinct()))


def log(lake: Lake, cars: DataFrame, locale: str, status: str) -> None:
    """Appends a log row for each of cars (car_id, message); ids go on from the largest."""
    last = lake.table("fetch_log").agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    lake.append("fetch_log", cars.select((F.monotonically_increasing_id() + last + 1).alias("id"), "car_id", F.lit(status).alias("status"), "message", now.alias("updated_at"), F.lit(locale).alias("locale")))


def _code_of(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """pairs with _code: what their label or form says, null if neither says anything."""
    known = labels.groupBy("locale", F.col("label").alias("_label")).agg(F.min("code").alias("_known"))
    return pairs.withColumn("_label", strip(F.col("label"))).join(known, ["locale", "_label"], "left").withColumn("_code", F.coalesce("_known", infer_code(F.col("raw"))))


def write(lake: Lake, recs: DataFrame, specs: DataFrame, labels: DataFrame, locale: str, first: bool) -> None:
    """Upserts records and specifications of a locale into the dataset's tables, and logs each car."""
    here = F.lit(locale).alias("locale")
    own = lambda t: lake.table(t).where(F.col("locale") == locale)
    country = F.col("country_id") if first else F.lit(None).cast("string")
    makers = recs.groupBy(F.col("manufacturer_id").alias("id")).agg(F.min_by("maker", "car_id").alias("name"), F.lit(None).cast("string").alias("logo_path"), F.min_by(country, "car_id").alias("country_id"))
    lake.write("manufacturers", upsert.manufacturers(lake.table("manufacturers"), makers, first))
    lake.write_locale("manufacturer_i18n", upsert.upsert(own("manufacturer_i18n"), makers.select("id", "name", here), ["id", "locale"]), locale)
    cars = recs.select(F.col("car_id").alias("id"), "name", "manufacturer_id", "aspiration_code", "drivetrain_code", "intro", "detail", "car_class", "pp", "year", "raw_json")
    lake.write("cars", upsert.cars(lake.table("cars"), cars, first))
    lake.write_locale("car_texts", upsert.upsert(own("car_texts"), recs.select("car_id", "name", "intro", "detail", here), ["car_id", "locale"]), locale)
    for kind, label in (("aspiration", F.coalesce("aspiration_label", "aspiration_raw", "aspiration_code")), ("drivetrain", F.coalesce("_drive", "drivetrain_code"))):
        new = recs.where(F.col(f"{kind}_code").isNotNull()).groupBy(F.col(f"{kind}_code").alias("code")).agg(F.min_by(label, "car_id").alias("label")).select("code", here, "label", F.lit(None).cast("string").alias("default_name"))
        codes, i18n = upsert.codes(lake.table(f"{kind}_codes"), own(f"{kind}_i18n"), new)
        lake.write(f"{kind}_codes", codes)
        lake.write_locale(f"{kind}_i18n", i18n, locale)
    both = cleanup.combined_label(own("aspiration_i18n"))
    given = own("aspiration_i18n").where("code = 'TC+SC' and label not in ('TC+SC', 'TC + SC')").select("locale")
    lake.write_locale("aspiration_i18n", upsert.upsert(own("aspiration_i18n"), both.join(given, "locale", "left_anti").select("code", "locale", "label"), ["code", "locale"]), locale)
    base_id = lake.table("car_specs").agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    rows = specs.select((F.monotonically_increasing_id() + base_id + 1).alias("id"), "car_id", "spec_key", "spec_value", "spec_unit", "spec_raw", "sort_order", "locale")
    bare = recs.select("car_id").join(specs.select("car_id").distinct(), "car_id", "left_anti")
    if bare.limit(1).count():  # a car without specifications loses those of every locale
        lake.write("car_specs", upsert.replace_specs(lake.table("car_specs"), rows, recs.select("car_id", here)))
    else:
        lake.write_locale("car_specs", upsert.replace_specs(own("car_specs"), rows, recs.select("car_id", here)), locale)
    seen = specs.where(~F.col("spec_key").startswith("raw_")).groupBy(F.col("spec_key").alias("code"), "locale").agg(F.min_by("spec_label", F.struct("sort_order", "car_id")).alias("label"))
    known = labels.where(F.col("locale") == locale).groupBy("code", "locale").agg(F.min("label").alias("label"))
    lake.write_locale("spec_code_i18n", upsert.insert_only(upsert.insert_only(own("spec_code_i18n"), known, ["code", "locale"]), seen, ["code", "locale"]), locale)
    log(lake, recs.select("car_id", F.lit("").alias("message")), locale, "success")


def build_all(spark: SparkSession, folder: str, bundles: dict[str, Bundle], base: str = "gb", target_only: bool = True, out: str | None = None, options: Options | None = None) -> int:
    """A dataset for each locale, the base first and the others from copies of it, and the merged one, with images if the base has some, if out is given; the exit code."""
    worst = 0
    for locale in [base, *[x for x in bundles if x != base]]:
        path = f"{folder}/locale={locale}"
        lake = Lake(spark, path)
        if locale != base and not lake.has_table("cars"):
            lake = Lake(spark, f"{folder}/locale={base}").copy_to(path)
        worst = max(worst, build_locale(lake, bundles[locale], locale, base, options=options))
        if target_only:
            cleanup.prune(lake, locale)
    if out:
        merge.merge(folder, out, spark, list(bundles), base)
    return worst
