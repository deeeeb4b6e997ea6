"""Datasets end to end: build, merge, ask, repair, follow."""

import json

import pytest
from pyspark.sql import functions as F

from polycat import cli, schema
from polycat.extract import html, js, payload
from polycat.operators import cleanup, merge, upsert
from polycat.plans import detail, ingest, lists, quality
from polycat.sources import files
from polycat.sources.lake import Lake, Refused, locales_of, scan_all
from polycat.streaming import fetch_log


def bundle(spark, locale):
    name = {"gb": "Sample", "cn": "示例"}[locale]
    cars = {f"car{i}": {"name": f"{name} {i}", "manufacturerId": "m1", "manufacturerName": "Maker", "countryId": "c1", "driveTrain": "FR", "aspirationShort": "TC", "specs": {"Weight": "1,200 kg", "Max Power": "203 HP / 6000 rpm"}} for i in (1, 2)}
    script = f"const data = {json.dumps(cars, ensure_ascii=False)}; export {{data as CarList}};"
    told = f"const d = {{car1: {{hero: 'h1 {locale}', desc: `d1`}}, car2: {{hero: \"h2\", desc: '',}}}}; export {{d as Descriptions}};"
    scripts = lambda t: spark.createDataFrame([(t,)], "text string")
    return ingest.Bundle(
        cars=ingest.from_scripts(scripts(script)),
        descriptions=ingest.from_scripts(scripts(told), kind="descriptions"),
        pages=spark.createDataFrame([("car2", "<h1></h1><p>A paragraph that is longer than twenty.<p>And a second one, longer as well.")], "car_id string, html string"),
        labels=spark.createDataFrame([(locale, "Weight", "weight"), (locale, "Max Power", "max_power")], "locale string, label string, code string"),
        iso=spark.createDataFrame([("c1", "JPN")], "country_id string, iso3 string"),
        countries=spark.createDataFrame([("JPN", "gb", "Japan"), ("JPN", "cn", "日本")], "iso3 string, locale string, name string"),
    )


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = f"file://{tmp_path_factory.mktemp('lake')}"
    code = ingest.build_all(spark, f"{folder}/parts", {x: bundle(spark, x) for x in ("gb", "cn")}, out=f"{folder}/all")
    assert code == 0
    return Lake(spark, f"{folder}/all"), f"{folder}/parts"


def test_build(spark, built):
    lake, parts = built
    assert locales_of(spark, parts) == ["cn", "gb"]
    o = lists.overview_stats(lake).first()
    assert (o.cars, o.manufacturers, o.specs, o.images, o.locales) == (2, 1, 12, 0, ["cn", "gb"])
    for x in ("gb", "cn"):
        own = Lake(spark, f"{parts}/locale={x}")
        assert [r[0] for r in own.table("car_texts").select("locale").distinct().collect()] == [x]
    assert {r.id: r.name for r in lake.table("cars").collect()} == {"car1": "Sample 1", "car2": "Sample 2"}
    meta = {r.key: r.value for r in lake.table("meta").collect()}
    assert meta["build_base_locale"] == "gb" and json.loads(meta["build_locales"]) == ["gb", "cn"]


def test_detail(built):
    lake, _ = built
    d = detail.car_detail(lake, "car1", "cn")
    assert d["name"] == "示例 1" and d["intro"] == "h1 cn" and d["detail"] == "d1" and d["country"] == {"id": "c1", "iso3": "JPN", "name": "日本"}
    assert d["drivetrain"] == {"code": "FR", "label": "FR"} and d["manufacturer"]["name"] == "Maker" and d["images"] == []
    assert [(s["spec_key"], s["spec_value"], s["spec_unit"]) for s in d["specs"]] == [("weight", "1,200", "kg"), ("max_power", "203", "HP"), ("max_power_rpm", "6000", "rpm")]
    assert detail.car_detail(lake, "car2", "gb")["detail"] == "And a second one, longer as well."
    with pytest.raises(ValueError, match="no car"):
        detail.car_detail(lake, "none")


def test_resume(spark, built, tmp_path):
    _, parts = built
    lake = Lake(spark, f"{parts}/locale=gb").copy_to(f"file://{tmp_path}/again")
    n = lake.table("fetch_log").count()
    assert ingest.build_locale(lake, bundle(spark, "gb"), "gb", resume=True) == 0
    assert lake.table("fetch_log").count() == n
    assert ingest.build_locale(lake, bundle(spark, "gb"), "gb") == 0
    assert lake.table("fetch_log").count() == 2 * n and lake.table("car_specs").count() == 6 and lake.table("cars").count() == 2


def test_failures_counts_and_options(spark, tmp_path):
    """A bad payload is a failed row, the site's count decides the exit code of whole builds, limits and lists cut, images follow the policy."""
    b = bundle(spark, "gb")
    b.cars = b.cars.unionByName(spark.createDataFrame([("car3", "[1]"), ("car4", "no json"), ("car5", None)], "car_id string, payload string"))
    b.site_total = 5
    at = lambda n: Lake(spark, f"file://{tmp_path}/{n}")
    lake = at("a")
    assert ingest.build_locale(lake, b, "gb") == 2 and lake.get_meta("status") == "count_mismatch"
    last = {r.car_id: r.status for r in quality.latest_status(lake.table("fetch_log")).collect()}
    assert last == {"car1": "success", "car2": "success", "car3": "failed", "car4": "failed", "car5": "failed"}
    assert lake.table("cars").count() == 2
    assert ingest.build_locale(lake, b, "gb", resume=True) == 2 and lake.table("fetch_log").count() == 8  # failed ones again
    b.site_total = 2
    assert ingest.build_locale(at("b"), b, "gb") == 0 and at("b").get_meta("status") == "ok"
    b.site_total = 5
    one = ingest.Options(limit=1)
    assert ingest.build_locale(at("c"), b, "gb", options=one) == 0 and [r.id for r in at("c").table("cars").collect()] == ["car1"]
    listed = ingest.Options(listed=spark.createDataFrame([(0, "car2"), (1, "none")], "pos int, id string"))
    assert ingest.build_locale(at("d"), b, "gb", options=listed) == 0 and [r.id for r in at("d").table("cars").collect()] == ["car2"]
    image = "car_id string, image_path string, sort_order int, image_type string"
    b.images = spark.createDataFrame([("car1", "a.jpe", 1, "hero"), ("car1", "b.jpg", 2, "hero"), ("none", "x", 1, "hero")], image)
    lake = at("e")
    ingest.build_locale(lake, b, "gb")
    paths = lambda: sorted(r.image_path for r in lake.table("car_images").collect())
    assert paths() == ["a.jpe", "b.jpg"]
    other = bundle(spark, "cn")
    other.images = spark.createDataFrame([("car1", "c.jpg", 1, "hero"), ("car1", "t.jpg", 1, "thumb")], image)
    ingest.build_locale(lake, other, "cn")
    assert paths() == ["a.jpe", "b.jpg"]
    ingest.build_locale(lake, other, "cn", options=ingest.Options(image_policy="all-locales"))
    assert paths() == ["a.jpe", "b.jpg", "t.jpg"]  # fewer heroes than there were, but the only thumb
    assert cli.main(["fix-paths", "--db", lake.path], spark) == 0 and paths() == ["a.jpg", "b.jpg", "t.jpg"]
    assert not ingest.Options(image_policy="none").images_of(True)
    with pytest.raises(ValueError, match="image policy"):
        ingest.Options(image_policy="some")
    assert cli.main(["examples", "--db", lake.path, "--out", f"file://{tmp_path}/ids"], spark) == 0
    assert [r[0] for r in spark.read.text(f"file://{tmp_path}/ids").collect()] == ["car1"]


def test_facts_and_versions(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}/l").create()
    assert lake.get_meta("a") is None
    for v in ("1", "2"):
        lake.set_meta(a=v)
    lake.set_meta(b=None)
    assert lake.get_meta("a") == "2" and lake.table("meta").count() == 2
    assert cli.to_compact({"é": [1, 2]}) == '{"\\u00e9":[1,2]}'


def test_merge_guards(spark, built, tmp_path):
    lake, parts = built
    for args, said in ((dict(folder=f"file://{tmp_path}/none"), "no datasets"), (dict(folder=parts, locales=["fr"]), "no dataset for"), (dict(folder=parts, base="fr"), "base locale")):
        with pytest.raises(ValueError, match=said):
            merge.merge(out=f"file://{tmp_path}/x", spark=spark, **args)
    with pytest.raises(ValueError, match="already"):
        merge.merge(parts, lake.path, spark)


def test_cli(spark, built, capsys, tmp_path):
    lake, _ = built
    db = ["--db", lake.path]
    assert cli.main(["list", *db, "--locale", "cn", "--sort", "weight"], spark) == 0
    assert capsys.readouterr().out == "car1\t示例 1\ncar2\t示例 2\n"
    assert cli.main(["stats", *db, "--by", "country", "--format", "json", "--out", str(tmp_path / "s.json")], spark) == 0
    assert json.loads((tmp_path / "s.json").read_text()) == [{"label": "Japan", "count": 2}]
    assert cli.main(["overview", *db], spark) == 0 and "locales: cn, gb" in capsys.readouterr().out
    assert cli.main(["car", *db, "--car-id", "car2"], spark) == 0 and "name: Sample 2" in capsys.readouterr().out
    assert cli.main(["overview", "--db", f"file://{tmp_path}/none"], spark) == 1
    assert cli.to_text([{"label": None, "count": 3}]) == "None\t3"


def test_versions(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}/l").create()
    assert not lake.has_table("car_images") and lake.table("car_texts").count() == 0
    with pytest.raises(FileNotFoundError):
        lake.table("car_images")
    row = lambda x: spark.createDataFrame([("a", x, "n", None, None)], schema.struct("car_texts"))
    lake.write("car_texts", row("gb"))
    lake.write("car_texts", lake.table("car_texts").unionByName(row("cn")))  # from its own last version
    assert sorted(r.locale for r in lake.table("car_texts").collect()) == ["cn", "gb"]
    lake.write("car_texts", merge.replace_locale(lake.table("car_texts"), row("gb").withColumn("name", F.lit("new")), "gb"))
    assert {(r.locale, r.name) for r in lake.table("car_texts").collect()} == {("gb", "new"), ("cn", "n")}
    lake.write("manufacturers", spark.createDataFrame([("m", "M")], "id string, name string"))
    assert "country_id" in lake.create().table("manufacturers").columns


def test_upserts(spark):
    t = schema.struct("manufacturers")
    old = spark.createDataFrame([("a", "A", "l", "c1"), ("b", "B", None, None)], t)
    new = spark.createDataFrame([("a", "X", None, None), ("b", "Y", "m", "c2"), ("c", "Z", None, None)], t)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(upsert.manufacturers(old, new, True)) == [("a", "X", "l", "c1"), ("b", "Y", "m", "c2"), ("c", "Z", None, None)]
    assert rows(upsert.manufacturers(old, new, False))[0] == ("a", "A", "l", "c1")
    s = schema.struct("car_specs")
    specs = spark.createDataFrame([(1, "a", "gb", "k", "1", None, None, 1), (2, "a", "cn", "k", "1", None, None, 1), (3, "b", "gb", "k", "1", None, None, 1), (4, "b", "cn", "k", "1", None, None, 1)], s)
    cars = spark.createDataFrame([("a", "gb"), ("b", "gb")], "car_id string, locale string")
    got = upsert.replace_specs(specs, spark.createDataFrame([(9, "a", "gb", "n", "2", None, None, 1)], s), cars)
    assert rows(got.select("car_id", "locale", "spec_key")) == [("a", "cn", "k"), ("a", "gb", "n")]  # b had no new ones
    labels = spark.createDataFrame([("w", "gb", "W")], schema.struct("spec_code_i18n"))
    assert rows(upsert.insert_only(labels, spark.createDataFrame([("w", "gb", "other"), ("x", "gb", "X")], schema.struct("spec_code_i18n")), ["code", "locale"])) == [("w", "gb", "W"), ("x", "gb", "X")]


def test_images(spark):
    i = "id long, car_id string, image_path string, sort_order int, image_type string"
    a = spark.createDataFrame([(1, "a", "p", 1, "hero"), (2, "a", "q", None, None)], i)
    b = spark.createDataFrame([(3, "a", "p", 1, "hero"), (4, "a", "q", 1, ""), (5, "a", "r", 1, "x"), (6, "a", "r", 1, "x")], i)
    assert sorted(r.id for r in merge.new_images(a, b).collect()) == [1, 2, 5, 6]
    old = spark.createDataFrame([("a", "o1", "hero", 1), ("a", "o2", "hero", 2), ("a", "o3", "", 1), ("a", "o4", "Map", 1)], "car_id string, image_path string, image_type string, sort_order int")
    new = spark.createDataFrame([("a", "n1", "HERO", 1), ("a", "n3", None, 1)], old.schema)
    got = [(r.image_path, r.image_type) for r in upsert.image_rows(old, new).orderBy("position").collect()]
    assert got == [("o1", "hero"), ("o2", "hero"), ("o4", "map"), ("n3", "unknown")]


def test_quality(spark):
    assert not quality.outcome("strict", 2, 1) and quality.outcome("soft", 2, 1, 20) and not quality.outcome("soft", 2, 1, 0) and quality.outcome("off", 2, 2)
    cars = spark.createDataFrame([("car1",), ("car2",), ("car3",)], "id string")
    images = spark.createDataFrame([("car1", "hero")], "car_id string, image_type string")
    manifest = spark.createDataFrame([("car1", 2), ("car2", 0)], "car_id string, expected int")
    got = {r.car_id: (r.expected, r.actual, r.reason) for r in quality.hero_differences(cars, images, manifest, 1).collect()}
    assert got == {"car1": ("2", 1, "mismatch_with_reference"), "car3": (">=1", 0, "below_min_without_reference")}


def test_cleanup(spark):
    codes = spark.createDataFrame([("raw_1", "gb"), ("rawX1", "gb"), ("RAW_2", "gb"), ("---", "gb"), (None, "gb"), ("NA", "gb"), ("raw_3", "cn")], "code string, locale string")
    assert {r.code for r in cleanup.without_raw_labels(codes, "gb").collect()} == {"---", None, "NA", "raw_3"}
    assert {r.code for r in cleanup.whitelisted(codes, ["NA", "---"]).collect()} == {None, "NA"}
    names = spark.createDataFrame([("A", "gb", "a"), ("A", "cn", "甲"), ("B", "gb", "b")], "iso3 string, locale string, name string")
    assert {tuple(r) for r in cleanup.country_names(names, "cn").collect()} == {("A", "cn", "甲"), ("B", "cn", "b")}
    df = spark.createDataFrame([("a", "")], "x string, y string")
    assert cleanup.drop_if_empty(df, "y").columns == ["x"] and cleanup.drop_if_empty(df, "x").columns == ["x", "y"]


def test_files(spark, tmp_path):
    (tmp_path / "iso.json").write_text('{"c1": "AAA", "c2": 5}')
    (tmp_path / "i18n.json").write_text('{"AAA": {"gb": "A"}, "BBB": "no"}')
    (tmp_path / "ids.txt").write_text(" a \n# no\n\n b\n")
    (tmp_path / "man.json").write_text('{"counts": {"car1": 2, "car2": "x"}}')
    at = lambda n: f"file://{tmp_path}/{n}"
    assert {tuple(r) for r in files.string_map(spark, at("iso.json"), "k", "v").collect()} == {("c1", "AAA"), ("c2", "5")}
    assert files.string_map(spark, at("none.json"), "k", "v").count() == 0
    assert [tuple(r) for r in files.nested_map(spark, at("i18n.json"), "i", "l", "n").collect()] == [("AAA", "gb", "A")]
    assert [r.id for r in files.id_list(spark, at("ids.txt")).orderBy("pos").collect()] == ["a", "b"]
    assert [tuple(r) for r in files.manifest(spark, at("man.json")).collect()] == [("car1", 2)]
    for n in ("car1/car1_hero_01.jpg", "car1/car1_hero_02.jpg", "car1/x.jpg"):
        (tmp_path / "img" / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "img" / n).write_text("x")
    assert [tuple(r) for r in files.hero_files(spark, at("img")).collect()] == [("car1", 2)]
    assert cli.main(["manifest", "--images", at("img"), "--out", at("counted")], spark) == 0
    assert [tuple(r) for r in files.manifest(spark, at("counted")).collect()] == [("car1", 2)]


def test_html():
    page = """<html><head><meta property="og:description" content=" own "><meta property="og:image" content="/i/car7.png"></head><main><h1>A &amp; B</h1><h2>Maker</h2>
    <div><h4>A heading that is long enough</h4><p>Its <b>paragraph.</div><table><tr><th>W</th><td>1 kg</td></tr><tr><td>only</td></tr></table><dl><dt>a<dd>b</dl><img src="/x/car7_1.jpg"><img src="/thumbnails/car7.jpg"></main>"""
    d = html.detail(page, "car7")
    assert (d["name"], d["manufacturer_name"], d["intro"], d["detail"]) == ("A & B", "Maker", "A heading that is long enough", "Its paragraph.")
    assert d["specs"] == [{"label": "W", "raw": "1 kg"}] and d["hero_images"] == ["/x/car7_1.jpg"]
    other = html.detail('<meta property="og:image" content="/i/car7.png"><dl><dt>a</dt><dd>b</dd></dl><p>short</p><p>Paragraph one is long enough.</p><p>Paragraph two is long enough.</p>', "car7")
    assert other["hero_images"] == ["/i/car7.png"] and other["specs"] == [{"label": "a", "raw": "b"}] and other["detail"] == "Paragraph two is long enough."
    assert html.detail(None)["specs"] == []
    assert html.thumbnails('<img src="/thumbnails/car1.png"><a href="/id/car2"><img src="t.png"></a><div style="background:url(\'u.png\')"><a href="/id/car3">x</a></div>') == [("car1", "/thumbnails/car1.png"), ("car2", "t.png"), ("car3", "u.png")]


def test_js(spark):
    text = "/* c */ const a={b:[1,2,],'c':`x{y`, d:-1.5e2, e:!0, f:null,}; let q = [1]; export {a as Cars, q as Ids};"
    assert js.exported(text, "Cars") == {"b": [1, 2], "c": "x{y", "d": -150.0, "e": True, "f": None}
    assert js.data("var x={a:1}, y={a:1,b:{c:2}};", ["None"]) == {"a": 1, "b": {"c": 2}}
    assert js.data("no {literal", []) is None and js.data("[1,[2,3]]", [], list) == [1, [2, 3]]
    assert js.literal(r"'aA\x42\n'") == "aAB\n"
    df = spark.createDataFrame([('[{"id": "car1", "hero": "h"}]',), (None,)], "t string")
    assert [r[0] for r in df.select(js.descriptions([])("t")).collect()] == [{"car1": '{"id": "car1", "hero": "h"}'}, {}]
    p = spark.createDataFrame([('{"logo": "/l.png", "list": {"small": "/s.png"}, "main": ["/m.jpg", "/m.jpg"]}',), ("bad",)], "p string").select(payload.image_urls(F.col("p")).alias("i"))
    got = p.select(*[ingest.urls_of(F.col("i"), k).alias(k) for k in ("logo", "thumb", "hero")]).collect()
    assert tuple(got[0]) == (["/l.png"], ["/s.png"], ["/m.jpg"]) and tuple(got[1]) == ([], [], [])
    mods = spark.createDataFrame([('car7_1_2.jpg": () => e(() => import("./m1.js"), [x]), car8_1_1.png": () => e(() => import("./m2.js")',)], "t string")
    assert mods.select(html.hero_modules(F.col("t"), "car7")).first()[0] == ["m1.js"]
    urls = spark.createDataFrame([('"/a/car7_1_2-x.jpg" "/b/car7_1_2-y.jpg" "/a/car7_1_3-z.png"',)], "t string")
    assert urls.select(html.hero_urls(F.col("t"), "car7")).first()[0] == ["/a/car7_1_2-x.jpg", "/a/car7_1_3-z.png"]


def test_deep_and_broken_markup():
    """Thousands of open elements and of end tags without a start are read, and in time."""
    deep = html.detail("<div>" * 20_000 + "<h1>A</h1>" + "</span>" * 20_000 + "<h2>B</h2>", "car1")
    assert (deep["name"], deep["manufacturer_name"]) == ("A", "B")
    assert html.parse("<b>" * 5000 + "x").text() == "x"


def test_deep_and_broken_scripts():
    for text in ("[" * 50_000, "{a:" * 50_000, "[" * 5000 + "]" * 5000, "x={" + "b:[" * 5000 + "]" * 5000 + "}"):
        got = js.data(text, [], list if "[" in text else dict)
        assert got is None or len(json.dumps(got)) < 2000
    assert js.data("var a = {x: f(), y: {z: 1}, w: {v: [1, 2], u: 2}};", []) == {"v": [1, 2], "u": 2}
    assert js.data("{a: it's} {b: {c: 'd'}}", []) == {"b": {"c": "d"}}
    assert js.data("[" * 300 + "1" + "]" * 300, [], list) is not None
    assert js.exported("let a = [[1], {b: [2, {c: 3}]}, ];export{a}", "a") == [[1], {"b": [2, {"c": 3}]}]


def test_stream(spark, tmp_path):
    """Batches in two runs with one checkpoint, then a repeated file, late rows and another checkpoint: only the keys that change are written, and the table ends as a batch would have it."""
    log = schema.struct("fetch_log")
    rows = [(i, f"c{i % 3}", "gb", ["success", "failed"][i % 2], None, "t") for i in range(12)]
    at = lambda n: f"file://{tmp_path}/{n}"

    def arrive(some):
        spark.createDataFrame(some, log).coalesce(1).write.mode("append").parquet(at("log"))

    def follow(checkpoint="cp"):
        fetch_log.into_table(fetch_log.read(spark, at("log")), at("out"), at(checkpoint)).awaitTermination()
        return {(r.car_id, r.status, r.id) for r in fetch_log.states(spark, at("out")).collect()}

    changed = lambda: spark.read.schema(fetch_log.STATES).option("recursiveFileLookup", "true").parquet(at("out")).count()
    arrive(rows[:4])
    arrive(rows[4:8])
    assert follow() == {("c0", "success", 6), ("c1", "failed", 7), ("c2", "failed", 5)} and changed() == 6
    arrive(rows[8:])
    assert follow() == {("c0", "failed", 9), ("c1", "success", 10), ("c2", "failed", 11)} and changed() == 9
    arrive([rows[9], rows[2]])  # one that was there and one that is late
    arrive([(20, "new", "gb", "success", None, "t"), (None, "new", "gb", "failed", None, "t")])
    want = {("c0", "failed", 9), ("c1", "success", 10), ("c2", "failed", 11), ("new", "success", 20)}
    assert follow() == want and changed() == 10
    assert follow() == want and changed() == 10  # nothing new
    fetch_log.compact(spark, at("out"))
    assert changed() == 4
    assert follow("other") == want  # all of it again, from the start
    batch = quality.latest_status(spark.read.parquet(at("log")).where("id is not null"))
    assert {(r.car_id, r.status) for r in batch.collect()} == {x[:2] for x in want}
    assert fetch_log.states(spark, at("none")).count() == 0


def test_merge_in_place(spark, built, tmp_path):
    """A locale's partitions change place; files of others keep their names, and keys that are known keep their rows."""
    lake, parts = built
    target = lake.copy_to(f"file://{tmp_path}/t")
    files_of = lambda t, x: sorted(p.name for p in (tmp_path / "t" / t / f"locale={x}").glob("*.parquet"))
    before = {t: files_of(t, "gb") for t in merge.BY_LOCALE}
    old_cn = files_of("car_texts", "cn")
    source = Lake(spark, f"{parts}/locale=cn").copy_to(f"file://{tmp_path}/s")
    source.write("car_texts", source.table("car_texts").withColumn("name", F.lit("neu")))
    source.write("cars", source.table("cars").where("id = 'car1'").withColumn("id", F.lit("car9")).unionByName(source.table("cars").withColumn("name", F.lit("no"))))
    merge.merge_locale(target, source, "cn")
    assert {t: files_of(t, "gb") for t in merge.BY_LOCALE} == before and files_of("car_texts", "cn") != old_cn
    assert {r.name for r in target.table("car_texts").where("locale = 'cn'").collect()} == {"neu"}
    assert {r.id: r.name for r in target.table("cars").collect()} == {"car1": "Sample 1", "car2": "Sample 2", "car9": "Sample 1"}
    assert target.table("car_texts").count() == 4 and target.table("fetch_log").count() == lake.table("fetch_log").count()
    merge.merge_locale(target, source, "cn", logs=True)
    assert target.table("fetch_log").where("locale = 'cn'").count() == source.table("fetch_log").where("locale = 'cn'").count()
    merge.merge_locale(target, source.create(), "fr")
    assert target.table("car_texts").count() == 4


def test_merge_of_images(spark, tmp_path):
    """Images are merged where the base has them; each table of all datasets is one scan."""
    for x, images in (("gb", [(1, "car1", "a", 1, "hero")]), ("cn", [(1, "car1", "a", 1, "hero"), (2, "car1", "b", 1, "")]), ("fr", [(1, "car1", "b", 1, None), (2, "car2", "c", 1, "x")])):
        one = Lake(spark, f"file://{tmp_path}/parts/locale={x}")
        one.write("cars", spark.createDataFrame([("car1", x)], "id string, name string"))
        one.write("car_texts", spark.createDataFrame([("car1", x, None, None, x)], "car_id string, name string, intro string, detail string, locale string"))
        one.write("car_images", spark.createDataFrame(images, schema.struct("car_images")))
    out = merge.merge(f"file://{tmp_path}/parts", f"file://{tmp_path}/all", spark, base="gb")
    assert sorted((r.image_path, r.image_type) for r in out.table("car_images").collect()) == [("a", "hero"), ("b", ""), ("c", "x")]
    assert [r.name for r in out.table("cars").collect()] == ["gb"] and out.table("car_texts").count() == 3
    assert cli.main(["merge", "--folder", f"file://{tmp_path}/parts", "--out", f"file://{tmp_path}/none", "--images", "no"], spark) == 0
    assert not Lake(spark, f"file://{tmp_path}/none").has_table("car_images")
    plan = scan_all(spark, f"file://{tmp_path}/parts", "car_texts", ["cn", "gb", "fr"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan
    assert {(r._dataset, r.locale) for r in scan_all(spark, f"file://{tmp_path}/parts", "car_texts", ["cn", "fr"]).collect()} == {("cn", "cn"), ("fr", "fr")}


def test_gate(spark, built, tmp_path):
    """A strict failure leaves the old images; what is counted is counted by the write."""
    lake = built[0].copy_to(f"file://{tmp_path}/l")
    images = lambda *rows: spark.createDataFrame(list(rows), "car_id string, image_path string, sort_order int, image_type string")
    expected = spark.createDataFrame([("car1", 2)], "car_id string, expected int")
    paths = lambda: sorted(r.image_path for r in lake.table("car_images").collect())
    good = images(("car1", "a", 1, "hero"), ("car1", "b", 2, "hero"), ("car2", "c", 1, "hero"), ("car2", "d", 1, "thumb"))
    assert quality.load_images(lake, good, expected, mode="strict") == 0 and paths() == ["a", "b", "c", "d"]
    assert quality.load_images(lake, images(("car1", "x", 1, "hero")), expected, mode="strict") == 3 and paths() == ["a", "b", "c", "d"]
    assert quality.load_images(lake, images(("car1", "x", 1, "hero")), expected, mode="soft", max_count=1) == 4
    assert quality.load_images(lake, good.unionByName(images(("none", "x", 1, "hero"))), expected) == 4 and paths() == ["a", "b", "c", "d"]
    assert quality.load_images(lake, images(("car1", "x", 1, "hero")), expected, mode="soft") == 0 and paths() == ["x"]
    assert quality.load_images(lake, good.unionByName(images(("none", "x", 1, "hero"))), expected, mode="off") == 0 and len(paths()) == 5
    with pytest.raises(Refused, match="bad"):
        lake.write("meta", lake.table("meta").withColumn("_n", F.lit(1)), {"bad": F.col("_n")})
    assert not list((tmp_path / "l" / "_beside").glob("*"))


def test_mixed_versions(spark, tmp_path):
    """Files of an older and a newer shape answer together, also in a session that doesn't know the dataset; what only old datasets have goes if it is empty."""
    path = f"file://{tmp_path}/l"
    spark.createDataFrame([("m1", "Maker")], "id string, name string").write.parquet(f"{path}/manufacturers")
    spark.createDataFrame([("car1", "One", "m1", "", "x")], "id string, name string, manufacturer_id string, description string, country string").write.parquet(f"{path}/cars")
    spark.createDataFrame([("car1", "success", "t")], "car_id string, status string, updated_at string").write.parquet(f"{path}/fetch_log")
    lake = Lake(spark, path)
    assert not lake.has_column("manufacturers", "country_id") and lists.named_makers  # as it is until something is written
    before = sorted(p.name for p in (tmp_path / "l" / "cars").glob("*.parquet"))
    lake.create()
    assert set(before) < {p.name for p in (tmp_path / "l" / "cars").glob("*.parquet")}
    assert [tuple(r) for r in lake.table("fetch_log").select("car_id", "locale").collect()] == [("car1", "us")]
    lake.append("cars", spark.createDataFrame([("car2", "Two", "m1", "FR")], "id string, name string, manufacturer_id string, drivetrain_code string"))
    for one in (lake, Lake(spark, path + "/")):
        assert {(r.id, r.drivetrain_code) for r in one.table("cars").collect()} == {("car1", None), ("car2", "FR")}
        assert [r.id for r in lists.list_cars(one, "gb").collect()] == ["car1", "car2"] and detail.car_detail(one, "car2")["drivetrain"]["code"] == "FR"
    assert cleanup.drop_empty_columns(lake) == ["cars"] and lake.table("cars").columns == schema.struct("cars").names[:3] + ["aspiration_code", "drivetrain_code"] + schema.struct("cars").names[5:]
    spark.sql(f"DROP DATABASE {lake.database} CASCADE")
    assert "country_id" in Lake(spark, path).table("manufacturers").columns


def test_bucketed_details(spark, built, tmp_path):
    """Details from buckets are those of the dataset, and nothing is shuffled by car."""
    lake, _ = built
    b = detail.Bucketed(lake, f"file://{tmp_path}/b", "bucketed_test").write(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = detail.details(b, b.table("cars").select("id"), "cn")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and ("car_id" in x or "hashpartitioning(id#" in x)]
        want = detail.details(lake, lake.table("cars").select("id"), "cn")
        assert sorted(map(repr, df.collect())) == sorted(map(repr, want.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_failures_by_kind(spark, tmp_path):
    """A bad payload, a bad page, a bad script and an id without anything each have a row with a message; the rest is built, a listed id from its page alone."""
    b = bundle(spark, "gb")
    b.cars = b.cars.unionByName(spark.createDataFrame([("car3", "no json")], "car_id string, payload string"))
    b.pages = spark.createDataFrame([("car1", None), ("car8", "<h1>From its page</h1>")], "car_id string, html string")
    scripts = spark.createDataFrame([("a.js", "var x = 1"), ("b.js", 'let d = {car5: {name: "Five"}}; export {d as Cars}')], "name string, text string")
    b.failures = ingest.bad_scripts(scripts, "name")
    b.cars = b.cars.unionByName(ingest.from_scripts(scripts, strict=False))
    listed = spark.createDataFrame([(i, x) for i, x in enumerate(["car1", "car3", "car5", "car8", "car9"])], "pos int, id string")
    lake = Lake(spark, f"file://{tmp_path}/l")
    assert ingest.build_locale(lake, b, "gb", options=ingest.Options(listed=listed)) == 0
    assert {r.id: r.name for r in lake.table("cars").collect()} == {"car1": "Sample 1", "car5": "Five", "car8": "From its page"}
    log = lake.table("fetch_log").collect()
    assert {(r.car_id, r.message) for r in log if r.status == "failed"} == {("car1", "page could not be read"), ("car3", "payload is no object"), ("a.js", "no car data in script"), ("car9", "neither payload nor page")}
    last = {r.car_id: r.status for r in quality.latest_status(lake.table("fetch_log")).collect()}
    assert last == {"car1": "success", "car5": "success", "car8": "success", "car3": "failed", "a.js": "failed", "car9": "failed"}


def test_payload_images(spark):
    """Any depth, in the order of the text, without Python; a string that looks like an object is a string."""
    deep = []
    for k in range(60):
        deep = {"k": deep, "i": f"{k}.jpg"}
    rows = ['{"z": {"y": [["/d.jpg", {"a": "/image/q"}], "no"]}, "main": ["/m.jpg"], "u": "{\\"a\\": \\"image\\"}", "pp": 5.0}', "bad", None, '[1, "a.png"]', '{"a": ', "5", "{}", json.dumps(deep)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, p string").select("i", payload.image_urls(F.col("p")).alias("u"), payload.pick(payload.fields(F.col("p")), ["none", "pp"]).alias("pp"))
    got = {r.i: [tuple(x) for x in r.u] for r in df.collect()}
    assert got[0] == [("z.y.0.0", "/d.jpg"), ("z.y.0.1.a", "/image/q"), ("main.0", "/m.jpg"), ("u", '{"a": "image"}')]
    assert got[3] == [("1", "a.png")] and [len(got[i]) for i in (1, 2, 4, 5, 6, 7)] == [0, 0, 0, 0, 0, 60] and got[7][0][1] == "0.jpg"
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString() and df.where("i = 0").first().pp == "5.0"


def test_build_from_files(spark, tmp_path, capsys):
    src = tmp_path / "src"
    for x, name in (("gb", "Sample"), ("cn", "示例")):
        (src / x / "pages").mkdir(parents=True)
        (src / x / "cars.js").write_text(f"var d={{car1:{{name:'{name}',manufacturerId:'m1',countryId:'c1',specs:{{Weight:'1 kg'}}}}}};export{{d as CarList}}")
        (src / x / "tuners.js").write_text("var t={m1:{name:'Maker'}};export{t as TunerList}")
        (src / x / "pages" / "car1.html").write_text("<h2>Page maker</h2>" if x == "cn" else "")
        (src / x / "labels.json").write_text('{"Weight": "weight"}')
    (src / "iso.json").write_text('{"c1": "AAA"}')
    (src / "countries.json").write_text('{"AAA": {"gb": "Aland"}}')
    at = lambda n: f"file://{tmp_path}/{n}"
    assert cli.main(["build", "--source", at("src"), "--folder", at("parts"), "--out", at("all"), "--locales", "gb,cn"], spark) == 0
    d = detail.car_detail(Lake(spark, at("all")), "car1", "cn")
    assert d["name"] == "示例" and d["manufacturer"]["name"] == "Page maker" and d["country"]["name"] == "Aland" and d["specs"][0]["spec_key"] == "weight"
    assert detail.car_detail(Lake(spark, at("all")), "car1", "gb")["manufacturer"]["name"] == "Maker"
    (tmp_path / "man.json").write_text('{"car1": 1}')
    check = ["check", "--db", at("all"), "--manifest", at("man.json")]
    assert cli.main([*check, "--mode", "strict", "--report", at("report")], spark) == 3 and cli.main(check, spark) == 0
    assert spark.read.csv(at("report/csv"), header=True).first().reason == "mismatch_with_reference"
    assert cli.main(["doctor"], spark) == 0 and "spark: " in capsys.readouterr().out
    with pytest.raises(FileNotFoundError):
        ingest.from_folder(spark, at("src"), "fr")


def test_cli_with_images(spark, tmp_path):
    """A build from files takes images and the site's total from them; images go on into the merged dataset, through the check, and to their right names."""
    src, at = tmp_path / "src", lambda n: f"file://{tmp_path}/{n}"
    (src / "gb" / "cars").mkdir(parents=True)
    (src / "gb" / "cars" / "a.js").write_text("var d={car1:{name:'One'}};export{d as CarList}")
    (src / "gb" / "cars" / "b.js").write_text("var d=1;")
    (src / "gb" / "index.html").write_text("<p>3 Cars</p>")
    image = src / "gb" / "images" / "cars" / "car1" / "car1_hero_01.jpe"
    image.parent.mkdir(parents=True)
    image.write_text("x")
    build = ["build", "--source", at("src"), "--folder", at("parts"), "--out", at("all"), "--locales", "gb"]
    assert cli.main(build, spark) == 2  # three cars are said, one is there
    lake = Lake(spark, at("all"))
    assert [tuple(r) for r in lake.table("car_images").select("car_id", "image_path", "sort_order", "image_type").collect()] == [("car1", "cars/car1/car1_hero_01.jpe", 1, "hero")]
    assert {(r.car_id, r.status) for r in lake.table("fetch_log").collect()} == {("car1", "success"), ("b.js", "failed")}
    assert cli.main(["fix-paths", "--db", at("all"), "--images", at("src/gb/images")], spark) == 0
    assert [p.name for p in image.parent.iterdir() if not p.name.startswith(".")] == ["car1_hero_01.jpg"] and lake.table("car_images").first().image_path.endswith(".jpg")
    (tmp_path / "man.json").write_text('{"car1": 2}')
    load = ["images", "--db", at("all"), "--images", at("src/gb/images"), "--manifest", at("man.json"), "--mode"]
    assert cli.main([*load, "strict"], spark) == 3 and cli.main([*load, "soft"], spark) == 0
    assert cli.main(["build", "--source", at("src"), "--folder", at("bare"), "--locales", "gb", "--image-policy", "none"], spark) == 2
    assert not Lake(spark, at("bare/locale=gb")).has_table("car_images")
