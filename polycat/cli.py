"""Command line: list, car, stats and overview of a dataset; build, merge and check of datasets; doctor."""

from __future__ import annotations

import argparse
import contextlib
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from polycat.functions.text import parse_locales
from polycat.operators import cleanup
from polycat.operators.merge import merge
from polycat.plans import detail, ingest, lists, quality
from polycat.sources.files import hero_files, id_list, manifest, write_ids
from polycat.sources.lake import Lake


def to_text(data) -> str:
    """Dicts as lines of key and value, rows of id and name or label and count with a tab between, all else as JSON."""
    if isinstance(data, dict):
        return "\n".join(f"{k}: {', '.join(map(str, v)) if isinstance(v, list) else v}" for k, v in data.items())
    for a, b in (("id", "name"), ("label", "count")):
        if isinstance(data, list) and data and all(set(r) == {a, b} for r in data):
            return "\n".join(f"{r[a]}\t{r[b]}" for r in data)
    return to_json(data)


def to_json(data) -> str:
    return json.dumps(data, ensure_ascii=False, indent=2, default=str)


def to_compact(data) -> str:
    """JSON in ASCII without spaces."""
    return json.dumps(data, separators=(",", ":"), default=str)


def write_lines(lines, path: str | None, none: str = "") -> None:
    """Lines to a file or to standard output, none's text if there are none."""
    with open(path, "w", encoding="utf-8") if path else contextlib.nullcontext(sys.stdout) as f:
        said = False
        for line in lines:
            f.write(f"{line}\n")
            said = True
        if not said:
            f.write(f"{none}\n")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="polycat")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, locale: bool = True) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        c.add_argument("--db", required=True, help="folder of the dataset")
        if locale:
            c.add_argument("--locale", default="gb")
        c.add_argument("--format", choices=("text", "json", "compact"), default="text")
        c.add_argument("--out", help="file to write to instead of standard output")
        return c

    c = command("list")
    c.add_argument("--sort", choices=lists.SORTS, default="manufacturer")
    c.add_argument("--limit", type=int, default=0)
    command("car").add_argument("--car-id", required=True)
    command("stats").add_argument("--by", choices=("manufacturer", "country", "drivetrain"), default="manufacturer")
    command("overview", locale=False)
    m = sub.add_parser("merge")
    m.add_argument("--folder", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--base")
    m.add_argument("--locales")
    m.add_argument("--images", choices=("auto", "yes", "no"), default="auto", help="merge images; auto: if the base has some")
    m.add_argument("--logs", action="store_true")
    b = sub.add_parser("build")
    b.add_argument("--source", required=True, help="folder with a folder of files for each locale")
    b.add_argument("--folder", required=True, help="where each locale's dataset goes")
    b.add_argument("--out", help="where the merged dataset goes")
    b.add_argument("--locales", required=True)
    b.add_argument("--base", default="gb")
    b.add_argument("--text-policy", choices=("target-only", "all"), default="target-only")
    b.add_argument("--limit", type=int, default=0)
    b.add_argument("--car-list", help="file of ids, one in a line")
    b.add_argument("--resume", action="store_true")
    b.add_argument("--image-policy", choices=tuple(ingest.IMAGE_POLICIES), default="base-only")
    h = sub.add_parser("check")
    h.add_argument("--db", required=True)
    o = sub.add_parser("images", help="a folder's images into a dataset, unless they fail the check")
    o.add_argument("--db", required=True)
    o.add_argument("--images", required=True)
    for x in (b, h, o):
        x.add_argument("--manifest", required=x is not b)
        x.add_argument("--least", type=int, default=1)
        x.add_argument("--mode", choices=("strict", "soft", "off"), default="soft")
        x.add_argument("--report")
        x.add_argument("--max-count", type=int, default=20)
        x.add_argument("--max-ratio", type=float, default=0.05)
    e = sub.add_parser("examples", help="the smallest id of each maker, as lines")
    e.add_argument("--db", required=True)
    e.add_argument("--out", required=True)
    f = sub.add_parser("fix-paths", help="image paths that end in .jpe, and with --images the files too")
    f.add_argument("--db", required=True)
    f.add_argument("--images", help="folder of the image files")
    n = sub.add_parser("manifest", help="hero images counted in a folder")
    n.add_argument("--images", required=True)
    n.add_argument("--out", required=True)
    sub.add_parser("doctor")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("polycat").getOrCreate()
    if a.command == "merge":
        merge(a.folder, a.out, spark, a.locales.split(",") if a.locales else None, a.base, {"auto": None, "yes": True, "no": False}[a.images], a.logs)
        return 0
    if a.command == "build":
        bundles = {x: ingest.from_folder(spark, a.source, x) for x in parse_locales(a.locales, [])}
        listed = id_list(spark, a.car_list) if a.car_list else None
        code = ingest.build_all(spark, a.folder, bundles, a.base, a.text_policy == "target-only", a.out, ingest.Options(a.limit, listed, a.resume, a.image_policy))
        if a.manifest and not code:
            lakes = {x: Lake(spark, f"{a.folder}/locale={x}") for x in bundles}
            return quality.check_heroes(lakes, manifest(spark, a.manifest), a.least, a.mode, a.report, a.max_count, a.max_ratio)
        return code
    if a.command == "manifest":
        counts = hero_files(spark, a.images)
        counts.select(F.to_json(F.struct("car_id", "n"))).write.text(a.out)
        return 0
    if a.command == "doctor":
        print(to_text({"python": sys.version.split()[0], "spark": spark.version, "master": spark.sparkContext.master, "shared folder": spark.conf.get("spark.checkpoint.dir", None)}))
        return 0
    lake = Lake(spark, a.db)
    if not lake.has_table("cars"):
        print(f"no dataset at {a.db}", file=sys.stderr)
        return 1
    if a.command == "check":
        return quality.check_heroes({a.db: lake}, manifest(spark, a.manifest), a.least, a.mode, a.report, a.max_count, a.max_ratio)
    if a.command == "examples":
        write_ids(quality.examples(lake.table("cars")).orderBy("manufacturer_id").select("id"), a.out)
        return 0
    if a.command == "fix-paths":
        if a.images:
            cleanup.fix_files(spark, a.images)
        print(cleanup.fix_paths(lake))
        return 0
    if a.command == "images":
        return quality.load_images(lake, ingest.image_files(spark, a.images), manifest(spark, a.manifest), a.least, a.mode, a.max_count, a.max_ratio)
    rows = lambda df: [r.asDict(recursive=True) for r in df.toLocalIterator()]
    stats = {"manufacturer": lists.stats_by_manufacturer, "country": lists.stats_by_country, "drivetrain": lists.stats_by_drivetrain}
    if a.command in ("list", "stats"):
        df = lists.list_cars(lake, a.locale, a.sort, a.limit) if a.command == "list" else stats[a.by](lake, a.locale)
        if a.format == "text":  # a line as it comes: the driver holds no whole list
            write_lines(("\t".join(map(str, r)) for r in df.toLocalIterator()), a.out, to_json([]))
            return 0
        data = rows(df)
    elif a.command == "car":
        data = detail.car_detail(lake, a.car_id, a.locale)
    else:
        data = rows(lists.overview_stats(lake))[0]
    write_lines([{"json": to_json, "compact": to_compact, "text": to_text}[a.format](data)], a.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
