"""Slugs, file extensions, image addresses and locale paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polycat.functions.collation import present, strip

# Locale codes whose paths and assets have other codes, and extensions of content types.
LOCALE_PATHS = {"bp": "br", "ms": "mx", "el": "gr", "ar": "sa"}
CONTENT_TYPES = {"image/jpeg": ".jpg", "image/png": ".png", "image/webp": ".webp", "image/gif": ".gif", "image/bmp": ".bmp", "image/svg+xml": ".svg", "image/tiff": ".tiff", "image/avif": ".avif"}


def slugify(c: Column) -> Column:
    """Lower case, runs of other characters than a-z and 0-9 as one hyphen, none at the ends; 'unknown' if nothing is left."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(present(bare), F.lit("unknown"))


def image_extension(ext: Column) -> Column:
    low = F.lower(strip(F.coalesce(ext, F.lit(""))))
    return F.when((low == "") | low.isin(".jpe", ".jpeg"), ".jpg").otherwise(low)


def extension(url: Column, content_type: Column) -> Column:
    """Of the content type, else of the path's last part, else .jpg."""
    kind = strip(F.substring_index(content_type, ";", 1))
    known = F.create_map(*[F.lit(x) for kv in CONTENT_TYPES.items() for x in kv])[kind]
    path = F.regexp_extract(F.regexp_extract(url, "^[^?#]*", 0), r"[^/]\.?(\.[^./]+)/*$", 1)
    return F.coalesce(known, image_extension(path))


def file_name(url: Column) -> Column:
    return F.sha1(url)


def is_image(c: Column) -> Column:
    return F.coalesce(F.lower(c).rlike(r"\.(jpg|jpeg|png|webp)$") | F.lower(c).contains("image"), F.lit(False))


def absolute(url: Column, base: str) -> Column:
    return F.when(url.rlike("^https?://"), url).when(url.startswith("/"), F.concat(F.lit(base), url)).otherwise(F.concat(F.lit(f"{base}/"), url))


def asset_url(name: Column, base: str, folder: str) -> Column:
    """Of an asset of a page: as it is if absolute, else in the asset folder, dots and slashes at its beginning left out."""
    return F.when(name.rlike("^https?://"), name).otherwise(F.concat(F.lit(f"{base}{folder}"), F.regexp_replace(name, "^[./]+", "")))


def locale_paths(locale: str) -> tuple[str, str]:
    """Codes of a locale in page paths and in assets."""
    back = {v: k for k, v in LOCALE_PATHS.items()}
    return LOCALE_PATHS.get(locale, locale), back.get(locale, locale)


def locale_order(locales: list[str], base: str | None = None) -> list[str]:
    """Each locale once, in order, the base locale first."""
    out = list(dict.fromkeys(x.strip().lower() for x in locales if x.strip()))
    if base and base in out:
        out.remove(base)
        out.insert(0, base)
    return out


def parse_locales(text: str | None, default: list[str]) -> list[str]:
    return locale_order(text.split(",")) if text and text.strip() else list(default)


def ordered_distinct(df: DataFrame, keys: list[str], value: str, order: str, name: str) -> DataFrame:
    """keys and name: each value of a group once, in the order of its first row. Repeats are gone before values are gathered, so that a group holds its distinct values only."""
    first = df.groupBy(*keys, value).agg(F.min(order).alias("_first"))
    return first.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("_first", F.col(value).alias("_v")))), lambda x: x["_v"]).alias(name))
