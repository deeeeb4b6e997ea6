"""Fields and image addresses of JSON payloads, all in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from polycat.functions.collation import present

STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
IMAGE = r"(?i)\.(jpg|jpeg|png|webp)$|image"


def fields(payload: Column) -> Column:
    """map<string,string> of a JSON object's fields in their order, nested ones as they are written; null for what is no object. The payload's one parse: fields are picked from it."""
    return F.from_json(F.when(F.ltrim(payload).startswith("{"), payload), "map<string,string>", STRICT)


def pick(found: Column, names: list[str]) -> Column:
    """The first of the named fields that is neither null nor empty, as text."""
    return F.coalesce(*[present(F.try_element_at(found, F.lit(n))) for n in names])


#: What a part's text holds if there may be an address in it; an escaped character may be any.
MAY_HOLD = r"(?i)jpg|jpeg|png|webp|image|\\"


def _children(node: Column) -> Column:
    """A container's parts that may hold an address, as nodes of their own (path, value, open), in the order in which they are written."""
    at = lambda key: F.when(node["path"] == "", key).otherwise(F.concat(node["path"], F.lit("."), key))
    looks_open = lambda x: F.ltrim(x["value"]).rlike(r"^[\[{]") & x["value"].rlike(MAY_HOLD)
    inside, of_array = node["value"], F.ltrim(node["value"]).startswith("[")
    listed = F.transform(F.from_json(inside, "array<string>", STRICT), lambda x, i: F.struct(i.cast("string").alias("key"), x.alias("value")))
    parts = F.when(of_array, listed).otherwise(F.map_entries(F.from_json(inside, "map<string,string>", STRICT)))
    # a string may look like an object: only then, and where there are objects, the kinds of all parts are read too
    kinds = F.when(of_array, F.from_json(inside, "array<variant>", STRICT)).otherwise(F.map_values(F.from_json(inside, "map<string,variant>", STRICT)))
    part = lambda x, is_open: F.struct(at(x["key"]).alias("path"), x["value"].alias("value"), is_open.alias("open"))
    told = lambda xs: F.zip_with(xs, kinds, lambda x, k: part(x, F.when(looks_open(x), F.schema_of_variant(k).rlike("^(OBJECT|ARRAY)")).otherwise(F.lit(False))))
    plain = lambda xs: F.transform(F.filter(xs, lambda x: x["value"].rlike(IMAGE)), lambda x: part(x, F.lit(False)))
    every = F.element_at(F.transform(F.array(parts), lambda xs: F.when(F.exists(xs, looks_open), told(xs)).otherwise(plain(xs))), 1)
    return F.coalesce(F.filter(every, lambda x: x["open"] | x["value"].rlike(IMAGE)), F.array().cast("array<struct<path:string,value:string,open:boolean>>"))


def image_urls(payload: Column) -> Column:
    """array<struct<path, url>>: strings anywhere in a payload that look like image addresses, with the dotted path of each, in the order of the text.

    The list of parts is opened level by level: each open part is replaced, where it stands, by what it holds. There are
    at most as many levels as opening brackets; levels without an open part cost one look at a short list. Null, malformed
    and bare values have none.
    """
    none = F.array().cast("array<struct<path:string,value:string,open:boolean>>")
    top = F.when(F.ltrim(payload).rlike(r"^[\[{]") & payload.rlike(MAY_HOLD), F.array(F.struct(F.lit("").alias("path"), payload.alias("value"), F.lit(True).alias("open")))).otherwise(none)
    closed = F.array().cast("array<struct<path:string,value:string,open:boolean>>")
    opened = lambda parts: F.flatten(F.transform(parts, lambda x: F.when(x["open"], _children(x)).otherwise(F.array(x))))
    levels = F.sequence(F.lit(1), F.greatest(F.length(payload) - F.length(F.translate(payload, "[{", "")), F.lit(1)))
    step = lambda parts, _: F.when(F.exists(parts, lambda x: x["open"]), opened(parts)).otherwise(parts)
    parts = F.aggregate(F.when(payload.isNull(), F.array(F.lit(1))).otherwise(levels), F.coalesce(top, closed), step)
    return F.transform(parts, lambda x: F.struct(x["path"].alias("path"), x["value"].alias("url")))
