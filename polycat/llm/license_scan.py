"""Whole texts that are a known licence, found by the digest of their canonical form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from polycat.llm.common import ascii_lower
from polycat.llm.license_texts import BARE, DIGESTS, LICENSES

# Spellings that count as the same, replaced wherever they stand, in this order.
SAME = [
    ("licenc", "licens"),
    ("isation", "ization"),
    ("authoris", "authoriz"),
    ("recognis", "recogniz"),
    ("organis", "organiz"),
    ("avour", "avor"),
    ("ehaviour", "ehavior"),
    ("whilst", "while"),
    ("fulfil ", "fulfill "),
    ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"),
    ("noninfringement", "non infringement"),
    ("merchantibility", "merchantability"),
    ("sub license", "sublicense"),
    ("copyright owner", "copyright holder"),
    ("https", "http"),
]

#: A copyright notice: its mark, then the rest of its line, or what comes before the first words of a licence where a
#: text has lost its line breaks. Without a sign or a year it counts where a line begins with it.
MARK = r"((^|\n)[ \t*#/;-]*copyright[ \t]+(the|by)[ \t]|copyright[ \t]*(\(c\)|©|<|\[|[0-9]{4}|the regents)|\(c\)[ \t]*[0-9]{4}|©[ \t]*[0-9]{4})"
OPENINGS = "permission is hereby granted|permission to use|redistribution and use|this software is provided|this is free and unencumbered"

#: Steps of the canonical form: pattern, and the number of the group that stays in place of each match, or the words that
#: do, or None for a space. Each is applied to all matches, in this order.
STEPS = [
    (r"(^|\n)[ \t*#/;-]*spdx-license-identifier:[^\n]*", 1),
    (MARK + r"[^\n]*?(\n|$|" + OPENINGS + ")", 5),
    (r"all[ \t]+rights[ \t]+reserved", None),
    (r"(^|\n)[ \t*#/;-]*([0-9]{1,2}|[a-z])[.)][ \t]+", 1),
    (r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", None),
    (r" (51 franklin st|59 temple pl|675 mass)[a-z0-9 ]*? usa", None),
    (r"neither the name of .*? nor the names of", " neither the name of the holder nor the names of "),
    (r"^ ?(the )?(mit no attribution|(mit|isc|zlib|boost software|bsd ([0-9]|zero) clause) licen[sc]e)( version 1 0 august 17th 2003)? ((mit|isc|zlib) )?", None),
]


def canonical(text: Column) -> Column:
    """Lower-cased (A-Z), without copyright notices, lines of identifiers, list marks, titles of short licences, punctuation, postal addresses of the Free Software Foundation and whom a clause on names protects, one space between words, equivalent spellings made one."""
    out = ascii_lower(F.coalesce(text, F.lit("")))
    for pattern, stays in STEPS:
        out = F.regexp_replace(out, pattern, f"${stays}" if isinstance(stays, int) else stays or " ")
    for old, new in SAME:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.trim(out)


def digests(licenses: DataFrame) -> DataFrame:
    """license_id, digest of licenses (license_id, license_text); those without any word have none, and the smallest id stands for equal texts."""
    words = licenses.select("license_id", canonical(F.col("license_text")).alias("_c")).where("_c != ''")
    return words.groupBy(F.sha2("_c", 256).alias("digest")).agg(F.min("license_id").alias("license_id")).select("license_id", "digest")


def known_licenses(spark: SparkSession) -> DataFrame:
    """license_id, digest of the licences that the library knows."""
    texts = spark.createDataFrame(list(LICENSES.items()), "license_id string, license_text string")
    return digests(texts).union(spark.createDataFrame([*DIGESTS.items(), *BARE.items()], "license_id string, digest string"))


def scan_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, digest, license_id (null: no known licence) for each row of docs.

    The digest is the SHA-256 of the canonical whole text; equal digests join. known: (license_id, digest), each digest
    once, as digests() makes them from texts. Null, empty and wordless texts have the digest of no words, which no
    licence has, so they never match; very long texts are canonicalized whole. Repeated rows and null ids pass through,
    each with its own answer; an empty table gives no rows.

    Plan: one scan, no shuffle of texts; the licence side holds one digest for each licence and is left to Catalyst to
    broadcast or shuffle by its size. Few distinct digests match, and a hot one is on the broadcast join's large side.
    """
    out = docs.select(F.col(id_col), F.sha2(canonical(F.col(text_col)), 256).alias("digest"))
    return out.join(known, "digest", "left").select(id_col, "digest", "license_id")
