"""Lines that many documents repeat are dropped from all of them but one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polycat.llm.common import ascii_lower, fresh

STRIP = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    return F.trim(line, F.lit(STRIP))


def _digest(key: Column) -> Column:
    return F.unhex(F.md5(ascii_lower(key)))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with text_col cleaned, and columns n_lines, n_dropped.

    A line's key is the line without white space at its ends and with A-Z lower-cased. Keys of at least min_chars
    code points in at least min_docs documents lose all lines except those of the largest id. Null or empty texts
    are one empty line, and their text becomes ''. Rows that share an id are one document; rows without an id are
    not counted and keep all lines. Other columns pass through; columns n_lines and n_dropped are replaced.

    Plan: the keys' 128-bit digests (never the lines) are shuffled once to distinct pairs of key and document, then
    counted with map-side partial sums, so that a line of a third of all documents is no hot task. Only the join of
    frequent keys with their documents meets such a key, and AQE splits it. Texts are shuffled once, to meet the list
    of keys that their document loses; that side is built as a hash table, so texts are not sorted.
    """
    docs = docs.drop("n_lines", "n_dropped")
    own, key, lost, lines, kept = (fresh(docs, n) for n in ("_own", "_key", "_lost", "_lines", "_kept"))
    keys = F.array_distinct(F.transform(F.filter(F.transform(_lines(F.col(text_col)), _key), lambda k: F.length(k) >= min_chars), _digest))
    pairs = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias(own), F.explode(keys).alias(key)).distinct()
    frequent = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max(own).alias("last")).where(F.col("n") >= min_docs)
    losing = pairs.join(frequent, key).where(F.col(own) != F.col("last")).groupBy(own).agg(F.collect_set(key).alias(lost))
    out = docs.join(losing.hint("shuffle_hash"), F.col(id_col) == F.col(own), "left").withColumn(lines, _lines(F.col(text_col)))
    stays = F.filter(lines, lambda x: (F.length(_key(x)) < min_chars) | ~F.array_contains(lost, _digest(_key(x))))
    out = out.withColumn(kept, F.when(F.col(lost).isNull(), F.col(lines)).otherwise(stays))
    return out.select(
        *[F.array_join(kept, "\n").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns],
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(kept)).cast("long").alias("n_dropped"),
    )
