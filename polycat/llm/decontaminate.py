"""Passages of benchmark items in documents: found as word windows, verified word by word."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from polycat.llm.common import ascii_lower, bounded, fresh, let, stored, text_key

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """Words of a text: runs of ASCII digits, letters (lower-cased) and all non-ASCII characters."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def _grams(w: Column, n: int | Column, step: int = 1) -> Column:
    """Runs of n words as strings, at every step-th word; none if there are fewer words."""
    n = F.lit(n) if isinstance(n, int) else n
    starts = lambda w: F.filter(F.sequence(F.lit(1), F.greatest(F.size(w), F.lit(1)), F.lit(step)), lambda i: i + n - 1 <= F.size(w))
    return let(w, lambda w: F.transform(starts(w), lambda i: F.array_join(F.slice(w, i, n), " ")))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """id_col, n_words, n_hit, items (sorted strings) for each row of docs.

    A window is `window` consecutive words of an item, or all words of a shorter one; items without words have none.
    A document word inside any occurrence of a window is hit. Null and empty texts have no words. Repeated rows get
    the same answer each; rows sharing an id count as one document as to hits. Rows without an id are compared too
    and count as one document. An empty benchmark hits nothing.

    Plan: any window of L words holds, wherever it occurs, a run of (L+1)//2 words that starts at a multiple of that
    number. So one scan looks up only each such run's hash in the broadcast set of the items' runs, a fifth of a
    look-up for each word; documents with a hit (few) are then scanned window by window against the exact words. Both
    sets are broadcast behind a check of their size and joined by a shuffle beyond it.
    """
    w = words(F.col("_text"))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    items = benchmark.select(F.col(item_col).cast("string").alias("_item"), words(F.col(item_text_col)).alias("_w")).where(F.size("_w") > 0)
    items = items.withColumn("_len", F.least(F.size("_w"), F.lit(window)))
    windows = stored(items.select("_item", "_len", F.explode(_grams(F.col("_w"), F.col("_len"))).alias("_gram")).distinct())
    lengths = sorted(r[0] for r in windows.select("_len").distinct().collect())  # at most `window` values
    runs = sorted({(n + 1) // 2 for n in lengths})
    if not lengths:
        return docs.select(F.col(id_col), F.size(words(F.col(text_col))).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    of_items = [windows.where((F.col("_len") + 1).cast("int").isin(2 * n, 2 * n + 1)).select(F.explode(F.transform(_grams(F.split("_gram", " "), n), lambda g: F.xxhash64(g))).alias("_run")) for n in runs]
    run_set = stored(reduce(DataFrame.union, of_items).distinct())
    of_docs = let(w, lambda w: F.concat(*[F.transform(_grams(w, n, n), lambda g: F.xxhash64(g)) for n in runs]))
    found = texts.select("_id", F.explode(of_docs).alias("_run")).join(bounded(run_set), "_run", "left_semi").select("_id").distinct()
    found = stored(found.withColumnRenamed("_id", "_found"))
    suspects = stored(texts.join(bounded(found), F.col("_id").eqNullSafe(F.col("_found")), "left_semi"))  # few; read once for each length
    spans = reduce(DataFrame.union, [suspects.select("_id", F.lit(n).alias("_len"), F.posexplode(_grams(w, n)).alias("_start", "_gram")) for n in lengths])
    hits = stored(spans.join(bounded(windows), ["_len", "_gram"]).select("_id", "_start", (F.col("_start") + F.col("_len")).alias("_end"), "_item"))
    before = F.max("_end").over(Window.partitionBy("_id").orderBy("_start", "_end").rowsBetween(Window.unboundedPreceding, -1))
    covered = F.greatest(F.col("_end") - F.greatest(F.col("_start"), F.coalesce(F.col("_before"), F.lit(0))), F.lit(0))
    n_hit = hits.select("_id", "_start", "_end").distinct().withColumn("_before", before).groupBy("_id").agg(F.sum(covered).cast("long").alias("n_hit"))
    by_doc = n_hit.alias("n").join(hits.groupBy("_id").agg(F.sort_array(F.collect_set("_item")).alias("items")).alias("i"), F.col("n._id").eqNullSafe(F.col("i._id"))).select(F.col("n._id").alias("_hit_id"), "n_hit", "items")
    out = texts.select("_id", F.size(w).cast("long").alias("n_words")).join(by_doc, F.col("_id").eqNullSafe(F.col("_hit_id")), "left")
    return out.select(F.col("_id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """docs without the rows that hold an occurrence of a benchmark window; all other rows and columns as they are.

    Whether a row goes depends on its text only, so decisions are kept by the text's digest: rows that share an id or
    have none are decided one by one.
    """
    name = fresh(docs, "_bad")
    texts = docs.select(text_key(F.col("text")).alias(name), "text")
    bad = stored(contamination(texts, benchmark, window, id_col=name).where(F.col("n_hit") > 0).select(name).distinct())
    return docs.join(bounded(bad), text_key(F.col("text")) == F.col(name), "left_anti")
