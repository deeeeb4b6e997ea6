"""Sources mixed to target shares: entropy balancing on tokens, then whole copies of documents."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from polycat.llm.common import bounded, fresh, keyed, numbered, scratch, stored

#: A document is taken this often at most.
MOST = 2
#: Documents of one source and size are dealt their copies in runs of about this many.
RUN = 4096


def targets(totals: DataFrame, weights: tuple[int, ...], share: float) -> DataFrame:
    """source, sid, source_size, target from totals (source, source_size); one row for each source.

    Sources by code point, null last, have the weights in turn. Targets share `share` times all tokens by weight; those
    above MOST times their source's size stop there and the excess goes to the others by weight until none is above.
    That is a common level t with target = min(cap, weight * t): with sources in order of cap / weight, t is the
    largest of (budget - caps before) / (weights from here on).
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row for each source, not for each document
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    s = totals.withColumn("sid", F.row_number().over(order)).withColumn("_w", w).withColumn("_cap", MOST * F.col("source_size"))
    rise = Window.orderBy(F.col("_cap") / F.col("_w"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = s.withColumn("_full", F.coalesce(F.sum("_cap").over(rise), F.lit(0))).withColumn("_left", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(rise), F.lit(0)))
    s = s.withColumn("_level", (share * F.sum("source_size").over(every) - F.col("_full")) / F.col("_left"))
    level = F.max("_level").over(every)
    return s.select("source", "sid", "source_size", F.least(F.col("_cap").cast("double"), F.col("_w") * level).alias("target"))


def _rate(lam: str = "lam") -> F.Column:
    """Copies of a document of relative size x: MOST / 2 without a tilt, odds tilted by exp(lam * x)."""
    return F.lit(float(MOST)) / (1 + F.exp(-F.col(lam) * F.col("x")))


def balance(hist: DataFrame, sources: DataFrame, rounds: int = 200, tolerance: float = 1e-9) -> DataFrame:
    """sid, lam: the tilt of each source for which the expected tokens meet its target.

    hist: (sid, size, n, x) with n documents of that size; sources: (sid, source_size, target). The dual of the bounded
    entropy balancing problem is convex and its constraints do not overlap, so that its Newton step is one sum of
    gradient and curvature over each source, made by Spark over the histogram; a bracket keeps steps from going astray.
    Sources at their cap have the limit, lam = infinity, and empty ones 0. Raises if rounds don't suffice.
    """
    inf = float("inf")
    capped = F.col("target") >= MOST * F.col("source_size") * (1 - 1e-12)
    state = sources.select("sid", "target", "source_size", F.when(capped & (F.col("source_size") > 0), F.lit(inf)).otherwise(F.lit(0.0)).alias("lam"), F.lit(-inf).alias("lo"), F.lit(inf).alias("hi"), (capped | (F.col("source_size") == 0)).alias("done"))
    state = stored(state)
    for _ in range(rounds):
        open_ = state.where("not done")
        r = _rate()
        sums = hist.join(bounded(open_.select("sid", "lam")), "sid").groupBy("sid").agg(F.sum(F.col("n") * F.col("size") * r).alias("_g"), F.sum(F.col("n") * F.col("size") * F.col("x") * r * (MOST - r) / MOST).alias("_h"))
        s = state.join(sums, "sid", "left").withColumn("_gap", F.col("_g") - F.col("target"))
        s = s.withColumn("_lo", F.when(F.col("_gap") < 0, F.col("lam")).otherwise(F.col("lo"))).withColumn("_hi", F.when(F.col("_gap") >= 0, F.col("lam")).otherwise(F.col("hi")))
        newton = F.col("lam") - F.try_divide("_gap", "_h")
        middle = F.when((F.col("_lo") == -inf) & (F.col("_hi") == inf), F.col("lam")).when(F.col("_lo") == -inf, F.col("_hi") - 1 - F.abs("_hi")).when(F.col("_hi") == inf, F.col("_lo") + 1 + F.abs("_lo")).otherwise((F.col("_lo") + F.col("_hi")) / 2)
        near = F.abs("_gap") <= tolerance * F.col("source_size")
        step = F.when(newton.isNotNull() & (newton > F.col("_lo")) & (newton < F.col("_hi")) & (F.abs(newton - F.col("lam")) <= 2 + F.abs("lam")), newton).otherwise(middle)
        state = stored(s.select("sid", "target", "source_size", F.when(F.col("done") | near, F.col("lam")).otherwise(step).alias("lam"), F.coalesce("_lo", "lo").alias("lo"), F.coalesce("_hi", "hi").alias("hi"), (F.col("done") | F.coalesce(near, F.lit(True))).alias("done")))
        if not state.where("not done").limit(1).count():
            return state.select("sid", "lam")
    raise ArithmeticError(f"no tilt found in {rounds} rounds for sources {[r[0] for r in state.where('not done').select('sid').limit(5).collect()]}")


def _whole(pdf: pd.DataFrame) -> pd.DataFrame:
    """Whole copies for each size of one source: rates summed from the largest size on and rounded; what is then missing or too much goes to the largest sizes that fit."""
    pdf = pdf.sort_values("size", ascending=False, ignore_index=True)
    n, size, target = pdf["n"].to_numpy(), pdf["size"].to_numpy(), float(pdf["target"].iloc[0])
    edges = np.floor(np.cumsum(n * pdf["rate"].to_numpy()) + 0.5).astype(np.int64)
    copies = np.clip(np.diff(edges, prepend=0), 0, MOST * n)
    off = target - float((copies * size).sum())
    for i in np.flatnonzero((size > 0) & (size <= abs(off))):
        if size[i] <= abs(off):
            k = min(MOST * n[i] - copies[i], int(off // size[i])) if off > 0 else -min(copies[i], int(-off // size[i]))
            copies[i] += k
            off -= float(k * size[i])
    return pdf[["sid", "size", "n"]].assign(total=copies)


def mix_rates(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """id_col, the columns of keep, size, source_size, target, rate, copies for each row of docs.

    size: runs without white space in the text (null: 0). copies is 0 to MOST; the copies' tokens of a source come
    within about the smallest sizes of its target. The same rows always get the same copies: documents of one source
    and size are ranked by a hash of their id. Repeated rows count each; a null source is a source; null ids are
    dealt like others.

    Sizes are all that leaves the scan. Every Newton round reads the histogram of sizes (source, size, documents), and
    so does the rounding, one source at a time: at most as many rows as there are different sizes, however many
    documents a source has. Within a size, copies are dealt by rank in runs of some thousand documents.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    sizes = numbered(docs.select(F.col(id_col).alias("_id"), *keep, F.col(source_col).alias("source"), size.alias("size")), "_row")
    counts = stored(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    sources = stored(targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")).withColumn("source_size", F.coalesce("source_size", F.lit(0))), weights, share))
    few = bounded(sources.withColumnRenamed("source", "_s"))
    placed = counts.join(few, F.col("source").eqNullSafe(F.col("_s")))
    mean = placed.groupBy("sid").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("_mean"))
    hist = stored(placed.join(bounded(mean), "sid").select("sid", "size", "n", F.coalesce(F.try_divide(F.col("size"), F.col("_mean")), F.lit(0.0)).alias("x"), "target"))
    tilt = balance(hist, sources)
    rated = hist.join(bounded(tilt), "sid").withColumn("rate", F.when(F.col("lam") == float("inf"), F.lit(float(MOST))).otherwise(_rate()))
    dealt = stored(rated.groupBy("sid").applyInPandas(_whole, "sid int, size long, n long, total long").join(rated.select("sid", "size", "rate"), ["sid", "size"]))
    run = F.pmod(F.xxhash64("_id"), F.ceil(F.col("n") / RUN))
    rows = sizes.join(few, F.col("source").eqNullSafe(F.col("_s"))).join(bounded(dealt), ["sid", "size"]).withColumn("_run", run)
    of_runs = stored(rows.where(F.col("n") > RUN).groupBy("sid", "size", "_run").agg(F.count(F.lit(1)).alias("_k")))
    rows = rows.withColumns({"_hot": F.lit(False), "_part": F.lit(0).cast("long")})
    crowded = stored(of_runs.where(F.col("_k") > 4 * RUN).drop("_k"))
    if crowded.limit(1).count():  # ids that many rows share: their rows stand together, cut by place in the table, and count the same in any order
        ids = rows.join(bounded(crowded), ["sid", "size", "_run"], "left_semi").groupBy("sid", "size", F.col("_id").alias("_same")).agg(F.count(F.lit(1)).alias("_times"))
        ids = stored(ids.where(F.col("_times") > RUN).withColumnsRenamed({"sid": "_sid", "size": "_size"}))
        shared = (F.col("sid") == F.col("_sid")) & (F.col("size") == F.col("_size")) & F.col("_id").eqNullSafe(F.col("_same"))
        part = F.when(F.col("_times").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64("_row"), F.ceil(F.col("_times") / RUN))).cast("long")
        rows = rows.join(bounded(ids), shared, "left").withColumns({"_hot": F.col("_times").isNotNull(), "_part": part})
    hot_id = F.when(F.col("_hot"), F.col("_id")).alias("_hot_id")
    rows = rows.withColumn("_hot_id", hot_id)
    group = ["sid", "size", "_run", "_hot", "_hot_id", "_part"]
    before = Window.partitionBy("sid", "size").orderBy("_run", "_hot", F.col("_hot_id").asc_nulls_first(), "_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(rows.where(F.col("n") > RUN).groupBy(*group).agg(F.count(F.lit(1)).alias("_k")).withColumn("_before", F.coalesce(F.sum("_k").over(before), F.lit(0))).select(*[F.col(c).alias(f"_o{c}") for c in group], "_before"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.xxhash64("_id", F.lit(4)), "_id", *keep))
    same = F.lit(True)
    for c in group:
        same = same & (F.col(c).eqNullSafe(F.col(f"_o{c}")) if c == "_hot_id" else F.col(c) == F.col(f"_o{c}"))
    rows = rows.withColumn("_rank", rank).join(bounded(offsets), same, "left").withColumn("_j", F.col("_rank") + F.coalesce("_before", F.lit(0)))
    return rows.select(F.col("_id").alias(id_col), *keep, "size", "source_size", "target", "rate", F.expr("cast((_j * total) div n - ((_j - 1) * total) div n as int)").alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """docs with each row as often as mix_rates takes it, 0 to MOST times, with all their columns.

    Copies are dealt by a hash of id and text and given to rows by a key of their own, so rows that share an id or have
    none get no more than theirs. Null and empty texts have size 0 and weigh nothing; an empty table stays empty.
    """
    own, row, deal, times, copy = (fresh(docs, n) for n in ("_own", "_row", "_deal", "_times", "_copy"))
    rows = keyed(docs, own)
    hashed = rows.select(F.xxhash64("doc_id", "text").alias(deal), own, "text", "source")
    with scratch() as keep:
        taken = keep(stored(mix_rates(hashed, weights, share, id_col=deal, keep=(own,)).where("copies > 0").select(F.col(own).alias(row), F.col("copies").alias(times))))
    joined = rows.join(taken, F.col(own) == F.col(row))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), times)).alias(copy)).drop(copy)
