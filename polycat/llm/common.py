"""Small helpers that the corpus operators share."""

from __future__ import annotations

import re
import string
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a broadcast side may have at most; larger sides are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
WHITE = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else; texts of ASCII only take the fast built-in."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a temporary one will do if all of Spark is one process, as in tests; on a cluster that raises."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not given:
        if not re.fullmatch(r"local(\[[^,]*(,.*)?\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        given = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.sparkContext.setCheckpointDir(given)
        given = spark.sparkContext.getCheckpointDir()
    return given.rstrip("/")


#: Rows of texts or sets that are handed to Python at once; Spark's 10,000 take hundreds of MB beside the heap.
TEXT_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame, arrow_rows: int | None = None) -> DataFrame:
    """df written to the shared folder as Parquet and read back: later reads survive a lost executor and repeat no work.

    arrow_rows sets how many rows Python functions in df get at once while it is written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/polycat-{uuid.uuid4().hex}"
    before = spark.conf.get(_ROWS)
    try:
        if arrow_rows:
            spark.conf.set(_ROWS, str(arrow_rows))
        df.write.parquet(path)
    finally:
        spark.conf.set(_ROWS, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    for taken in _scratch:
        taken[path] = out
    return out


#: Tables that stored() has written inside each scratch() that is open.
_scratch: list[dict[str, DataFrame]] = []


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Deletes at its end the tables that stored() wrote inside, but for those passed to what it gives. Nothing that leaves it may read the others."""
    taken: dict[str, DataFrame] = {}

    def keep(df: DataFrame) -> DataFrame:
        taken.pop(df.stored_at)
        return df

    _scratch.append(taken)
    try:
        yield keep
    finally:
        _scratch[:] = [t for t in _scratch if t is not taken]
        release(*taken.values())


def release(*tables: DataFrame) -> None:
    """Deletes tables that stored() wrote, once nothing that is still to be computed reads them."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        for taken in _scratch:
            taken.pop(df.stored_at, None)


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df (already stored or cheap to count), marked for broadcast if it has few enough rows; else left to a shuffle join."""
    return F.broadcast(df) if df.count() <= rows else df


def let(value: Column, use) -> Column:
    """use(value) with value worked out once: Catalyst writes a column's expression out wherever it is used, also in the lambdas of higher-order functions."""
    return F.element_at(F.transform(F.array(value), use), 1)


def text_key(text: Column) -> Column:
    """Digest of a whole text, null as empty: what a decision about the text alone is kept by, whatever the row's id."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """df stored with a key of its own for each row in the new column name."""
    return stored(df.withColumn(name, F.monotonically_increasing_id()))


def keyed(df: DataFrame, name: str) -> DataFrame:
    """df with a key of its own for each row in the new column name, the same whenever df is read.

    Rows of Parquet files are known by their file's place among the files and their own in it, and nothing is written. Where rows don't
    come from files, or a plan repeats them, numbered() stores them. df is read again, so it must give the same rows each time.
    """
    at, row, nth = (fresh(df, n) for n in ("_file", "_place", "_nth"))
    try:
        placed = df.select("*", F.col("_metadata.file_path").alias(at), F.col("_metadata.row_index").alias(row))
    except AnalysisException:  # no files, or of another kind
        return numbered(df, name)
    files = sorted(r[0] for r in placed.select(at).where(F.col(at).isNotNull()).distinct().collect())
    if not files:
        return numbered(df, name)
    order = F.broadcast(df.sparkSession.createDataFrame(list(enumerate(files)), f"{nth} long, {at} string"))
    out = placed.join(order, at, "left").withColumn(name, F.shiftleft(nth, 40) + F.col(row))
    n, known = out.agg(F.count(F.lit(1)), F.count_distinct(name)).first()
    return out.select(*[F.col(f"`{c}`") for c in df.columns], name) if n == known else numbered(df, name)


def fresh(df: DataFrame, name: str) -> str:
    """name, lengthened until df has no such column, so that columns of any name can pass through."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
