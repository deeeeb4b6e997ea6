"""The corpus pipeline: toxic, near-duplicate and contaminated documents go, sources are mixed, the rest is encoded.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from polycat.llm.common import stored, table
from polycat.llm.decontaminate import drop_contaminated
from polycat.llm.minhash import drop_near_duplicates
from polycat.llm.mixing import mix
from polycat.llm.queries import tokenizer_path
from polycat.llm.sstable import encode_table
from polycat.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, trained on sf_dir's labels, calls toxic by their whole text. Null texts count as empty; an empty table stays empty; all columns pass through."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8): the one with the smallest id. Documents without words are near nothing and stay; of equal rows one stays; rows without an id are judged like others."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of an item of sf_dir's benchmark. Null and empty texts stay; rows that share an id are decided one by one; an empty benchmark takes nothing."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, up to twice. A null source is a source; rows that share an id or have none get copies of their own; an empty table stays empty."""
    return mix(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sorted-string-table shards; one row for each encoded document, read back from them. Null and empty texts are the end id alone; copies have a row each; no documents, no rows."""
    return encode_table(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_shards", token_shards),
]

#: SQL can't express the classifier and the encoding; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over sf_dir's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
