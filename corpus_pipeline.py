"""A training corpus from ``documents``: five stages, one table after the other.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor
kept, and returns a DataFrame; ``run`` writes it as Parquet into the shared folder
and the next stage reads that. All but the last return the columns of
``documents``. An empty table, null texts or repeated rows pass through every
stage as its operator defines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm import decontaminate, mixing, quality, simhash, tokenfiles
from cohortline.llm.common import bounded_batches, scratch, stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier accepts."""
    bounded_batches(spark)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash near-duplicate class."""
    bounded_batches(spark)
    return simhash.keep_one(docs)


def unseen_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item of ``benchmark``."""
    bounded_batches(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their target weights, in the order of the mix.

    Documents of sources short of their share come again in further epochs;
    none is dropped. The rows are returned in ranges of the mix's position, so
    the table's files and the rows in them are in the order of the mix.
    """
    mixed = mixing.mix(docs)
    position = mixed.columns[-1]
    return mixed.repartitionByRange(position).sortWithinPartitions(position).select(*docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files in the order of the table's files and rows, read back.

    Files are ordered by the number of the task that wrote them, not by their names as text: from
    100,000 files on these have more digits. ``(doc_id, start, n_tokens, ids_crc32)`` per document and epoch.
    """
    bounded_batches(spark)
    name = F.col("_metadata.file_name")
    order = [F.regexp_extract(name, r"part-(\d+)", 1).try_cast("long"), name, F.col("_metadata.row_index")]
    shards = tokenfiles.write_tokens(docs, scratch(spark, "corpus"), order=order)
    return tokenfiles.read_tokens(shards).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_each),
    ("benchmark decontamination", unseen_benchmarks),
    ("mixing sources to target weights", mixed_sources),
    ("token-ID / binary output", token_files),
]

#: No stage but the mixing can be put in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"corpus-{k}")
    return docs
