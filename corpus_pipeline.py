"""The corpus pipeline: its stages in order, each written as Parquet and read again as the next one's documents.

All stages but the last take and give the columns COLUMNS; others are dropped by name, so none can clash. Every row is judged
on its own text, and rows that are equal are treated alike. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from tidewell.session import scratch

#: A text of which boilerplate takes more than this share may be a copy of a whole document, which near dedup is to judge.
COPY_SHARE = 0.5
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic by a model of the labels of those at hand.

    A null text is judged as an empty one, which no word makes toxic; rows of a null id have no label, and are judged too.
    Without toxic labels all rows stay.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs.select(*COLUMNS), model, name="__score").where(F.col("__score") < 0.5).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that recur on many sites.

    All rows stay: null and empty texts as they are, a text of boilerplate alone as an empty one, and n_chars is counted anew
    where lines went. A null source is no site.
    """
    out = line_dedup.remove_boilerplate(docs, copy_share=COPY_SHARE)
    n_chars = F.when(F.col("n_removed_lines") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return out.withColumn("n_chars", n_chars).select(*COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (5-word shingles, similarity 0.8 or more): that of the least id.

    Null, empty and blank texts are in no group and stay, repeated rows of them once.
    """
    return near_dedup.dedup(docs.select(*COLUMNS))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no 10-word window of the benchmark, nor a whole item of fewer words.

    Null and empty texts hold none. Rows of one id (or of none) go together if one of them holds a window.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens packed into sequences, with their ids. Null and empty texts give their closing id alone."""
    return packing.pack(docs)


STAGES = [("toxicity", civil), ("line dedup", lines), ("near dedup", distinct), ("decontamination", clean), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scratch(spark) as keep:
            docs = keep(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
