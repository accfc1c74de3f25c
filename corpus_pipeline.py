"""From ``documents`` to packed training sequences, stage by stage.

Each stage takes the documents its predecessor kept and returns them with the columns
of ``documents``; the last returns the pieces of the packed sequences. Between stages
the rows are written as Parquet to the shared folder and read back.

Defined results: a null, empty or short text goes at the first stage. Rows without an id
are judged like others and are no copies of anything; of rows of one id that are no
copies the near-duplicate stage keeps one. Of copies the one of smallest id stays. Long
texts are judged whole and packed in as many pieces as they need. Further columns, of
whatever name, are carried up to the last stage. An empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import decontaminate, minhash, packing, quality, secrets
from tarmac.llm.common import keep
from tarmac.llm.queries import VOCABULARY


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash.drop_near_duplicates(docs, minhash.PIPELINE_RULE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    return packing.pack(docs, VOCABULARY)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret scan", secret_scan),
    ("packing", pack),
]

#: Sketches, automata and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the ``documents`` of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs
