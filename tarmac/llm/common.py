"""What several operators use."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.streaming.paths import shared_folder

#: White space between words; every other character belongs to a word.
SPACE = r"[\x20\x09-\x0D]"


def words_of(text: Column) -> Column:
    """The words of a text; of a null or blank one, none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def byte_words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8. ``bytes.split`` parts at exactly the characters of ``SPACE``."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def quoted(name: str) -> str:
    """A column's name as Spark reads it literally, dots and back-ticks included."""
    return "`" + name.replace("`", "``") + "`"


def keep(df: DataFrame) -> DataFrame:
    """The table written to the shared folder and read back.

    It cuts the lineage: an executor lost later costs no earlier step.
    """
    spark = SparkSession.getActiveSession() or df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*kept: DataFrame) -> None:
    """Delete tables that ``keep`` has written and that nothing reads any more."""
    for df in kept:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            jvm = df.sparkSession.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def keep_in_buckets(df: DataFrame, column: str) -> DataFrame:
    """Like ``keep``, as a table in buckets of a column: joins by it need no shuffle of this side.

    ``df`` should come from a grouping by the column, so that a task holds few buckets.
    """
    spark = SparkSession.getActiveSession() or df.sparkSession
    name = f"llm_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = df.write.bucketBy(buckets, column).option("path", f"{shared_folder(spark)}/{name}")
    out.option("compression", "zstd").saveAsTable(name)
    return spark.table(name)
