"""Record files, plain or compressed (bzip2 files are split over tasks)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def text_lines(
    spark: SparkSession,
    path: str,
    *,
    name_glob: str | None = None,
    stream: bool = False,
    **options: str | int,
) -> DataFrame:
    """``value STRING``, one row per line of the files under ``path``.

    ``path`` may hold wildcards; ``name_glob`` keeps files by their name, such as
    ``On_Time_On_Time_Performance_2008_*.bz2``. For a stream, ``options`` such as
    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bound a micro-batch.
    """
    reader = (spark.readStream if stream else spark.read).options(**options)
    if name_glob is not None:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.schema("value STRING").format("text").load(path)
