"""Shards of one mixture by proportional stratified interleaving.

The rows of each source are shuffled by a seeded digest and ranked; a row's fractional
rank is its place in its source divided by the rows there, from an offset of the source's
own between 0 and 1. Sorted by fractional rank, any stretch of ranks holds of each source
its share of all rows, but for one row. The order is cut into shards whose row counts are
at most one apart (law ``rows``); what the sources' roundings add up to moves a cut.

Neither ranking passes through one task. Ranks within a source are counted by ranges of
the digest, and places in the order by ranges of the fractional rank: rows before a range
are summed from the counts of the ranges, rows within it by a window over a few thousand
rows. A source with a third of all rows is spread over as many ranges as it needs, and
sources of few rows lie apart by their offsets.

Defined results: a null text counts as empty in ``size`` and ``text_crc32``, but a null
and an empty text are different rows. Rows without a source are one source. Rows without
an id are placed like others. Repeated rows, equal in every column, get a place each and
may change places (they are ranked in one range); equal texts of different ids are spread
as all rows are. Rows of one id and text are ordered by a hash of all columns but maps. The length of a text plays no part. Fewer rows than shards leave shards empty; an
empty table gives none. Further columns are carried along; those named as the ones added
(``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tarmac.llm.common import keep, quoted

SHARDS, SEED, LAW = 16, 42, "rows"
#: Rows of a range at the mean; a window orders one range.
RANGE_ROWS = 4_000
ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _digest(seed: int) -> Column:
    """The seeded shuffle of a row: by id and text."""
    text = F.coalesce(F.concat(F.lit("="), "text"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text))


def _offset(seed: int) -> Column:
    """Where the order of a source begins, between 0 and 1."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), "__source"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def _before(counts: DataFrame, by: list[str]) -> DataFrame:
    """``before``, the rows of earlier ranges, next to each range's count ``n``."""
    window = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(window), F.lit(0)))


def _prepared(docs: DataFrame, carried: list[Column], tie: Column, seed: int) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(
        F.struct(*carried).alias("__row"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        _digest(seed).alias("__digest"),
        tie.cast("bigint").alias("__tie"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("__source"),
    )


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The documents (``doc_id``, ``text``, ``source`` and any other columns) with their places.

    ``size`` is the UTF-8 bytes of the text plus 1, ``text_crc32`` the checksum of those
    bytes, ``slot`` counts from 0 within ``shard``. ``grown_shard`` is null, as another
    number of shards cuts the order elsewhere. Whole rows are written before they are
    ranked; ``places`` does with a few bytes of each.
    """
    carried = [F.col(quoted(c)) for c in docs.columns if c.lower() not in ADDED]
    hashed = [F.col(quoted(f.name)) for f in docs.schema if not isinstance(f.dataType, MapType)]
    return _placed(_prepared(docs, carried, F.xxhash64(*hashed), seed), shards, seed)


def places(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``interleave`` without the texts: ``doc_id``, ``source`` and the columns added."""
    # Rows of one id, text and source differ in nothing that is carried.
    return _placed(_prepared(docs, [F.col("doc_id"), F.col("source")], F.lit(0), seed), shards, seed)


def _placed(rows: DataFrame, shards: int, seed: int) -> DataFrame:
    rows = keep(rows)
    total = rows.count()
    ranges = max(1, -(-total // RANGE_ROWS))
    # 52 bits of the digest as a number spread evenly over the ranges.
    part = F.conv(F.substring("__digest", 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
    rows = rows.withColumn("__range", F.floor(part * ranges).cast("bigint"))
    counts = keep(_before(rows.groupBy("__source", "__range").agg(F.count("*").alias("n")), ["__source"]))
    sizes = counts.groupBy("__source").agg(F.sum("n").alias("__n"))
    counts = counts.join(sizes, "__source").select("__source", "__range", "before", "__n")
    within = Window.partitionBy("__source", "__range").orderBy("__digest", "__tie", "size")
    rows = rows.join(counts, ["__source", "__range"])
    rank = F.row_number().over(within) + F.col("before") - 1
    rows = rows.withColumn("__at", (rank.cast("double") + _offset(seed)) / F.col("__n").cast("double"))
    rows = keep(rows.drop("__range", "before", "__n").withColumn("__range", F.floor(F.col("__at") * ranges).cast("bigint")))
    counts = keep(_before(rows.groupBy("__range").agg(F.count("*").alias("n")), []))
    within = Window.partitionBy("__range").orderBy("__at", "__source", "__digest", "__tie", "size")
    place = (F.row_number().over(within) + F.col("before") - 1).cast("bigint")
    rows = rows.join(counts.select("__range", "before"), "__range").withColumn("__place", place)
    # The shards begin at ceil(shard * total / shards).
    shard = F.expr(f"__place * {shards} DIV {max(1, total)}")
    begin = F.expr(f"(shard * {total} + {shards - 1}) DIV {shards}")
    rows = rows.withColumn("shard", shard.cast("int"))
    rows = rows.withColumns({"slot": F.col("__place") - begin.cast("bigint"), "grown_shard": F.lit(None).cast("int")})
    return rows.select("__row.*", *ADDED)


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """The shards as Parquet folders ``shard=N``, each in the order of its slots.

    A shard of many rows is written by several tasks, cut by ranges of slots.
    """
    placed = interleave(docs, shards, seed)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
