"""Serving tables as Parquet, one folder per batch, readable while a stream writes.

A batch is written to ``<root>/batch_id=N`` in one job; a replay of the batch
overwrites its own folder. Spark leaves ``_SUCCESS`` in a folder once it is
whole, and readers go by that.

Snapshot tables hold the whole answer in every batch: readers take the highest
whole one. Change tables hold the keys touched by the batch: readers take the
highest batch per key, which is an upsert by key. ``merge_changes`` folds batches into
``<root>/merged_to=N``. A table with a part column (``xyz`` by month) has a folder per
part below each of these: a merge writes anew only the parts that its batches touch, and
readers take the newest folder of each part, so filters on it leave whole folders out.
Nothing is replaced in place: a reader goes on with the folders it listed, and a merge
that is cut off has changed nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schema import Table

BATCH = "batch_id"
MERGED = "merged_to"


def _folder(spark: SparkSession, path: str):
    """File system of the path, and the path, as Hadoop objects (any file system Spark reads)."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def _whole(spark: SparkSession, root: str, label: str) -> list[int]:
    """Numbers of the whole ``<label>=N`` folders under the root, ascending."""
    files, pattern = _folder(spark, f"{root}/{label}=*/_SUCCESS")
    found = files.globStatus(pattern) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)


def _delete(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


ADAPTIVE = "spark.sql.adaptive.enabled"


#: Files of a part in a batch at most, by a hash of the key.
SPREAD = 8


#: Airports that the Bloom filters of a row group are sized for (some 25 KB a column).
AIRPORTS = 20_000


def _options(table: Table) -> dict[str, str]:
    """Bloom filters on the airports of the key.

    Statistics tell a row group apart only by the least and greatest airport, and
    dictionaries only while Parquet finds them worth writing.
    """
    columns = [c for c in table.key if c in ("airport", "origin", "destination")]
    on = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return on | {f"parquet.bloom.filter.expected.ndv#{c}": str(AIRPORTS) for c in columns}


def _schema(table: Table, *more: str) -> str:
    parts = [f"{table.part[0]} STRING"] if table.part else []
    return ", ".join([table.columns, *parts, *more])


def _columns(table: Table) -> list[str]:
    return table.schema.names + ([table.part[0]] if table.part else [])


def _write(df: DataFrame, path: str, table: Table) -> None:
    """Spread the rows by the key and sort by it, so lookups skip row groups and pages.

    Spark's adaptive execution joins small partitions, so the number of files goes by
    the size of the batch; a hash of the key is given, as Spark would leave out a
    shuffle by the key the state is kept by, and with it the joining. A stateful stream
    turns it off for its own plans; the write of a batch is a plan of its own and has it on.
    """
    rows, spread, order = df.select(*table.schema.names), F.xxhash64(*table.spread_by), list(table.key)
    if table.part:
        part, sql = table.part
        rows, order = rows.withColumn(part, F.expr(sql)), [part, *order]
        spread = F.xxhash64(part, F.pmod(spread, F.lit(SPREAD)))
    conf = df.sparkSession.conf
    before = conf.get(ADAPTIVE)
    conf.set(ADAPTIVE, "true")
    try:
        writer = rows.repartition(spread).sortWithinPartitions(*order).write.mode("overwrite").options(**_options(table))
        writer.partitionBy(*order[:1] if table.part else []).parquet(path)
    finally:
        conf.set(ADAPTIVE, before)


def next_batch(spark: SparkSession, root: str) -> int:
    """The number above all batches written and merged."""
    return max([-1, *_whole(spark, root, BATCH), *_whole(spark, root, MERGED)]) + 1


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def rename_files(spark: SparkSession, source: str, target: str, prefix: str) -> None:
    """Move the files of the ``column=value`` folders of a written table into one folder, named by value and number."""
    files, folder = _folder(spark, target)
    files.mkdirs(folder)
    for number, found in enumerate(files.globStatus(_folder(spark, f"{source}/*=*/part-*")[1]) or []):
        value, suffix = found.getPath().getParent().getName().split("=")[1], found.getPath().getName().split(".", 1)[1]
        files.rename(found.getPath(), _folder(spark, f"{target}/{prefix}_{value}_{number}.{suffix}")[1])


def write_snapshot(df: DataFrame, root: str, table: Table, batch_id: int = 0, *, keep: int = 10) -> None:
    """Write the whole answer as one batch, and drop all but the ``keep`` newest.

    Keep enough batches to outlast a running reader.
    """
    _write(df, f"{root}/{BATCH}={batch_id}", table)
    for old in _whole(df.sparkSession, root, BATCH)[:-keep]:
        if old < batch_id:
            _delete(df.sparkSession, f"{root}/{BATCH}={old}")


def read_snapshot(
    spark: SparkSession, root: str, table: Table, *, before: int | None = None
) -> DataFrame:
    """The highest whole batch, or the highest below ``before``."""
    batches = [n for n in _whole(spark, root, BATCH) if before is None or n < before]
    if not batches:
        return spark.createDataFrame([], table.schema)
    return spark.read.schema(table.schema).parquet(f"{root}/{BATCH}={batches[-1]}")


def write_changes(df: DataFrame, root: str, table: Table, batch_id: int = 0) -> None:
    """Write the touched keys as one batch; at most one row per key."""
    _write(df, f"{root}/{BATCH}={batch_id}", table)


#: The number of a table's base, below all batches.
BASE = -1


def write_base(df: DataFrame, root: str, table: Table) -> None:
    """Write the rows that a change table starts from, below all its batches."""
    _write(df, f"{root}/{MERGED}={BASE}", table)


def _parts(spark: SparkSession, root: str, table: Table) -> dict[str, list[str]]:
    """The whole merged folders of each part, oldest first; of a table without parts, under one name."""
    found: dict[str, list[str]] = {}
    for merged in _whole(spark, root, MERGED):
        folder = f"{root}/{MERGED}={merged}"
        if not table.part:
            found.setdefault("", []).append(folder)
            continue
        files, pattern = _folder(spark, f"{folder}/{table.part[0]}=*")
        for status in files.globStatus(pattern) or []:
            name = status.getPath().getName()
            found.setdefault(name, []).append(f"{folder}/{name}")
    return found


def _merged(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """The newest merged folder of each part."""
    newest = [folders[-1] for folders in _parts(spark, root, table).values()]
    if not newest:
        return spark.createDataFrame([], _schema(table))
    rows = spark.read.schema(_schema(table, f"{MERGED} INT")).option("basePath", root).parquet(*newest)
    return rows.select(*_columns(table))


def _changed(spark: SparkSession, root: str, table: Table, batches: list[int]) -> DataFrame:
    """The latest row of every key in the batches, one after the other in number."""
    if len(batches) == 1:
        return spark.read.schema(_schema(table)).parquet(f"{root}/{BATCH}={batches[0]}")
    schema = _schema(table, f"{BATCH} INT")
    rows = spark.read.schema(schema).option("basePath", root).parquet(f"{root}/{BATCH}=*")
    wanted = rows.filter(F.col(BATCH).between(batches[0], batches[-1]))
    # A number is aggregated by hash; a struct of the values would sort all rows.
    key = [*table.key, *_columns(table)[len(table.schema.names) :]]
    latest = wanted.groupBy(*key).agg(F.max(BATCH).alias(BATCH))
    return wanted.join(latest, [*key, BATCH], "left_semi").select(*_columns(table))


def _unmerged(spark: SparkSession, root: str) -> tuple[int, list[int]]:
    """The batch merged up to and the whole batches after it."""
    base = max(_whole(spark, root, MERGED), default=BASE - 1)
    return base, [n for n in _whole(spark, root, BATCH) if n > base]


def _above(merged: DataFrame, changed: DataFrame, table: Table) -> DataFrame:
    """Merged rows unless a change has their key, and the changes."""
    key = [c for c in _columns(table) if c in table.key or c not in table.schema.names]
    return merged.join(changed.select(*key), key, "left_anti").select(*_columns(table)).union(changed)


def read_changes(spark: SparkSession, root: str, table: Table, *, parts: bool = False) -> DataFrame:
    """The current rows of a change table, next to their part column if asked for.

    Merged rows are kept unless a later batch has their key. The later batches
    are few after a merge, so that test is a broadcast if Spark finds them small
    enough, and the merged table is then read without a shuffle. Filters on the
    key and the part reach all scans.
    """
    base, batches = _unmerged(spark, root)
    if not batches:
        rows = _merged(spark, root, table)
    else:
        rows = _changed(spark, root, table, batches)
        rows = rows if base < BASE else _above(_merged(spark, root, table), rows, table)
    return rows if parts else rows.select(*table.schema.names)


def merge_changes(spark: SparkSession, root: str, table: Table) -> None:
    """Fold all whole batches, so reads stay cheap; parts they do not touch stay as they are.

    Run it as a job of its own, now and then. The folded batches and the parts written
    anew are dropped at the next run, when readers of the former state are done.
    """
    base, batches = _unmerged(spark, root)
    if not batches:
        return
    changed, before = _changed(spark, root, table, batches), _parts(spark, root, table)
    merged, order = _merged(spark, root, table), list(table.key)
    if table.part:
        part = table.part[0]
        touched = [r[0] for r in changed.select(part).distinct().collect()]
        merged, order = merged.filter(F.col(part).isin(touched)), [part, *order]
    current = changed if base < BASE else _above(merged, changed, table)
    if table.ended:
        current = current.filter(f"NOT ({table.ended})")
    folded = [n for n in _whole(spark, root, BATCH) if n <= base]
    writer = current.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").options(**_options(table))
    writer.partitionBy(*order[:1] if table.part else []).parquet(f"{root}/{MERGED}={batches[-1]}")
    for old in folded:
        _delete(spark, f"{root}/{BATCH}={old}")
    for folders in before.values():
        for old in folders[:-1]:
            _delete(spark, old)
