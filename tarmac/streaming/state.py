"""Settings of stateful streams, applied while a query starts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

PARTITIONS = "spark.sql.shuffle.partitions"
# State lives on disk with increments uploaded per batch, so it may outgrow memory.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Set them, then restore the session's own.

    The state gets the given number of partitions, by default the session's
    number of shuffle partitions. Every partition writes files in every batch, so
    a live job with few keys may ask for fewer. A query takes its settings when
    it starts, and the number of partitions stays with its checkpoint.
    """
    wanted = dict(STATE_SETTINGS)
    if partitions is not None:
        wanted[PARTITIONS] = str(partitions)
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
