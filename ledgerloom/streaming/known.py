"""Known ids as keyed state: which records of a feed have an id that was published before.

The state store of the streaming query holds a count of records per id. A batch counts its own
ids in its map tasks, and looks up and adds these ids only, so what it reads does not grow with
the batches before it. An id is known if more records of it were told of than the batch has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators.relate import ID

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Records of an id in this batch and all before it; NULL in the records themselves.
TOLD = "told"


def with_told(feed: DataFrame) -> DataFrame:
    """A streaming feed, and beside its records one row per id of the batch with ``told``.

    Needs the RocksDB state store and the output mode ``update``. Records never pass through the
    state, so a common id is no load on one task.
    """
    counts = feed.where(F.col(ID).isNotNull()).groupBy(ID).agg(F.count("*").alias(TOLD))
    records = feed.withColumn(TOLD, F.lit(None).cast("bigint"))
    return records.unionByName(counts, allowMissingColumns=True)


def known_ids(told: DataFrame, records: DataFrame) -> DataFrame:
    """The ids of ``records``, a batch, that a batch before had."""
    own = records.where(F.col(ID).isNotNull()).groupBy(ID).agg(F.count("*").alias("_own"))
    return told.join(own, ID).where(F.col(TOLD) > F.col("_own")).select(ID)
