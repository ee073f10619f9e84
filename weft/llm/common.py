"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BROADCAST_IDS = 1_000_000  # rows of a few longs
HOT_KEYS = 100_000
HOT_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data directory; only Spark's reader touches the path."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The shared folder is the session's spark.checkpoint.dir.

    Where that is unset, a temporary folder is used, but only with a local master: on a cluster a
    machine-local folder would lose lineage cuts together with the machine, so that is an error.
    """
    sc = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir().isDefined():
        if not sc._jsc.sc().getCheckpointDir().isDefined():
            sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
        return
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="weft-checkpoint-"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder (survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sweep(spark: SparkSession) -> None:
    """Free the disk of shuffles that no plan needs any more, once a checkpoint has cut them off.

    Spark deletes a shuffle's files on all executors when the driver's JVM collects the plan that made them, which a
    driver with little garbage puts off while the files of a long job pile up.
    """
    gc.collect()
    spark._jvm.System.gc()


def train_row(id_col: Column) -> Column:
    """True where a labelled row may be learned from: crc32(id as text) mod 4 is not 2."""
    return ~held_out_row(id_col)


def held_out_row(id_col: Column) -> Column:
    """crc32(id as text) mod 4 is 2; a null id is never held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def partitions_for(rows: int, per_partition: int, spark: SparkSession) -> int:
    """Partitions for so many rows: at least the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_partition))


def by_class(rows: DataFrame, classes: DataFrame, keys: list[str], count: str, how: str = "left") -> DataFrame:
    """``rows`` joined with ``classes``, one row a key with the number of rows it has in ``count``; ``how``: left or inner.

    Keys with more than one in HOT_KEYS of all rows (HOT_ROWS at least) are fewer than HOT_KEYS, whatever the input, so
    they are broadcast; the rest is shuffled, and no key there gathers more than that share in a task.
    """
    total, most = classes.agg(F.sum(count), F.max(count)).first()
    at = max(HOT_ROWS, (total or 0) // HOT_KEYS)
    if (most or 0) <= at:
        return rows.join(classes, keys, how)
    hot = classes.where(F.col(count) > at)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(classes.where(F.col(count) <= at), keys, how)
    return rows.join(F.broadcast(hot), keys).unionByName(rest)


def lowest_by_hash(rows: DataFrame, group: str, id_col: str, most: int, seed: int, salts: int = 64) -> DataFrame:
    """The ``most`` rows of each group with the lowest hashes of their ids.

    Hashes are spread evenly, so rows above the place where a group's ``most``-th hash lies, and a wide margin, are cut
    before the shuffle: a task ranks little more than ``most`` rows.  (A group whose hashes bunch up that unlikely gives
    fewer rows.)  With more than HOT_KEYS groups they are ranked within salts of a group first instead.
    """
    keyed = rows.withColumn("__h", F.xxhash64(F.lit(seed), id_col))
    sizes = rows.groupBy(F.col(group).alias("__g")).agg(F.count(F.lit(1)).alias("__size"))
    parts = [(group,)]
    if sizes.count() <= HOT_KEYS:
        share = F.least(F.lit(1.0), F.lit(most + 8 * most**0.5 + 16) / F.col("__size"))
        place = (F.col("__h") / F.lit(float(1 << 64))) + 0.5
        keyed = keyed.join(F.broadcast(sizes), F.col(group).eqNullSafe(F.col("__g"))).where(place <= share).drop("__g", "__size")
    else:
        parts = [(group, F.pmod(F.xxhash64("__h"), F.lit(salts))), *parts]
    for part in parts:
        order = Window.partitionBy(*part).orderBy("__h", id_col)
        keyed = keyed.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= most)
    return keyed.drop("__h", "__n")


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` over a partition's batches, handing freed memory back to the system at its end.

    Python workers are reused from task to task and stage to stage, and keep what they have freed.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
                libc.malloc_trim(0)

    return wrapped
