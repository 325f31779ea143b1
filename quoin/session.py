"""Helpers that read what the session was given; but for one planner rule nothing here changes its settings."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def prepare(spark: SparkSession) -> None:
    """Turn off a planner rule of Spark 4.1 that gives wrong results.

    With spark.sql.unionOutputPartitioning a union of two inputs that are hash-partitioned alike counts as
    partitioned so, but adaptive execution can coalesce the two inputs differently; a grouping above then finds the
    rows of a key in two partitions and returns the key twice or with part of its rows.
    """
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def spread(df: DataFrame) -> DataFrame:
    """Over all shuffle partitions, for rows of few bytes that cost much work: by bytes alone they would become one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder of ``spark.checkpoint.dir``.

    A folder of our own is set only where the session names none, and then only in local mode,
    where one machine is all there is.
    """
    spark = df.sparkSession
    prepare(spark)
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="quoin-checkpoint-")
        sc.setCheckpointDir(folder)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Free the files of shuffles and checkpoints that nothing refers to any more; else they stay until the driver happens to collect its garbage.

    The listeners hold the plan of the last action until another event comes, so an empty job goes before; and Py4J
    tells the JVM of objects that Python let go only once a second, so what waits there is handed over now.
    """
    spark.sparkContext.emptyRDD().count()
    gc.collect()
    waiting = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", None)
    try:
        while waiting:
            client, target = waiting.pop()
            client.garbage_collect_object(target, False)
    except IndexError:  # Py4J's own thread took the last
        pass
    spark.sparkContext._jvm.System.gc()


def in_slices(spark: SparkSession, slices: int, make: Callable[[int], DataFrame]) -> DataFrame:
    """All rows of make(0), make(1), …, done one after the other, so that only one slice's shuffles are on disk at a time."""
    parts = []
    for k in range(slices):
        parts.append(checkpoint(make(k)))
        release(spark)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def packed(df: DataFrame) -> Callable[..., DataFrame]:
    """A checkpoint of compressed columns instead of rows; call it with the names of the columns to read."""
    schema = df.schema

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as to:
                to.write_batch(batch)
            yield pa.record_batch({"packed": [sink.getvalue().to_pybytes()]})

    held = checkpoint(df.mapInArrow(pack, "packed binary"))

    def read(*columns: str) -> DataFrame:
        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for x in batch.column(0):
                    with pa.ipc.open_stream(x.as_buffer()) as rows:
                        for one in rows:
                            yield one.select([*columns])

        return held.mapInArrow(unpack, StructType([schema[c] for c in columns]))

    return read
