"""Readers and writers beside Spark's own: vector files, commented JSON, id lists, property feeds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TYPES = {"fvecs": np.dtype("<f4"), "ivecs": np.dtype("<i4"), "bvecs": np.dtype("u1")}


def read_vectors(spark: SparkSession, path: str, kind: str = "fvecs") -> DataFrame:
    """(path, pos, vec) of vector files: each vector is an int32 length and its components, no header. A file is one task's."""
    dt = _TYPES[kind]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, data in zip(pdf["path"], pdf["content"]):
                at, pos, rows = 0, 0, []
                while at < len(data):
                    d = int(np.frombuffer(data, "<i4", 1, at)[0])
                    rows.append((name, pos, np.frombuffer(data, dt, d, at + 4).astype(np.float64)))
                    at, pos = at + 4 + d * dt.itemsize, pos + 1
                    if len(rows) == 10_000:
                        yield pd.DataFrame(rows, columns=["path", "pos", "vec"])
                        rows = []
                yield pd.DataFrame(rows, columns=["path", "pos", "vec"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(decode, "path string, pos long, vec array<double>")


def encode_vectors(vecs, kind: str = "fvecs") -> bytes:
    return b"".join(np.int32(len(v)).tobytes() + np.asarray(v, _TYPES[kind]).tobytes() for v in vecs)


def write_vectors(df: DataFrame, folder: str, vec: str = "vec", kind: str = "fvecs") -> None:
    """One vector file per partition, named by its number. The folder must be one all executors share.

    A file is written under a name of its attempt and then renamed, so a task that is run again leaves one file.
    """
    import os

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        os.makedirs(folder, exist_ok=True)
        task = TaskContext.get()
        name, n = os.path.join(folder, f"part-{task.partitionId():05d}.{kind}"), 0
        with open(f"{name}.{task.taskAttemptId()}", "wb") as f:
            for pdf in batches:
                f.write(encode_vectors(pdf["v"], kind))
                n += len(pdf)
        os.replace(f.name, name)
        yield pd.DataFrame({"n": [n]})

    df.select(F.col(vec).alias("v")).mapInPandas(write, "n long").agg(F.sum("n")).collect()


def read_siftgeo(spark: SparkSession, path: str) -> DataFrame:
    """(path, pos, meta, vec) of descriptor files: nine floats of metadata, an int32 length and so many bytes."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, data in zip(pdf["path"], pdf["content"]):
                at, rows = 0, []
                while at + 40 <= len(data):
                    d = int(np.frombuffer(data, "<i4", 1, at + 36)[0])
                    rows.append((name, len(rows), np.frombuffer(data, "<f4", 9, at).astype(np.float64), np.frombuffer(data, "u1", d, at + 40).astype(np.float64)))
                    at += 40 + d
                yield pd.DataFrame(rows, columns=["path", "pos", "meta", "vec"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(decode, "path string, pos long, meta array<double>, vec array<double>")


def read_text_vectors(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """vec of text files with a vector a line, its numbers apart by white space; with ``first`` only so many lines of all."""
    lines = spark.read.text(path)
    vec = F.transform(F.split(F.trim("value"), r"\s+"), lambda x: x.try_cast("double"))
    return (lines.limit(first) if first is not None else lines).where(F.trim("value") != "").select(vec.alias("vec"))


#: Extensions of images.
IMAGES = ("jpg", "jpeg", "png", "gif", "bmp", "tif", "tiff", "webp")


def list_images(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modified, bytes) of the images in a folder and those below it; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    extension = F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1))
    return files.where(extension.isin(*IMAGES)).select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """(path, vec) of tab-separated features: a path and numbers apart by commas; lines of another form are left out."""
    parts = F.split("value", "\t")
    vec = F.transform(F.split(F.get(parts, F.lit(1)), ","), lambda x: F.trim(x).try_cast("double"))
    rows = spark.read.text(path).select(F.get(parts, F.lit(0)).alias("path"), vec.alias("vec"), F.size(parts).alias("n"))
    return rows.where((F.col("n") == 2) & (F.col("path") != "") & ~F.exists("vec", lambda x: x.isNull())).select("path", "vec")


def write_features(df: DataFrame, path: str, code: str | None = None, least: int = 8) -> None:
    """Features (path, vec) as read_features takes them; of coded ones only those whose code is at least so long."""
    rows = df.where(F.length(code) >= least) if code else df
    rows.select(F.concat_ws("\t", "path", F.array_join(F.col("vec").cast("array<string>"), ","))).write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a line, not escaped beyond what JSON asks for."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_split(df: DataFrame, with_: str, path: str) -> None:
    """CSV with a header, in two folders: rows that have a value in the column, and rows that don't."""
    for name, part in (("with", df.where(F.col(with_).isNotNull())), ("without", df.where(F.col(with_).isNull()).drop(with_))):
        part.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")


def write_report(df: DataFrame, path: str, sep: str = " | ") -> None:
    """Lines "name: value | name: value …" of all columns in their order; nulls as none."""
    cells = [F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("none"))) for c in df.columns]
    df.select(F.concat_ws(sep, *cells)).write.mode("overwrite").text(path)


def save_index(index: DataFrame, path: str, key: str = "key", buckets: int = 64) -> None:
    """An index as Parquet in folders by a hash of its key, so that a look-up of few keys reads few of them."""
    at = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    index.withColumn("bucket", at).repartition(F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path)


def load_index(spark: SparkSession, path: str, key: str = "key", wanted: list | None = None, buckets: int = 64) -> DataFrame:
    """A saved index, or its rows of the keys ``wanted``, which only reads their folders."""
    index = spark.read.parquet(path)
    if wanted is None:
        return index.drop("bucket")
    at = [r[0] for r in spark.createDataFrame([(k,) for k in wanted], [key]).select(F.pmod(F.xxhash64(F.col(key).cast(index.schema[key].dataType)), F.lit(buckets))).distinct().collect()]
    return index.where(F.col("bucket").isin(at) & F.col(key).isin(wanted)).drop("bucket")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)


def read_commented_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON value per file, with // comment lines and commas before a closing brace allowed; a bad file gives null."""
    text = spark.read.text(path, wholetext=True)
    clean = F.regexp_replace(F.regexp_replace("value", r"(?m)^\s*//.*$", ""), r",(\s*[}\]])", "$1")
    return text.select(F.from_json(clean, schema).alias("value"))


def read_matches(spark: SparkSession, path: str) -> DataFrame:
    """(src_id, tgt_id) of a JSON object from source to target id."""
    return read_commented_json(spark, path, "map<string,bigint>").select(F.explode("value").alias("src_id", "tgt_id"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Whole numbers, one a line; other lines are left out."""
    return spark.read.text(path).select(F.trim("value").try_cast("bigint").alias("id")).where(F.col("id").isNotNull())


def read_property_xml(spark: SparkSession, path: str, tag: str = "property") -> DataFrame:
    """Properties held in XML attributes; those without latitude are left out, a latitude of 90 means -90."""
    schema = "_property_id string, _latitude double, _longitude double, _property_name string"
    x = spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)
    lat = F.when(F.col("_latitude") == 90, -90.0).otherwise(F.col("_latitude"))
    return x.where(F.col("_latitude").isNotNull()).select(F.col("_property_id").alias("src_id"), lat.alias("lat"), F.col("_longitude").alias("lng"), F.col("_property_name").alias("name"))


def read_table(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A relational source; filters and columns are pushed down by the reader."""
    return spark.read.format("jdbc").options(url=url, dbtable=f"({query}) q", **options).load()
