"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Folders made for sessions that name none, as in tests.
_OWN: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table. Only Spark's reader opens it, so any store that Spark reads will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir; a temporary one where it is unset and all run on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    return _OWN[app]


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it again.

    This cuts the lineage: what follows survives a lost executor without recomputing df, and row ids once written
    stay the same.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def deleted(spark: SparkSession, path: str) -> None:
    """Deletes a path in the shared folder, wherever that is."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ranked(df: DataFrame, by: list[Column], sums: tuple[str, ...] = (), rank: str = "at") -> DataFrame:
    """df with each row's rank from 0 in the order of by, and for each column of sums the sum over all rows before it, as c_before.

    Rows are dealt out by ranges; only a row of totals for each range is ordered in one place.
    """
    each = written(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = each.groupBy("_range").agg(F.count("*").alias("_n"), *(F.sum(c).alias(f"_{c}") for c in sums))
    starts = totals.select("_range", *(F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in ("n", *sums)))
    own = Window.partitionBy("_range").orderBy(*by)
    upto = own.rowsBetween(Window.unboundedPreceding, -1)
    local = each.select("*", (F.row_number().over(own) - 1).alias("_at"), *(F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(f"_{c}_own") for c in sums))
    added = [(F.col("_n") + F.col("_at")).alias(rank), *((F.col(f"_{c}") + F.col(f"_{c}_own")).alias(f"{c}_before") for c in sums)]
    return local.join(F.broadcast(starts), "_range").select(*df.columns, *added)


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty string."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def appended(batch: pa.RecordBatch, keep: tuple[str, ...], **new: pa.Array) -> pa.RecordBatch:
    """The columns to keep of a batch, as they are (whole numbers stay exact beside nulls), and new ones."""
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *new.values()], [*keep, *new])


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies on this machine; an existing path is returned as it is."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)
