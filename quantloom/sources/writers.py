"""Sinks: full refresh, exports, schema sidecars, violations; and tables written for later reads."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, shared by all executors. Where it is unset, a local session
    gets a new temporary folder; on a cluster that is an error, since executors share no local folder."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        place = tempfile.mkdtemp(prefix="spark-quantloom-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written as Parquet to a new place and read back."""
    path = new_path(df.sparkSession, name)
    full_refresh(df, path, partition_by)
    return df.sparkSession.read.parquet(path)


def forget(*tables: DataFrame) -> None:
    """Delete what ``written`` wrote, once nothing reads it any more; a table that is gone already is no error."""
    for df in tables:
        for file in df.inputFiles()[:1]:
            jvm = df.sparkSession._jvm
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of each query that runs inside when it ends, not when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def full_refresh(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table at ``path``; no partition of an earlier run survives."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)


def describe_table(df: DataFrame, name: str, partitions: Sequence[str] = ()) -> DataFrame:
    """One row that describes a table: name, partitions, row_count, and its columns with their types."""
    fields = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type")) for f in df.schema])
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("name"), F.array(*[F.lit(p) for p in partitions]).cast("array<string>").alias("partitions"), "row_count", fields.alias("columns"))


def export_csv(df: DataFrame, path: str, order: Sequence[str]) -> None:
    df.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def flat_columns(df: DataFrame) -> DataFrame:
    """``df`` without nested columns, which CSV can't hold."""
    return df.select(*[f.name for f in df.schema if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))])


def write_violations(violations: DataFrame, path: str) -> None:
    flat_columns(violations).write.mode("overwrite").option("header", True).csv(path)
