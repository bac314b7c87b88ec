"""Keyed upserts, drift alignment, diffs and repairs."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def merge_latest(batches: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """All batches with one row a key: of the latest batch, in it the greatest by ``order`` and then by all columns."""
    tagged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [b.withColumn("__batch", F.lit(i)) for i, b in enumerate(batches)])
    rest = [c for c in tagged.columns if c not in (*keys, *order, "__batch")]
    w = Window.partitionBy(*keys).orderBy(F.desc("__batch"), *[F.desc(c) for c in (*order, *rest)])
    return tagged.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__batch")


# A stored table is a folder of immutable data and of manifests. A write adds its partitions under data/__write=<n>/ and then one
# manifest, a single file that appears by one rename when its job commits. It names for each live partition the write that
# holds it. Readers go by the manifest with the highest version, so a write that dies at any point leaves the table as it was.
DATA, MANIFESTS = "data", "manifests"
_MANIFEST = "version long, write string, folder string, schema string"


def _manifests(spark: SparkSession, path: str) -> DataFrame:
    """All manifests at ``path``; none if the table has not been written."""
    folder = f"{path.rstrip('/')}/{MANIFESTS}"
    try:
        return spark.read.schema(_MANIFEST).option("recursiveFileLookup", True).json(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)


def live_partitions(spark: SparkSession, path: str) -> list[Row]:
    """(version, write, folder, schema) of the newest version's partitions, one row each; none for a new table."""
    every = _manifests(spark, path)
    newest = every.agg(F.max("version")).first()[0]
    return [] if newest is None else every.where(F.col("version") == newest).collect()


def _read(spark: SparkSession, path: str, live: Sequence[Row]) -> DataFrame:
    """Only the folders that a manifest names are listed; partition columns come from the folders' names."""
    schema = T.StructType.fromJson(json.loads(live[0].schema))
    base = f"{path.rstrip('/')}/{DATA}"
    stored = T.StructType([*schema.fields, T.StructField("__write", T.StringType())])
    folders = [f"{base}/__write={r.write}/{r.folder}" for r in live if r.folder is not None]
    if not folders:
        return spark.createDataFrame([], T.StructType([*stored.fields, T.StructField("__file", T.StringType())]))
    return spark.read.schema(stored).option("basePath", base).parquet(*folders).select(*schema.names, "__write", F.col("_metadata.file_path").alias("__file"))


def _folder(depth: int) -> Column:
    """The folder of a file below its write's, such as ``year=2024/month=1``, from its address in ``__file``."""
    names = F.slice(F.reverse(F.split("__file", "/")), 2, depth)
    return F.url_decode(F.replace(F.array_join(F.reverse(names), "/"), F.lit("+"), F.lit("%2B"))).alias("folder")


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table that ``upsert_partitions`` keeps at ``path``, in its newest or in an earlier ``version`` that is still there."""
    live = live_partitions(spark, path) if version is None else _manifests(spark, path).where(F.col("version") == version).collect()
    if not live:
        raise ValueError(f"no table at {path}" + ("" if version is None else f" in version {version}"))
    return _read(spark, path, live).drop("__write", "__file")


def upsert_partitions(df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> None:
    """Merge ``df`` into the table at ``path`` (see ``read_table``); only the partitions that ``df`` touches are written.

    New rows replace stored ones of their keys in these partitions. Nothing stored is changed: the merged partitions are new files,
    and the table moves to them by one new manifest. So a write that dies leaves the old table, and the next one is unaffected; its
    files go with ``vacuum``. There should be one writer at a time. Columns that only one side has are kept, null elsewhere.
    An empty ``df`` adds a version with the same rows. The list of partitions, not of rows, passes through the driver.
    """
    spark = df.sparkSession
    missing = [c for c in partition_by if c not in df.columns]
    if missing:
        raise ValueError(f"partition columns are missing: {missing}")
    root = path.rstrip("/")
    live = live_partitions(spark, root)
    version = live[0].version + 1 if live else 1
    write = f"{version}-{uuid.uuid4().hex}"
    replaced: set[tuple[str, str]] = set()
    batches, schema = [df], df.schema
    if live:
        stored = _read(spark, root, live)
        old = stored
        if partition_by:
            touched = df.select(*[F.col(c).alias(f"__{c}") for c in partition_by]).distinct()
            old = stored.join(touched, reduce(lambda a, b: a & b, [stored[c].eqNullSafe(touched[f"__{c}"]) for c in partition_by]), "left_semi")
        replaced = {tuple(r) for r in old.select("__write", _folder(len(partition_by))).distinct().collect()}  # a row a partition
        names = {f.name for f in df.schema}
        schema = T.StructType([*df.schema.fields, *[f for f in stored.drop("__write", "__file").schema if f.name not in names]])
        batches = [align(old.drop("__write", "__file"), df.schema), df]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    placed = f"{root}/{DATA}/__write={write}"
    merge_latest(batches, keys).select(*schema.names).write.partitionBy(*partition_by).parquet(placed)
    files = spark.read.schema(schema).parquet(placed).select(F.col("_metadata.file_path").alias("__file"))
    fresh = [r[0] for r in files.select(_folder(len(partition_by))).distinct().collect()]
    kept = [(r.write, r.folder) for r in live if r.folder is not None and (r.write, r.folder) not in replaced]
    rows = [(version, *x, schema.json()) for x in [*kept, *[(write, f) for f in fresh]] or [(write, None)]]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.json(f"{root}/{MANIFESTS}/{write}")


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete the manifests before the newest ``keep`` versions and the data that none of these names, such as that of dead writes.

    Gives how many folders went. No write should be running.
    """
    root = path.rstrip("/")
    every = _manifests(spark, root)
    newest = every.agg(F.max("version")).first()[0]
    if newest is None:
        return 0
    named = {r.write: r.live for r in every.groupBy("write").agg(F.max(F.col("version") > newest - keep).alias("live")).collect()}
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    files = base.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    gone = 0
    for part, prefix in ((DATA, "__write="), (MANIFESTS, "")):
        folder = jvm.org.apache.hadoop.fs.Path(base, part)
        for entry in files.listStatus(folder) if files.exists(folder) else []:
            name = entry.getPath().getName().removeprefix(prefix)
            old = int(name.split("-")[0]) <= newest - keep
            if (part == DATA and not named.get(name)) or (part == MANIFESTS and old):
                gone += files.delete(entry.getPath(), True)
    return gone


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """``df`` with the target's columns first, in its order and types (null where a value can't be cast), then its own others."""
    have = set(df.columns)
    cols = [F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in target]
    names = {f.name for f in target}
    return df.select(*cols, *[c for c in df.columns if c not in names])


def new_since(incoming: DataFrame, stored: DataFrame, day: str) -> DataFrame:
    """Rows of ``incoming`` from the last stored day on (that day is pulled again); all, if nothing is stored."""
    last = stored.agg(F.max(day).alias("__last"))
    return incoming.join(F.broadcast(last), F.col("__last").isNull() | (F.col(day) >= F.col("__last"))).drop("__last")


def differences(stored: DataFrame, fresh: DataFrame, keys: Sequence[str], columns: Sequence[str], tolerance: float) -> DataFrame:
    """Keys whose values differ, with a flag for each column: either side is null, or they differ by more than the share ``tolerance`` of the larger."""
    a = stored.select(*keys, *[F.col(c).alias(f"{c}_stored") for c in columns])
    b = fresh.select(*keys, *[F.col(c).alias(f"{c}_fresh") for c in columns])
    both = a.join(b, list(keys), "full")
    for c in columns:
        x, y = F.col(f"{c}_stored"), F.col(f"{c}_fresh")
        both = both.withColumn(f"{c}_differs", x.isNull() | y.isNull() | (F.abs(x - y) > tolerance * F.greatest(F.abs(x), F.abs(y))))
    return both.where(reduce(lambda p, q: p | q, [F.col(f"{c}_differs") for c in columns]))


def repaired(stored: DataFrame, fresh: DataFrame, keys: Sequence[str], columns: Sequence[str], tolerance: float) -> DataFrame:
    """``stored`` with the fresh rows of all keys that differ."""
    changed = differences(stored, fresh, keys, columns, tolerance).select(*keys)
    return merge_latest([stored, align(fresh.join(changed, list(keys), "left_semi"), stored.schema)], keys)
