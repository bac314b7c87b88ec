"""Scans: drifting Parquet files, factor CSV, ticker and company JSON, candle selections, SQL over tables."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_COLUMNS = ("date", "ticker", "open", "close", "high", "low", "volume")
# fixed values: the columns of a factor file after its unnamed day column
FACTOR_COLUMNS = ("mkt_rf", "smb", "hml", "rmw", "cma", "rf")
COMPANY_FACTS = "struct<cik:bigint,entityName:string,facts:map<string,map<string,struct<label:string,description:string,units:map<string,array<struct<start:string,end:string,val:decimal(38,0),filed:string,fp:string>>>>>>>"


def physical_schemas(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """(schema, files): the Parquet files in and below ``path`` by the names and types, in the files, of those ``columns`` that they have.

    Executors read the footers; a file's rows are not touched. Places are opened with pyarrow, so its file systems are those that are known.
    Hidden files and folders, beginning with ``_`` or ``.``, are left out, as in every scan.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).select("path")
    wanted = set(columns)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs, parquet

        for batch in batches:
            schemas = []
            for file in batch["path"]:
                if file.startswith("file:"):
                    system, place = fs.LocalFileSystem(), re.sub(r"^file:/+", "/", file)
                else:
                    system, place = fs.FileSystem.from_uri(file)
                schema = parquet.read_schema(place, filesystem=system)
                schemas.append(json.dumps(sorted([f.name, str(f.type)] for f in schema if f.name in wanted)))
            yield pd.DataFrame({"path": batch["path"], "schema": schemas})

    rows = found.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInPandas(read, "path string, schema string")
    return rows.groupBy("schema").agg(F.sort_array(F.collect_list("path")).alias("files"))


def read_drifting(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] = RAW_COLUMNS, types: dict[str, str] | None = None) -> DataFrame:
    """Parquet files whose column types differ, with the named columns cast alike; a missing column is null, others are left out.

    Of a folder, the files are grouped by their own schemas and each group is one scan, which no file's type can
    break. A list names folders of one schema each. The file names pass through the driver, as in every scan.
    """
    types = {"date": "timestamp_ntz"} | (types or {})
    groups = [r.files for r in physical_schemas(spark, path, columns).orderBy("schema").collect()] if isinstance(path, str) else [[p] for p in path]
    parts, known = [spark.read.parquet(*files) for files in groups], {}
    for df in parts:
        known |= {f.name: f.dataType for f in df.schema if f.name not in known}
    kind = {c: types.get(c, known.get(c, "double")) for c in columns}
    parts = [df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kind[c]).alias(c) for c in columns]) for df in parts]
    if not parts:
        return spark.createDataFrame([], ", ".join(f"`{c}` {kind[c]}" for c in columns))
    return reduce(DataFrame.unionByName, parts)


def read_factor_csv(spark: SparkSession, path: str, region_pattern: str = r"([a-z_]+)[^/]*$") -> DataFrame:
    """Factor files: lines that start with a day of eight digits are data, whatever stands before or after them.

    A bad number raises. The region is what ``region_pattern`` finds in the file's path.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where(F.col("value").rlike(r"^\s*\d{8}\s*,"))
    cell = F.split("value", ",")
    return lines.select(F.regexp_extract("file", region_pattern, 1).alias("region"), F.to_date(F.trim(cell[0]), "yyyyMMdd").alias("timeframe"), *[F.trim(cell[i + 1]).cast("double").alias(c) for i, c in enumerate(FACTOR_COLUMNS)])


def parse_tickers(documents: DataFrame, column: str = "value") -> DataFrame:
    """JSON objects of numbered entries as rows: cik, ticker, title."""
    entry = F.explode(F.map_values(F.from_json(column, "map<string,struct<cik_str:bigint,ticker:string,title:string>>")))
    return documents.select(entry.alias("e")).select(F.col("e.cik_str").alias("cik"), "e.ticker", "e.title")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row a file: value, file."""
    return spark.read.option("wholetext", True).text(path).select("value", F.col("_metadata.file_name").alias("file"))


def parse_facts(documents: DataFrame) -> DataFrame:
    """Company documents: cik (of the document, else the digits of its file name), name, facts; facts are null where a document can't be read."""
    parsed = documents.withColumn("d", F.from_json("value", COMPANY_FACTS))
    from_name = F.regexp_extract("file", r"0*([1-9]\d*)", 1)
    return parsed.select(F.coalesce("d.cik", from_name.try_cast("long")).alias("cik"), F.col("d.entityName").alias("name"), F.col("d.facts").alias("facts"))


def fact_rows(companies: DataFrame, namespace: str, indicator: str, unit: str) -> DataFrame:
    """(cik, start, end, filed, val, pos) of one indicator; ``pos`` is the entry's place in its document."""
    return named_fact_rows(companies, [("", namespace, indicator, unit)]).drop("metric")


def named_fact_rows(companies: DataFrame, wanted: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """(cik, metric, start, end, filed, val, pos) of all the indicators (metric, namespace, indicator, unit), with documents parsed once."""
    entries = lambda space, name, unit: F.try_element_at(F.try_element_at(F.try_element_at("facts", F.lit(space)), F.lit(name))["units"], F.lit(unit))
    lists = F.array(*[F.struct(F.lit(metric).alias("metric"), entries(*place).alias("entries")) for metric, *place in wanted])
    rows = companies.select("cik", F.explode(lists).alias("m")).select("cik", "m.metric", F.posexplode("m.entries").alias("pos", "e"))
    day = lambda c: F.try_to_timestamp(F.col(f"e.{c}"), F.lit("yyyy-MM-dd")).cast("date").alias(c)
    return rows.select("cik", "metric", day("start"), day("end"), day("filed"), F.col("e.val").alias("val"), "pos")


def indicator_catalogue(companies: DataFrame) -> DataFrame:
    """(namespace, indicator, label, description, companies): the number of companies that report each indicator."""
    spaces = companies.select("cik", F.explode("facts").alias("namespace", "indicators")).where(F.col("namespace").isin("dei", "us-gaap"))
    every = spaces.select("cik", "namespace", F.explode("indicators").alias("indicator", "body"))
    keys = ["namespace", "indicator", F.col("body.label").alias("label"), F.col("body.description").alias("description")]
    # a company without number counts as one
    return every.groupBy(*keys).agg((F.count_distinct("cik") + F.max(F.col("cik").isNull().cast("int"))).alias("companies"))


def select_candles(candles: DataFrame, year=None, month=None, symbol=None, start=None, end=None) -> DataFrame:
    """Candles of the given years, months and symbols (one or several each) and days in [start, end)."""

    def among(c: Column, wanted) -> Column:
        return c.isin(*wanted) if isinstance(wanted, (list, tuple, set)) else c == wanted

    for c, wanted in ((F.year("timeframe"), year), (F.month("timeframe"), month), (F.col("symbol"), symbol)):
        if wanted is not None:
            candles = candles.where(among(c, wanted))
    if start is not None:
        candles = candles.where(F.col("timeframe") >= F.lit(start).cast("date"))
    if end is not None:
        candles = candles.where(F.col("timeframe") < F.lit(end).cast("date"))
    return candles


def run_sql(spark: SparkSession, sf_dir: str, sql: str, tables: Sequence[str]) -> DataFrame:
    """The result of a query over the named tables."""
    for t in tables:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    return spark.sql(sql)


def wide_to_long(wide: DataFrame, day: str, fields: Sequence[str], block: str | None = None) -> DataFrame:
    """Columns named ``{symbol}_{field}`` as rows (symbol, day, fields...); missing cells stay null. A table in several blocks of columns has
    the number of its block in ``block``, which stays a column."""
    keys = [day] if block is None else [day, block]
    long = wide.unpivot(keys, [c for c in wide.columns if c not in keys], "__name", "__value")
    long = long.withColumns({"symbol": F.regexp_extract("__name", r"^(.*)_([^_]+)$", 1), "__field": F.lower(F.regexp_extract("__name", r"^(.*)_([^_]+)$", 2))})
    return long.groupBy("symbol", *keys).agg(*[F.max(F.when(F.col("__field") == f, F.col("__value"))).alias(f) for f in fields])
