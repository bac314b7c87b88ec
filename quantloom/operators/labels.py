"""Training-row operators: cleanup, splits, weights, scores of features, metrics, trees."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import is_finite, safe_corr
from .features import cumulated


def finite_rows(df: DataFrame) -> DataFrame:
    """Rows whose float columns are all finite; null counts as not finite."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.where(reduce(lambda a, b: a & b, [F.coalesce(is_finite(F.col(c)), F.lit(False)) for c in floats], F.lit(True)))


def time_split(df: DataFrame, day: str = "timeframe", days: int = 365) -> DataFrame:
    """With ``is_test``: the last ``days`` days of the table."""
    last = df.agg(F.max(day).alias("__last"))
    return df.join(F.broadcast(last)).withColumn("is_test", F.col(day) >= F.date_sub("__last", days)).drop("__last")


def class_weights(df: DataFrame, label: str, mode: str = "balanced", classes: Sequence[str] = ()) -> DataFrame:
    """With ``weight``: 1, balanced by class frequency, or 2 for the named classes."""
    if mode == "none":
        return df.withColumn("weight", F.lit(1.0))
    if mode == "double":
        return df.withColumn("weight", F.when(F.col(label).isin(*classes), 2.0).otherwise(1.0))
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n").alias("__total"), F.count(F.lit(1)).alias("__k"))
    weights = counts.join(F.broadcast(total)).select(label, (F.col("__total") / (F.col("__k") * F.col("__n"))).alias("weight"))
    return df.join(F.broadcast(weights), label)


def causal_zscore(df: DataFrame, columns: Sequence[str], by: str = "symbol", day: str = "timeframe") -> DataFrame:
    """Each value against its symbol's mean and deviation up to that row; 0 for null, for a first value and without spread."""
    w = Window.partitionBy(by).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    z = lambda c: F.when(F.stddev_samp(c).over(w) != 0, (F.col(c) - F.avg(c).over(w)) / F.stddev_samp(c).over(w))
    return df.withColumns({f"{c}_z": F.coalesce(z(c), F.lit(0.0)) for c in columns})


def stacked(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, x, y) for all rows and features, in one table."""
    return df.unpivot([target], list(features), "feature", "x").withColumnRenamed(target, "y").where("x is not null and y is not null")


def average_ranks(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """With ``{column}_rank``, the mean rank among equal values, from counts of distinct values.

    Values are counted first and cumulated over bands of equally many values, so no feature's rows meet in one task.
    """
    counts = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("__n"))
    ranked = cumulated(counts, by, column, ["__n"])
    rank = F.col("__before___n") + (F.col("__n") + 1) / 2
    return df.join(ranked.select(*by, column, rank.alias(f"{column}_rank")), [*by, column])


def spearman(rows: DataFrame) -> DataFrame:
    """(feature, rho) from rows (feature, x, y)."""
    ranked = average_ranks(average_ranks(rows, "x", ["feature"]), "y", ["feature"])
    return ranked.groupBy("feature").agg(safe_corr("x_rank", "y_rank").alias("rho"))


def binned_information(rows: DataFrame, x: str = "x", y: str = "y", by: str = "feature") -> DataFrame:
    """(feature, mi): mutual information, in nats, of two binned columns."""
    joint = rows.groupBy(by, x, y).agg(F.count(F.lit(1)).alias("n"))
    px = joint.groupBy(by, x).agg(F.sum("n").alias("nx"))
    py = joint.groupBy(by, y).agg(F.sum("n").alias("ny"))
    total = joint.groupBy(by).agg(F.sum("n").alias("nt"))
    every = joint.join(px, [by, x]).join(py, [by, y]).join(total, by)
    return every.groupBy(by).agg(F.sum(F.col("n") / F.col("nt") * F.ln(F.col("n") * F.col("nt") / (F.col("nx") * F.col("ny")))).alias("mi"))


def classification_metrics(predicted: DataFrame, label: str = "label", guess: str = "prediction") -> DataFrame:
    """(class, precision, recall, f1, accuracy, macro_f1) for each class; 0 where a share has nothing to divide by."""
    counts = predicted.groupBy(F.col(label).alias("l"), F.col(guess).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    classes = counts.select(F.col("l").alias("class")).union(counts.select("p")).distinct()
    hits = counts.where("l = p").select(F.col("l").alias("class"), F.col("n").alias("hit"))
    actual, guessed = (counts.groupBy(F.col(c).alias("class")).agg(F.sum("n").alias(name)) for c, name in (("l", "actual"), ("p", "guessed")))
    rows = classes.join(hits, "class", "left").join(actual, "class", "left").join(guessed, "class", "left").na.fill(0)
    rows = rows.withColumn("precision", share(F.col("hit"), F.col("guessed"))).withColumn("recall", share(F.col("hit"), F.col("actual")))
    rows = rows.withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    whole = rows.agg((F.sum("hit") / F.sum("actual")).alias("accuracy"), F.avg("f1").alias("macro_f1"))
    return rows.select("class", "precision", "recall", "f1").join(F.broadcast(whole))


def metric_report(predicted: DataFrame, whole: Mapping[str, Column], per_class: Mapping[str, Column] = {}, label: str = "label", guess: str = "prediction") -> DataFrame:
    """(metric, class, value) of a caller's metrics; class is null for those of the whole table.

    ``whole`` has aggregates over the columns ``label`` and ``prediction``; ``per_class`` has expressions of the numbers ``tp``,
    ``fp``, ``fn`` and ``tn`` of each class that is a label or a prediction. A null label or prediction is no class, but its row counts.
    A value without a definition, as a division by 0, is null.
    """
    rows = predicted.select(F.col(label).alias("label"), F.col(guess).alias("prediction"))
    as_rows = lambda columns: F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(c).cast("double").alias("value")) for c, n in columns]))
    none, out = F.lit(None).cast(rows.schema["label"].dataType).alias("class"), []
    if whole:
        names = [(f"__{i}", n) for i, n in enumerate(whole)]
        sums = rows.agg(*[c.alias(own) for (own, _), c in zip(names, whole.values())])
        out.append(sums.select(as_rows(names).alias("m")).select("m.metric", none, "m.value"))
    if per_class:
        counts = rows.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
        sides = F.explode(F.array_distinct(F.array("label", "prediction"))).alias("class")
        hit, own = F.col("label").eqNullSafe(F.col("class")), F.col("prediction").eqNullSafe(F.col("class"))
        number = lambda c, n: F.sum(F.when(c, F.col("n")).otherwise(0)).alias(n)
        sums = counts.select("*", sides).where("class is not null").groupBy("class").agg(number(hit & own, "tp"), number(~hit & own, "fp"), number(hit & ~own, "fn"))
        total = counts.agg(F.sum("n").alias("__n"))
        sums = sums.join(F.broadcast(total)).withColumn("tn", F.col("__n") - F.col("tp") - F.col("fp") - F.col("fn"))
        names = [(f"__{i}", n) for i, n in enumerate(per_class)]
        values = sums.select("class", *[c.alias(own) for (own, _), c in zip(names, per_class.values())])
        out.append(values.select("class", as_rows(names).alias("m")).select("m.metric", "class", "m.value"))
    if not out:
        raise ValueError("no metric is given")
    return reduce(DataFrame.unionByName, out)


def lasso_weights(df: DataFrame, features: Sequence[str], target: str, alpha: float = 1.0) -> DataFrame:
    """(feature, weight) of a lasso fit, by size of the weight."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rows = VectorAssembler(inputCols=list(features), outputCol="__x").transform(finite_rows(df.select(*features, target)))
    model = LinearRegression(featuresCol="__x", labelCol=target, elasticNetParam=1.0, regParam=alpha, standardization=False).fit(rows)
    pairs = [(f, float(w)) for f, w in zip(features, model.coefficients)]
    return df.sparkSession.createDataFrame(pairs, "feature string, weight double").orderBy(F.desc(F.abs("weight")), "feature")
