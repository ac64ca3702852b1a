"""From feature matrix to model input: fills, encodings, scaling, column choice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlore.sources.schemas import FEATURES
from orderlore.sources.tables import materialise


def column_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Means over non-null values, to store with a model."""
    return df.select(*[F.avg(c).alias(c) for c in columns]).first().asDict()


def column_scales(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column, to store with a model."""
    stats = df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns], *[F.stddev_pop(c).alias(f"dev_{c}") for c in columns]
    ).first()
    return {c: (stats[f"mean_{c}"], stats[f"dev_{c}"]) for c in columns}


def fill_mean(df: DataFrame, columns: Sequence[str], means: Mapping[str, float | None] | None = None) -> DataFrame:
    """Nulls of the named columns become a mean: a stored one, or the frame's own.

    The frame's own means take one pass now and only one row comes back, so
    give a stored frame when it is costly to compute.
    """
    means = column_means(df, columns) if means is None else means
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(means[c]).cast("double")) for c in columns})


def fill_constant(df: DataFrame, value: float) -> DataFrame:
    """Remaining nulls of all numeric columns become one value."""
    return df.na.fill(value)


def standardize(
    df: DataFrame, columns: Sequence[str], scales: Mapping[str, tuple[float, float]] | None = None
) -> DataFrame:
    """Zero mean and unit population deviation; constant columns become 0."""
    scales = column_scales(df, columns) if scales is None else scales
    return df.withColumns({c: _scaled(c, *scales[c]) for c in columns})


def _scaled(name: str, mean: float | None, deviation: float | None) -> Column:
    centred = F.col(name).cast("double") - F.lit(mean)
    return centred / F.lit(deviation) if deviation else F.when(F.col(name).isNotNull(), 0.0)


# --- categories -----------------------------------------------------------------


def category_classes(df: DataFrame, column: str) -> DataFrame:
    """The classes of a categorical column with their codes, ``(value, code)``, stored.

    Codes count up from 0 in ascending order of the values. Values are dealt to
    ranges and ranked there; a range's first code is the number of values in the
    ranges before it. Nulls have no code.
    """
    distinct = df.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct()
    ranges = materialise(distinct.repartitionByRange("value").withColumn("range", F.spark_partition_id()), "values")
    sizes = ranges.groupBy("range").agg(F.count("*").alias("n"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # a row per range
    sizes = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rank = F.row_number().over(W.partitionBy("range").orderBy("value"))
    coded = ranges.withColumn("rank", rank).join(sizes, "range")
    return materialise(coded.select("value", (F.col("before") + F.col("rank") - 1).cast("int").alias("code")), "classes")


def label_encode(df: DataFrame, column: str, classes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The column as the code of its value, and the classes.

    With given classes, e.g. those of the training data, a value outside them is an
    error at run time. Nulls are errors too.
    """
    classes = category_classes(df, column) if classes is None else classes
    coded = df.join(classes.select(F.col("value").alias("_value"), F.col("code").alias("_code")), F.col(column) == F.col("_value"), "left")
    unseen = F.raise_error(
        F.when(F.col(column).isNull(), F.lit(f"null in {column} has no code")).otherwise(
            F.concat(F.lit(f"value of {column} without a code: "), F.col(column).cast("string"))
        )
    )
    code = F.when(F.col("_code").isNull(), unseen.cast("int")).otherwise(F.col("_code"))
    return coded.select(*[code.alias(c) if c == column else F.col(c) for c in df.columns]), classes


def one_hot(df: DataFrame, column: str, classes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The column replaced by ``<column>0 .. <column>n``, one per class, and the classes."""
    coded, classes = label_encode(df, column, classes)
    cells = {f"{column}{i}": F.when(F.col(column) == i, 1.0).otherwise(0.0) for i in range(classes.count())}
    return coded.withColumns(cells).drop(column), classes


def power_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds the square and the square root of each column; a negative root is NaN."""
    return df.withColumns(
        {f"{c}_sq": F.col(c).cast("double") * F.col(c).cast("double") for c in columns}
        | {f"{c}_sqrt": F.sqrt(F.col(c).cast("double")) for c in columns}
    )


# --- columns ----------------------------------------------------------------------


def column_totals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with the sum of its non-null values."""
    sums = df.agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in columns])
    return sums.unpivot([], [F.coalesce(c, F.lit(0.0)).alias(c) for c in columns], "feature", "total")


def sparse_columns(df: DataFrame, columns: Sequence[str], min_total: float) -> list[str]:
    """Columns whose sum is below a limit. Judged on training data, stored with the model."""
    return sorted(r.feature for r in column_totals(df, columns).where(F.col("total") < min_total).collect())


def drop_sparse_columns(df: DataFrame, columns: Sequence[str], min_total: float) -> DataFrame:
    return df.drop(*sparse_columns(df, columns, min_total))


def model_input(df: DataFrame, features: Sequence[str] = FEATURES, label: str | None = "cancel") -> DataFrame:
    """Key, feature columns in model order as doubles, and the label if there is one."""
    target = [F.col(label).cast("double").alias("label")] if label else []
    return df.select("order_id", *[F.col(c).cast("double").alias(c) for c in features], *target)


def dataset_profile(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(F.count("*").alias("row_count"), F.lit(len(df.columns)).cast("int").alias("column_count"))
