"""CSV files: feature matrices in, scores, bins and importances out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orderlore.sources.schemas import MATRIX_SCHEMA


def matrix_schema(target: bool = True, segments: bool = False) -> T.StructType:
    """Column types of a matrix file: with or without the target, with or without segments."""
    fields = [field for field in MATRIX_SCHEMA if target or field.name != "cancel"]
    if segments:
        fields.append(T.StructField("segments", T.StringType()))
    return T.StructType(fields)


def read_matrix(spark: SparkSession, path: str, target: bool = True, segments: bool = False, sep: str = ",") -> DataFrame:
    """A matrix CSV with a header line. Types are declared, so no pass over the data infers them."""
    return spark.read.csv(
        path, header=True, sep=sep, schema=matrix_schema(target, segments), enforceSchema=False, mode="FAILFAST"
    )


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """A folder of CSV parts with header lines. An empty field is a null; an empty text is quoted."""
    df.write.csv(path, header=True, sep=sep, emptyValue='""', nullValue="")
