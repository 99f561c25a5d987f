"""Helpers shared by the training-data operators (columns, tables, work folders)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import shared_dir

# ASCII white space: space and the range tab .. carriage return (fixed values).
SPACE_CHARS = " \t\n\x0b\f\r"
SPACE_RUN = r"[ \t-\r]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it (also inside lambdas) in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` equals that on pure ASCII text and is much faster."""
    return (F.when(F.octet_length(text) == F.length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def space_words(text: Column) -> Column:
    """Words between runs of ASCII white space; null and blank text have none."""
    none = F.array().cast("array<string>")
    return let(F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS)),
               lambda t: F.when(t == "", none).otherwise(F.split(t, SPACE_RUN)))


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to a fresh folder of the cluster's shared directory and read it back.

    Cuts the lineage with files every executor can reach, so the loss of an
    executor costs no recomputation of what stands before.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's shuffle width; users size it to the data, so blocks follow it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
