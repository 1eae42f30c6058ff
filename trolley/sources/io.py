"""Sources and sinks: CSV/Parquet scans, catalog views, stored stages, submission output."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Explicit schemas of the basket files (no schema inference: it costs an extra scan and turns a shifted CSV
# row into a string column).
ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("eval_set", T.StringType()),
        T.StructField("order_number", T.IntegerType()),
        T.StructField("order_dow", T.IntegerType()),
        T.StructField("order_hour_of_day", T.IntegerType()),
        T.StructField("days_since_prior_order", T.IntegerType()),
    ]
)
LINES_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("add_to_cart_order", T.IntegerType()),
        T.StructField("reordered", T.IntegerType()),
    ]
)
PRODUCTS_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("aisle_id", T.StringType()),  # kept as text: dirty rows are cast with try_cast later
        T.StructField("department_id", T.IntegerType()),
    ]
)
AISLES_SCHEMA = T.StructType([T.StructField("aisle_id", T.IntegerType()), T.StructField("aisle", T.StringType())])
DEPARTMENTS_SCHEMA = T.StructType(
    [T.StructField("department_id", T.IntegerType()), T.StructField("department", T.StringType())]
)
SUBMISSION_SCHEMA = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("products", T.StringType())])


CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, *, header: bool = True, corrupt: bool = False
) -> DataFrame:
    """IO1: CSV scan with a header and an explicit schema.

    A field that does not fit its type is NULL. With ``corrupt`` the column ``_corrupt_record`` holds the whole line of
    such a row (NULL for good rows), so that bad rows can be counted (``audits.malformed_rows``).
    """
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, *, compression: str = "none") -> None:
    """The counterpart of ``read_csv``: CSV with a header, ``gzip`` if wanted."""
    df.write.mode("overwrite").option("header", True).option("compression", compression).csv(path)


def read_lines(spark: SparkSession, path: str, schema: T.StructType = LINES_SCHEMA) -> DataFrame:
    """IO2: the large order-lines table, read by the executors.

    Parquet folders/files are read as Parquet; anything else as CSV (``.gz``/``.bz2`` are decompressed by the
    scan). A zip archive is not splittable and is not supported: unpack it to the shared store first.
    """
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return read_csv(spark, path, schema)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """IO3: a Parquet-backed table."""
    return spark.read.parquet(path)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """IO5: register each frame as a temporary view under its name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def materialize(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> DataFrame:
    """IO6: store a stage as Parquet (replacing it) and return a frame reading the stored files.

    Reading the files back cuts the lineage, keeps column pruning and filter pushdown for later queries, and a
    lost executor then costs a file re-read instead of a recomputation.
    """
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_submission(df: DataFrame, path: str) -> None:
    """IO8: write ``order_id, products`` as CSV with a header."""
    df.select("order_id", "products").write.mode("overwrite").option("header", True).csv(path)
