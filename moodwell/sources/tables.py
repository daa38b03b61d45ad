"""The stored tables: Parquet, partitioned by batch."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_posts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table; a filter on ``batch_id`` reads only the folders of these batches."""
    return spark.read.schema(schema).parquet(path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Make an empty table where there is none, so that it can be read. An action."""
    spark.createDataFrame([], schema).write.mode("append").partitionBy("batch_id").parquet(path)


def _write(df: DataFrame, path: str, mode: str, compact: bool) -> int:
    counted = Observation()
    out = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    if compact:
        # Gathers the files of a batch and, unlike a plain repartition, lets
        # adaptive execution split a batch that is too large for one task.
        out = out.hint("rebalance", "batch_id")
    (
        out.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )
    return counted.get["rows"]


def append_posts(df: DataFrame, path: str, compact: bool = False) -> int:
    """Append all rows or, if the job fails, none; returns how many. An action.

    Rows stay in the task that made them unless ``compact`` asks for fewer files
    at the price of a shuffle.
    """
    return _write(df, path, "append", compact)


def overwrite_batches(df: DataFrame, path: str, compact: bool = False) -> int:
    """Replace the batches that ``df`` holds and leave the others alone. An action."""
    return _write(df, path, "overwrite", compact)


def empty_batch(spark: SparkSession, path: str, schema: T.StructType, batch_id: str) -> int:
    """Remove the rows of one batch, which a dynamic overwrite cannot do. An action.

    Every folder of the batch is overwritten with no rows; returns how many went.
    """
    posts = read_posts(spark, path, schema).where(F.col("batch_id") == batch_id)
    # The file path is an escaped URI; url_decode would read a plus sign as a space.
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    folder = F.regexp_replace(file, "/[^/]+$", "")
    folders = posts.groupBy(folder.alias("folder")).agg(F.count("*").alias("rows")).collect()
    kept = T.StructType([f for f in schema.fields if f.name != "batch_id"])
    for row in folders:
        spark.createDataFrame([], kept).write.mode("overwrite").parquet(row.folder)
    return sum(row.rows for row in folders)


def empty_table(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Remove all rows of a table, whatever its batches; returns how many. An action."""
    gone = read_posts(spark, path, schema).count()
    (
        spark.createDataFrame([], schema)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("batch_id")
        .parquet(path)
    )
    return gone


def export_csv(df: DataFrame, path: str) -> None:
    """Write a table as CSV with a header; nested columns as JSON. An action."""
    flat = [
        F.to_json(f.name).alias(f.name)
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
        else F.col(f.name)
        for f in df.schema.fields
    ]
    (
        df.select(*flat)
        .write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
