"""Sources of comments: CSV files and database tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwell.schemas import COMMENTS
from moodwell.sources.records import read_records


def read_comments_csv(
    spark: SparkSession, path: str, schema: T.StructType = COMMENTS
) -> DataFrame:
    """CSV with a header; quoted fields may hold commas, doubled quotes and line breaks.

    A large file is read by many tasks; see ``records``.
    """
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    read = F.from_csv("record", schema.simpleString(), options)
    return read_records(spark, path).select(read.alias("row")).select("row.*")


def read_comments_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    options: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
) -> DataFrame:
    """A database table. Filters, columns and limits are passed on to the database.

    With a numeric column and its bounds, that many tasks read in parallel.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.options(**(options or {})).load()
