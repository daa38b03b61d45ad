"""Keys of posts: whole numbers without gaps, unique in a table by construction.

A batch first reserves a range of keys, then its posts take them in order of their ids in the
source. Ranges stand in a table of their own beside the posts; one ingestion at a time may add to
a table. A run that is repeated with the same posts finds its range again and gives the same keys.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwell.session import work_folder

#: Characters of a text by which ranges are told apart.
HEAD = 16
RANGES = "batch_id string, checksum long, first long, posts long"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, computed once. An action."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, *order: str, name: str = "number") -> DataFrame:
    """Add numbers from 0 without gaps, in the order of some columns. Runs jobs at once.

    Each task sorts a range of the rows and counts it; the counts of the ranges before, a number
    for each task, are what its own numbers begin with. Rows that tie may take each other's number.
    """
    # Spark finds the ranges from rows that it sends to the driver, hundreds for each task. Of a
    # text its beginning is enough: texts are in the order of their beginnings, or tie there.
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    bounds = [F.left(F.col(c), F.lit(HEAD)) if c in texts else F.col(c) for c in order]
    ranged = df.repartitionByRange(*bounds).sortWithinPartitions(*order)
    # Holds the task in the upper bits and the row below; written, it stays.
    placed = stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33).alias("_part")
    counts = sorted(placed.groupBy(part).agg(F.count("*").alias("rows")).collect())
    firsts, total = [], 0
    for r in counts:
        firsts.append((r._part, total))
        total += r.rows
    before = df.sparkSession.createDataFrame(firsts, "_part long, _first long")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("_part", part).join(F.broadcast(before), "_part").select(
        *df.columns, (F.col("_first") + inside).alias(name)
    )


def reserve_keys(
    spark: SparkSession, raw_path: str, batch_id: str, checksum: int, posts: int
) -> int:
    """The first key of a range for a batch: the one it has for the same posts, or a new one. An action."""
    path = raw_path.rstrip("/") + "_keys"
    spark.createDataFrame([], RANGES).write.mode("append").parquet(path)
    ranges = spark.read.schema(RANGES).parquet(path)
    same = (F.col("batch_id") == batch_id) & (F.col("checksum") == checksum) & (F.col("posts") == posts)
    held = ranges.agg(
        F.min(F.when(same, F.col("first"))).alias("first"), F.max(F.col("first") + F.col("posts")).alias("end")
    ).first()
    if held.first is not None:
        return held.first
    end = held.end
    if end is None:  # a table whose posts came without ranges
        end = 1 + (spark.read.schema("id long").parquet(raw_path).agg(F.max("id")).first()[0] or 0)
    row = [(batch_id, checksum, end, posts)]
    spark.createDataFrame(row, RANGES).coalesce(1).write.mode("append").parquet(path)
    return end


def keyed_posts(posts: DataFrame, raw_path: str, batch_id: str) -> tuple[DataFrame, int]:
    """Posts with their ids in the source replaced by keys, less those that the table has already,
    and how many posts there are in all. Runs jobs at once."""
    spark = posts.sparkSession
    posts = stored(posts, "posts")
    sums = posts.agg(F.count("*").alias("posts"), F.expr("bit_xor(xxhash64(id, raw_text))").alias("checksum")).first()
    if not sums.posts:
        return posts, 0
    first = reserve_keys(spark, raw_path, batch_id, sums.checksum, sums.posts)
    keyed = numbered(posts, "id", "raw_text", name="_key").withColumn("id", F.col("_key") + first).drop("_key")
    # The keys of one batch lie together, so that their range prunes the scan.
    own = F.col("id").between(first, first + sums.posts - 1)
    there = spark.read.schema("id long").parquet(raw_path).where(own)
    return keyed.join(there, "id", "left_anti").select(*posts.columns), sums.posts
