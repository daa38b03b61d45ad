"""Session settings and the folder for tables that a job writes on its way."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "moodwell") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one that ``spark.checkpoint.dir`` names.

    Only a local session, whose executors see the same disk, may fall back to a
    temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="moodwell-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
