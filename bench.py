"""Times the headline queries; prints one JSON line.

Every query reads its tables from Parquet and materialises all of its rows. The tables
are first copied, untimed, so that each has a file per core, as tables of a size worth
measuring do. The time is the better of two runs, after a first query has started the workers.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from moodwell.plans.registry import QUERIES  # noqa: E402
from moodwell.session import local_session, work_folder  # noqa: E402

TABLES = ["documents", "pages", "conversations", "labels", "events"]

HEADLINE = [
    "clean_batch",
    "clean_rules",
    "clean_stage",
    "emoji_known",
    "hashtags_words",
    "strip_urls",
    "status_breakdown",
    "langid_profile",
    "langid_detect",
    "langid_confusion",
    "score_lexicon",
    "score_model_stub",
    "enrich_stage",
    "search_posts",
    "search_topk",
    "assign_batch",
    "joined_posts",
    "explore_view",
    "unanalyzed_posts",
    "cleaning_stats",
    "emotion_distribution",
    "emotion_percentage",
    "confidence_by_emotion",
    "distinct_counts",
    "cleaned_sink_roundtrip",
    "stream_clean",
]
RUNS = 2


def spread(spark, sf_dir: str, files: int) -> str:
    """A copy of the tables in so many files each."""
    folder = work_folder(spark, "bench")
    for name in TABLES:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        table.repartition(files).write.parquet(f"{folder}/{name}.parquet")
    return folder


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "moodwell-bench")
    spark.sparkContext.setLogLevel("ERROR")
    tables = spread(spark, sf_dir, int(cpus))
    seconds(spark, "emoji_known", tables)
    names = sys.argv[1:] or HEADLINE
    times = {
        name: round(min(seconds(spark, name, tables) for _ in range(RUNS)), 3) for name in names
    }
    result = {
        "metric": "total seconds over headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
