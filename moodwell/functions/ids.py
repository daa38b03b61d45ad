"""Batch identifiers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodwell.functions.chars import strip


# The parts of a batch id that do not come from the keyword.
SEARCH_PREFIX = "frontend-"
EMPTY_SLUG = "batch"


def ingest_batch_id(keyword: Column, suffix: Column) -> Column:
    """``some_keyword-suffix``; the caller picks the suffix, so a rerun gives the same id."""
    return F.concat(F.replace(F.lower(strip(keyword)), F.lit(" "), F.lit("_")), F.lit("-"), suffix)


def search_batch_id(keyword: Column, suffix: Column) -> Column:
    """``frontend-some-keyword-suffix``, with ``batch`` for a keyword without letters or digits."""
    slug = F.regexp_replace(F.lower(keyword), "[^a-z0-9]+", "-")
    slug = F.regexp_replace(slug, "^-+|-+$", "")
    slug = F.when(slug == "", EMPTY_SLUG).otherwise(slug)
    return F.concat(F.lit(SEARCH_PREFIX), slug, F.lit("-"), suffix)

