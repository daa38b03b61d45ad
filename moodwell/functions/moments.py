"""Moments as the stored tables hold them."""

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(at: datetime) -> Column:
    """A fixed moment without a zone: aware values in UTC, others as they stand.

    Written as text, since a plain literal would shift with the session's zone.
    """
    if at.tzinfo is not None:
        at = at.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
