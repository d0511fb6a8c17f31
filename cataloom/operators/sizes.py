"""Size checks before a broadcast."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a few numbers each: at most some tens of megabytes.
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(ids: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows of ids, to be broadcast if a count finds few enough, else left to a shuffle join.

    The planner only knows the size of the table before its filter, so for the ids of a
    few labels out of a large dimension it would shuffle the whole bridge.
    """
    limit = BROADCAST_ROWS if limit is None else limit
    found = ids.limit(limit + 1).count()
    return F.broadcast(ids) if found <= limit else ids
