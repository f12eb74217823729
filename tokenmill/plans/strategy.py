"""Physical-plan helpers: size-checked broadcasts."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from ..validation import require

# A parameter table (vocabulary, merge table) is shipped to the executors up
# to this many bytes.
SHIPPED_BYTES = 256 << 20


def ship(spark: SparkSession, value: object, n_bytes: int, what: str) -> Broadcast:
    """Broadcast a driver-side parameter table whose size is known."""
    require(n_bytes <= SHIPPED_BYTES, f"{what} takes {n_bytes} bytes; at most {SHIPPED_BYTES} are shipped")
    return spark.sparkContext.broadcast(value)


def collect_checked(df: DataFrame, what: str) -> list:
    """Rows of a parameter-sized table; an error if they are too many to ship."""
    limit = SHIPPED_BYTES // 64
    rows = df.limit(limit + 1).collect()
    require(len(rows) <= limit, f"{what} has more than {limit} rows")
    return rows


def text_bytes(texts: Iterable[str]) -> int:
    return sum(64 + 4 * len(t) for t in texts)
