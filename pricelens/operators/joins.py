"""Join with a lookup table whose key may be very unevenly used."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import planned_bytes

# A larger lookup is repeated this often, so one hot key becomes this many keys.
SALTS = 32


def broadcast_limit(df: DataFrame) -> int:
    """Bytes up to which the session's planner broadcasts a table."""
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Join ``df`` with one or few rows per key, whatever share of ``df`` a key has.

    ``lookup`` should be a written table, whose bytes the planner knows: one within
    its broadcast limit needs nothing but the join. A larger one is joined on the key
    and a salt: the rows of a hot key spread over ``SALTS`` tasks, each with its own
    copy of the lookup row. ``how`` is inner, left, left_semi or left_anti.
    """
    limit = broadcast_limit(df) if broadcast_bytes is None else broadcast_bytes
    if planned_bytes(lookup) <= limit:
        return df.join(lookup, on, how)
    salted = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    copies = lookup.withColumn(
        "_salt", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(SALTS)]))
    )
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
