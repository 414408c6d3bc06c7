"""Existence flags: is the key of this row on that list?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.cleaning import reconcile_key
from riskmart.operators.dedupe import key_set
from riskmart.operators.joins import BROADCAST_ROWS, lookup_join


def membership_flag(
    fact: DataFrame,
    listed: DataFrame,
    fact_key: str,
    list_key: str,
    flag: str,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``flag`` is true where the reconciled fact key is on the list; false otherwise and for null.

    The list is reduced to its distinct keys first, so the join never multiplies fact rows; it
    is broadcast if they are few and joined by salted shuffle otherwise.
    """
    keys = key_set(listed, reconcile_key(F.col(list_key)), "_key").withColumn("_hit", F.lit(True))
    keyed = fact.withColumn("_key", reconcile_key(F.col(fact_key)))
    joined = lookup_join(keyed, keys, ["_key"], "left", broadcast_rows)
    return joined.withColumn(flag, F.coalesce("_hit", F.lit(False))).drop("_key", "_hit")
