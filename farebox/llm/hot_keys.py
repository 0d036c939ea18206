"""Joining a value to every row by a key of which a few may be most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import free_name, stored

MOST_HOT = 1000


def with_value(rows: DataFrame, key: Column, values: DataFrame) -> DataFrame:
    """``rows`` with the column ``value`` of the row of ``values`` (key, copies, value) that has
    their key, or NULL; NULL keys are alike. ``copies`` is how many of ``rows`` have the key.

    Keys with a thousandth of all rows or more, of which there are at most a thousand, are
    broadcast, so that their rows stay where they are; the rows of all other keys are shuffled.
    """
    values = stored(values, "values")
    total = values.agg(F.sum("copies")).head()[0] or 0
    is_hot = F.col("copies") * MOST_HOT >= F.lit(total)
    join_key, hot_value, value = (free_name(rows, name) for name in ("join_key", "hot_value", "value"))
    keyed = rows.withColumn(join_key, key)
    hot = values.where(is_hot).select(F.col("key").alias(join_key), F.struct("value").alias(hot_value))
    cold = values.where(~is_hot).select(F.col("key").alias(join_key), F.col("value").alias(value))
    found = keyed.alias("k").join(
        F.broadcast(hot).alias("h"), F.col(f"k.{join_key}").eqNullSafe(F.col(f"h.{join_key}")), "left"
    )
    found = stored(found.select("k.*", hot_value), "hot-joined")
    near = found.where(F.col(hot_value).isNotNull()).withColumn(value, F.col(f"{hot_value}.value"))
    far = found.where(F.col(hot_value).isNull()).alias("f")
    far = far.join(cold.alias("c"), F.col(f"f.{join_key}").eqNullSafe(F.col(f"c.{join_key}")), "left").select(
        "f.*", F.col(f"c.{value}")
    )
    return near.unionByName(far).drop(join_key, hot_value)
