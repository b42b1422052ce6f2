"""Distinct customers over any span, from sketches kept per merchant-day.

Exact distinct counts do not add up: a customer of two days counts once in their week. A HyperLogLog
sketch does: sketches of days are united into that of a week without reading a transaction. The
exact count of the day stands beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of the sketch's registers: 4,096 of them, some two kilobytes a group.
LG_REGISTERS = 12

#: Share by which an estimate may miss: three standard errors of so many registers.
MAX_ERROR = 0.05


def daily_customers(stg_tx: DataFrame) -> DataFrame:
    """merchant_id, event_date, unique_customers, sketch."""
    return stg_tx.groupBy("merchant_id", "event_date").agg(
        F.count_distinct("customer_id").alias("unique_customers"),
        F.hll_sketch_agg("customer_id", F.lit(LG_REGISTERS)).alias("sketch"),
    )


def rollup_customers(daily: DataFrame, **keys: Column) -> DataFrame:
    """Estimated distinct customers of the days united under `keys`."""
    groups = [column.alias(name) for name, column in keys.items()]
    united = daily.groupBy(*groups).agg(F.hll_union_agg("sketch").alias("sketch"))
    return united.select(*keys, F.hll_sketch_estimate("sketch").alias("customers_estimate"))


def within_error(estimate: Column, exact: Column) -> Column:
    """Whether an estimate is as near as the sketch promises; small counts are nearly exact."""
    return F.abs(estimate - exact) <= F.greatest(exact * MAX_ERROR, F.lit(1.0))
