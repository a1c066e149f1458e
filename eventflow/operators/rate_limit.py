"""At most one alert per key and interval, greedily: the next alert is allowed once the interval has
passed since the last one that was let through.

Which alert passes depends on all the ones before it, so no window function gives it. A key's times are cut
into slots of some intervals. What a slot does to the last alert let through before it is a short list of
steps (`greedy`); one pass over these lists, in the order of the slots, gives each slot the one time that is
carried into it, and then every slot is scanned on its own. One way for keys of any size, linear in the alerts,
and nothing runs while the query is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eventflow.operators import greedy

#: Intervals in a slot.
SLOT_WIDTHS = 64


def rate_limit(
    alerts: DataFrame, key: str, time: str, interval_seconds: int, slot_widths: int = SLOT_WIDTHS, chunk: int = greedy.CHUNK,
) -> DataFrame:
    """Alert times that pass, as (key, time). Alerts at the same time count as one, those without a time as none;
    a null key is a key of its own."""
    width = interval_seconds * 1_000_000
    slot = F.floor(F.col("t") / F.lit(slot_widths * width)).cast("bigint")
    times = alerts.select(F.col(key), F.unix_micros(time).alias("t")).filter("t IS NOT NULL").distinct().withColumn("slot", slot)
    kind = T.StructField(key, alerts.schema[key].dataType)
    long, longs = T.LongType(), T.ArrayType(T.LongType())

    def schema(**fields: T.DataType) -> T.StructType:
        return T.StructType([kind, *[T.StructField(n, t) for n, t in fields.items()]])

    listed, carry, out = schema(slot=long, chunk=long, tops=longs, exits=longs), schema(slot=long, t=long), schema(t=long)
    arrow = to_arrow_schema
    slots = times.repartition(key, "slot").sortWithinPartitions(key, "slot", "t").mapInArrow(
        greedy.summaries(key, width, arrow(listed), chunk), listed)
    carried = slots.repartition(key).sortWithinPartitions(key, "slot", "chunk").mapInArrow(greedy.carries(key, width, arrow(carry)), carry)
    both = times.withColumn("kind", F.lit(1)).unionByName(carried.withColumn("kind", F.lit(0)))
    passed = both.repartition(key, "slot").sortWithinPartitions(key, "slot", "kind", "t").mapInArrow(
        greedy.passing(key, width, arrow(out)), out)
    return passed.select(key, F.timestamp_micros("t").alias(time))


def rate_limit_tumbling(alerts: DataFrame, key: str, time: str, interval: str) -> DataFrame:
    """Cheaper variant: the first alert of each fixed interval. Two may be closer than the interval."""
    first = alerts.groupBy(key, F.window(time, interval)).agg(F.min(time).alias(time))
    return first.select(key, time)
