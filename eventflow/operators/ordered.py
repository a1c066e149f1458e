"""Ordered windows that survive a hot group.

A plain window sends each group to one task. Here a group is cut into slots of the first order column,
such as the hours of a day, without looking at the data first: rows are shuffled once, by group and slot;
every slot is scanned on its own; and one row per slot carries over what lies before it (or behind it),
found by a window over the group's slots. These rows come from a second read of only the columns they
need, combined on the map side. Nothing runs while a query is built.

The first order column is a timestamp, and `slot` a number of seconds, or it is a number, and `slot` is in
its unit. `slot=None` asks for the plain window, for groups known to be small. Copies of one row fall into
one slot; callers collapse copies (counts per value) before they scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

MINUTE, HOUR, DAY = 60, 3_600, 86_400

_GROUP = "__group"
_BEFORE = (Window.unboundedPreceding, -1)


def _slot(df: DataFrame, column: str, width: float) -> Column:
    """Number of the slot a row falls into; null order values come first, in a slot of their own."""
    kind = df.schema[column].dataType.simpleString()
    value = F.unix_micros(F.col(column).cast("timestamp")) if kind.startswith("timestamp") else F.col(column)
    scale = 1_000_000 if kind.startswith("timestamp") else 1
    return F.coalesce(F.floor(value / F.lit(width * scale)).cast("bigint"), F.lit(-(2**63)).cast("bigint"))


def in_slots(df: DataFrame, keys: Sequence[str], order: Sequence[str], slot: float) -> DataFrame:
    """Rows with their group and slot, in one struct, so that null keys are equal to each other."""
    group = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], _slot(df, order[0], slot).alias("slot"))
    return df.withColumn(_GROUP, group)


def _window(parts: Sequence[str], order: Sequence[str], reverse: bool) -> WindowSpec:
    return Window.partitionBy(*parts).orderBy(*[F.col(c).desc() if reverse else F.col(c).asc() for c in order])


def _at(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])


def _carried(
    placed: DataFrame, keys: Sequence[str], state: Column, carry: Callable[[WindowSpec, WindowSpec], dict[str, Column]],
    reverse: bool = False, every: bool = False,
) -> DataFrame:
    """What `carry` makes of the states of a group's other slots, one row per slot.

    `carry` gets the window over all earlier slots (later ones when reversed) and that over all slots.
    Slots with none before them have nothing to carry and no row, unless `every` slot is wanted.
    """
    group = [F.col(f"{_GROUP}.k{i}") for i in range(len(keys))]
    at = F.col(f"{_GROUP}.slot")
    whole = Window.partitionBy(F.struct(*group, F.lit(0).alias("all")))
    before = whole.orderBy(at.desc() if reverse else at.asc()).rowsBetween(*_BEFORE)
    per_slot = placed.groupBy(_GROUP).agg(state.alias("__state"))
    carried = per_slot.withColumns(carry(before, whole) | {"__earlier": F.count(F.lit(1)).over(before)})
    if not every:
        carried = carried.filter("__earlier > 0")
    return carried.drop("__earlier").withColumnRenamed(_GROUP, "__of").drop("__state")


def _joined(local: DataFrame, carried: DataFrame) -> DataFrame:
    return local.join(carried, F.col(_GROUP) == F.col("__of"), "left").drop("__of")


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, Column],
    slot: float | None = None, totals: dict[str, str] | None = None,
) -> DataFrame:
    """Inclusive running sums, nulls counting as 0. Rows that tie on the order columns get rising sums.

    `totals` names further columns for the sum over the whole group: new name -> name in `sums`.
    """
    totals, zero = totals or {}, F.lit(0)
    if slot is None:
        window = _window(keys, order, False).rowsBetween(Window.unboundedPreceding, 0)
        whole = Window.partitionBy(*keys)
        return df.withColumns(
            {name: F.coalesce(F.sum(value).over(window), zero) for name, value in sums.items()}
            | {name: F.coalesce(F.sum(sums[of]).over(whole), zero) for name, of in totals.items()}
        )
    placed = in_slots(df, keys, order, slot)
    window = _window([_GROUP], order, False).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns({name: F.coalesce(F.sum(value).over(window), zero) for name, value in sums.items()})
    state = F.struct(*[F.coalesce(F.sum(v), zero).alias(n) for n, v in sums.items()])
    carried = _carried(placed, keys, state, lambda before, whole: {
        "__carry": F.struct(*[F.coalesce(F.sum(F.col("__state")[n]).over(before), zero).alias(n) for n in sums]),
        **{f"__total_{n}": F.sum(F.col("__state")[of]).over(whole) for n, of in totals.items()},
    }, every=bool(totals))
    return _joined(local, carried).withColumns(
        {n: F.col(n) + F.coalesce(F.col("__carry")[n], zero) for n in sums} | {n: F.col(f"__total_{n}") for n in totals}
    ).drop(_GROUP, "__carry", *[f"__total_{n}" for n in totals])


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, slot: float = DAY
) -> DataFrame:
    """1-based position of each row in its group."""
    return running_sum(df, keys, order, {name: F.lit(1).cast("bigint")}, slot)


def previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, str], slot: float = DAY
) -> DataFrame:
    """Values of the row before: `columns` maps new names to source columns."""
    placed = in_slots(df, keys, order, slot)
    values = F.struct(*[F.col(src).alias(new) for new, src in columns.items()])
    local = placed.withColumn("__prev", F.lag(values).over(_window([_GROUP], order, False)))
    carried = _carried(placed, keys, F.max_by(values, _at(order)), lambda before, _: {"__carry": F.last("__state").over(before)})
    return _joined(local, carried).withColumns(
        {new: F.coalesce("__prev", "__carry")[new] for new in columns}
    ).drop("__prev", "__carry", _GROUP)


def next_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str, slot: float | None
) -> DataFrame:
    """First non-null `value` at or after each row: the forward as-of lookup."""
    asked = df.withColumn("__value", value)
    if slot is None:
        window = _window(keys, order, True).rowsBetween(Window.unboundedPreceding, 0)
        return asked.withColumn(name, F.last("__value", ignorenulls=True).over(window)).drop("__value")
    placed = in_slots(asked, keys, order, slot)
    window = _window([_GROUP], order, True).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumn(name, F.last("__value", ignorenulls=True).over(window))
    first = F.min_by("__value", F.when(F.col("__value").isNotNull(), _at(order)))
    carried = _carried(
        placed, keys, first, lambda before, _: {"__carry": F.last("__state", ignorenulls=True).over(before)}, reverse=True
    )
    return _joined(local, carried).withColumn(name, F.coalesce(name, "__carry")).drop("__value", "__carry", _GROUP)


def running_state(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str,
    local: Callable[[DataFrame, WindowSpec], DataFrame], reverse: bool = False,
) -> DataFrame:
    """Running value of any state, in column `name`, within groups that are slots already."""
    return local(df, _window(keys, order, reverse).rowsBetween(Window.unboundedPreceding, 0))
