"""Order-dependent operators without a single-task window.

A global rank needs the total order of the values: these are reduced to distinct ones and
range-partitioned, and each range's position is found from the small table of range sizes.
An exact quantile needs the values around one rank only: these are selected between bounds
that a sketch gives. There is one path each, whatever the size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orebed.session import durable


def dense_rank_all(df: DataFrame, value: str, rank: str = "rank") -> DataFrame:
    """Dense rank of every row by ``value``, highest first."""
    df = durable(df)
    position = F.monotonically_increasing_id()
    values = durable(
        df.select(value)
        .distinct()
        .repartitionByRange(F.col(value).desc())
        .sortWithinPartitions(F.col(value).desc())
        .withColumn("_position", position)
    ).select(
        value,
        F.shiftright("_position", 33).alias("_part"),
        F.col("_position").bitwiseAND(F.lit((1 << 33) - 1)).alias("_offset"),
    )
    # One row per range: as many as there are shuffle partitions.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        values.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    ranked = values.join(F.broadcast(starts), "_part").select(
        F.col(value).alias("_value"), (F.col("_start") + F.col("_offset") + 1).cast("int").alias(rank)
    )
    return df.join(ranked, F.col(value).eqNullSafe(F.col("_value"))).drop("_value")


def top_by_rank(df: DataFrame, value: str, tie: str, n: int, rank: str = "rank") -> DataFrame:
    """The n highest rows with their dense rank, in (rank, tie) order.

    The limit runs first as a distributed top-k. Everything above a kept row is
    kept too, so ranking the n rows alone gives their global rank.
    """
    top = df.orderBy(F.col(value).desc(), F.col(tie)).limit(n)
    return top.withColumn(rank, F.dense_rank().over(Window.orderBy(F.col(value).desc())))


def exact_percentiles(
    df: DataFrame,
    groups: Sequence[str],
    metrics: Mapping[str, tuple[str, float]],
    accuracy: int = 10_000,
    discrete: bool = False,
) -> DataFrame:
    """Exact interpolated percentiles per group, by selection: ``{alias: (column, p)}``.

    ``discrete`` takes an existing value, the first that p of the rows reach, in its own type.

    A first pass keeps a sketch per group and brackets every wanted rank between two values
    about 8 / accuracy of the rows apart. A second pass counts what lies below a bracket and
    keeps the values inside it, as counts of distinct ones; the wanted ranks are found among these.
    Neither pass shuffles the values outside, whatever a group's size, and the sketches'
    errors cannot reach the result: ranks come from counts, and one outside its bracket is an
    error. ``df`` is read twice. Values keep their type: there is one value column per
    type, of which a row fills one; a column must be readable as a double.
    """
    types = [df.schema[c].dataType.simpleString() for c, _ in metrics.values()]
    kinds = list(dict.fromkeys(types))
    values = [f"_value{i}" for i in range(len(kinds))]
    reach = 4 / accuracy
    # As SQL text: a plan of many small expressions is built in a fraction of the time.
    brackets = [
        f"struct(count(`{c}`) AS total, percentile_approx(CAST(`{c}` AS DOUBLE), "
        f"array({max(0.0, p - reach)!r}D, {min(1.0, p + reach)!r}D), {accuracy}) AS ends) AS _m{i}"
        for i, (c, p) in enumerate(metrics.values())
    ]
    names = [F.col(g).alias(f"_group{i}") for i, g in enumerate(groups)]
    # One row per group, written: joined as a broadcast or not by its true size.
    found = durable(df.groupBy(*names).agg(*map(F.expr, brackets)))
    same = " AND ".join([f"`{g}` <=> _group{i}" for i, g in enumerate(groups)]) or "true"

    def placed(i: int, column: str) -> str:
        """Side of the bracket (-1 below, 0 inside, 1 above, 2 NULL), and the value."""
        near = f"CAST(`{column}` AS DOUBLE)"
        side = f"CASE WHEN {near} IS NULL THEN 2 WHEN {near} < _m{i}.ends[0] THEN -1 WHEN {near} > _m{i}.ends[1] THEN 1 ELSE 0 END"
        pairs = zip(kinds, values, strict=True)
        own = [f"CAST({f'`{column}`' if types[i] == kind else 'NULL'} AS {kind}) AS {value}" for kind, value in pairs]
        return f"struct({i} AS _metric, {side} AS _side, _m{i}.total AS _total, {', '.join(own)})"

    each = ", ".join(placed(i, c) for i, (c, _) in enumerate(metrics.values()))
    keys = [*groups, "_metric"]
    inside = [F.expr(f"CASE WHEN _side = 0 THEN {v} END AS {v}_in") for v in values]
    # Of the rows below a bracket the nearest one counts, and of those above.
    nearest = [F.expr(f"CASE WHEN _side = -1 THEN max({v}) ELSE min({v}) END AS {v}") for v in values]
    counts = (
        df.join(found, F.expr(same))
        .select(*groups, F.expr(f"inline(array({each}))"))
        .groupBy(*keys, "_side", *inside)
        .agg(F.expr("count(*) AS _n"), F.expr("max(_total) AS _total"), *nearest)
    )
    running = Window.partitionBy(*keys).orderBy("_side", *values)
    rows = counts.select(*keys, "_side", "_total", *values, "_n", F.sum("_n").over(running).alias("_sum"))
    # Ranks that a row covers: one below and one above the bracket, as many as are equal inside it.
    first = "CASE _side WHEN -1 THEN _sum - 1 ELSE _sum - _n END"
    last = "CASE _side WHEN 1 THEN _sum - _n ELSE _sum - 1 END"
    number = f"coalesce({', '.join(f'CAST({v} AS DOUBLE)' for v in values)})"
    wanted, results = [], []
    for i, (alias, (_, p)) in enumerate(metrics.items()):
        own, position = f"_metric = {i} AND _side <> 2", f"({p!r}D * (_total - 1))"
        if discrete:
            # As a decimal: 0.9 of a count is no rank too high by the error of a double.
            rank, value = f"greatest(ceil({p!r}BD * _total) - 1, 0)", values[kinds.index(types[i])]
            wanted.append(f"max(CASE WHEN {own} AND {rank} BETWEEN {first} AND {last} THEN {value} END) AS _low{i}")
            wanted.append(f"max(CASE WHEN {own} THEN _total END) AS _at{i}")
            lost = f"CAST(raise_error('a rank is outside its bracket: raise the accuracy') AS {types[i]})"
            results.append(F.expr(f"CASE WHEN _at{i} IS NOT NULL AND _low{i} IS NULL THEN {lost} ELSE _low{i} END").alias(alias))
            continue
        for end, rank in (("low", f"floor({position})"), ("high", f"ceil({position})")):
            wanted.append(f"max(CASE WHEN {own} AND {rank} BETWEEN {first} AND {last} THEN {number} END) AS _{end}{i}")
        wanted.append(f"max(CASE WHEN {own} THEN {position} END) AS _at{i}")
        low, high, weight = f"_low{i}", f"_high{i}", f"(_at{i} - floor(_at{i}))"
        # A value met exactly is taken as it is, so that infinite ones stay.
        results.append(
            F.expr(
                f"CASE WHEN _at{i} IS NOT NULL AND ({low} IS NULL OR {high} IS NULL)"
                " THEN CAST(raise_error('a rank is outside its bracket: raise the accuracy') AS DOUBLE)"
                f" WHEN {weight} = 0 THEN {low} ELSE {low} * (1 - {weight}) + {high} * {weight} END"
            ).alias(alias)
        )
    return rows.groupBy(*groups).agg(*map(F.expr, wanted)).select(*groups, *results)


def approximate_percentiles(
    df: DataFrame,
    groups: Sequence[str],
    metrics: Mapping[str, tuple[str, float]],
    accuracy: int = 10_000,
) -> DataFrame:
    """Discrete percentiles from mergeable sketches: an existing value, rank error 1/accuracy."""
    return df.groupBy(*groups).agg(
        *[
            F.percentile_approx(c, p, accuracy).alias(alias)
            for alias, (c, p) in metrics.items()
        ]
    )


def moving_average(
    df: DataFrame,
    date: str,
    value: str,
    result: str,
    rows: int | None = None,
    days: int | None = None,
    partition: Sequence[str] = (),
) -> DataFrame:
    """Mean over the last ``rows`` rows or ``days`` calendar days.

    Meant for daily roll-ups: one row per day (and partition), so a window holds
    as many rows as the calendar has days.
    """
    window = Window.partitionBy(*partition).orderBy(date)
    if rows is not None:
        window = window.rowsBetween(1 - rows, 0)
    elif days is not None:
        day = F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
        window = Window.partitionBy(*partition).orderBy(day).rangeBetween(1 - days, 0)
    else:
        raise ValueError("give rows or days")
    mean = F.sum(value).over(window).cast("double") / F.count(value).over(window)
    return df.withColumn(result, mean)
