"""Roll-ups that can be merged: sums, distinct counts and quantiles kept as small states.

A roll-up holds one row per key (a period and some groups). Sums and counts are exact; a distinct
count is a theta sketch, a quantile a KLL sketch. States of any periods and groups merge into
those of their union, so a question about a year reads its months' states, never the facts, and a
late row costs a refresh of its own period only.

Errors, which the sizes set whatever the number of rows: up to ``2 ** lg_entries`` distinct values
are counted exactly, beyond them the standard error is ``1 / sqrt(2 ** lg_entries)``; a quantile's
rank is off by ``rank_error`` of the rows at most in 99 of 100 cases, 0.7% with the default ``k``.

Where a count has to be exact whatever its size, ``members`` keep the distinct values themselves, as
rows in folders of their period: they are refreshed like states, and grow with the values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.session import tidy_shuffles

ROWS = "row_count"
#: Files of a period's members.
MEMBER_FILES = 4


@dataclass(frozen=True)
class Rollup:
    """``sums``, ``distinct`` and ``quantiles`` map the name of a state to the column it is taken of.

    The first key is the period that states are refreshed by, and a folder each. Null measures are
    skipped, as in the aggregates that the states stand for; null keys are groups of their own.
    """

    keys: Sequence[str]
    sums: Mapping[str, str] = field(default_factory=dict)
    distinct: Mapping[str, str] = field(default_factory=dict)
    quantiles: Mapping[str, str] = field(default_factory=dict)
    members: Mapping[str, str] = field(default_factory=dict)
    lg_entries: int = 12
    k: int = 400

    def __post_init__(self) -> None:
        names = [*self.keys, ROWS, *self.sums, *self.distinct, *self.quantiles, *self.members]
        if len(set(names)) < len(names):
            raise ValueError(f"names clash: {names}")

    @property
    def distinct_error(self) -> float:
        """Relative standard error of a distinct count."""
        return 2 ** (-self.lg_entries / 2)

    @property
    def rank_error(self) -> float:
        """Error of a quantile's rank, as a part of the rows, that 99 of 100 stay below: published KLL fit."""
        return 2.296 / self.k**0.9723

    def states(self, df: DataFrame) -> DataFrame:
        """One row of states per key; sketches are begun on the map side, rows are not shuffled."""
        return df.groupBy(*self.keys).agg(
            F.count("*").alias(ROWS),
            *[F.sum(c).alias(name) for name, c in self.sums.items()],
            *[F.theta_sketch_agg(c, self.lg_entries).alias(name) for name, c in self.distinct.items()],
            *[F.kll_sketch_agg_double(F.col(c).cast("double"), self.k).alias(name) for name, c in self.quantiles.items()],
        )

    def merge(self, states: DataFrame, *by: str | Column) -> DataFrame:
        """States of coarser groups; they can be merged again."""
        return states.groupBy(*by).agg(
            F.coalesce(F.sum(ROWS), F.lit(0).cast("bigint")).alias(ROWS),
            *[F.sum(name).alias(name) for name in self.sums],
            *[F.theta_union_agg(name, self.lg_entries).alias(name) for name in self.distinct],
            *[F.kll_merge_agg_double(name, self.k).alias(name) for name in self.quantiles],
        )

    def read(self, states: DataFrame, quantiles: Mapping[str, tuple[str, float]] | None = None) -> DataFrame:
        """Sums, counts and ``{result: (state, p)}`` in place of the sketches; a quantile of no values is null."""
        asked = [quantile(state, p).alias(alias) for alias, (state, p) in (quantiles or {}).items()]
        sketches = {*self.distinct, *self.quantiles}
        counts = [F.theta_sketch_estimate(name).alias(name) for name in self.distinct]
        return states.select(*[c for c in states.columns if c not in sketches], *counts, *asked)

    def refresh(self, df: DataFrame, path: str) -> None:
        """Write the states of the periods in ``df``, all of whose rows it holds; others stay as they are.

        A period that is written again has the same states, so a refresh that failed is repeated. One
        task writes a period: its states are as many as its groups, however many rows it has.
        """
        period = self.keys[0]
        with tidy_shuffles(df.sparkSession):
            _replace(self.states(df).repartition(period), period, path)
        for name, c in self.members.items():
            # A period's values are dealt over several tasks, by hash; equal ones meet there. A null stays
            # as a row that is not counted, so a period whose values are gone is replaced too.
            rows = df.select(*self.keys, F.col(c).alias(name))
            part = F.pmod(F.xxhash64(name), F.lit(MEMBER_FILES)).alias("_part")
            once = rows.select("*", part).repartition(period, "_part").dropDuplicates([*self.keys, name, "_part"])
            with tidy_shuffles(df.sparkSession):
                _replace(once.drop("_part"), period, _members_path(path, name))


def _replace(df: DataFrame, period: str, path: str) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(period).parquet(path, compression="zstd")


def quantile(state: str | Column, p: float) -> Column:
    state = F.col(state) if isinstance(state, str) else state
    found = F.kll_sketch_get_n_double(state) > 0
    return F.when(found, F.kll_sketch_get_quantile_double(state, F.lit(p)))


def in_both(left: str | Column, right: str | Column) -> Column:
    """Estimated number of values that two distinct states share; a missing state shares none."""
    return F.coalesce(F.theta_sketch_estimate(F.theta_intersection(left, right)), F.lit(0).cast("bigint"))


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """States as ``refresh`` wrote them; a filter on the period lists only its folders."""
    return spark.read.parquet(path)


def _members_path(path: str, name: str) -> str:
    return f"{path.rstrip('/')}_members/{name}"


def read_members(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One row per key and distinct value, as ``refresh`` wrote them beside the states of ``path``."""
    return spark.read.parquet(_members_path(path, name))


def members_kept(members: DataFrame, period: str, by: Sequence[str], name: str, before: Column, kept: str) -> DataFrame:
    """Members per period and group as ``{name}``, and how many of them the next period has too as ``kept``."""
    later = members.select(before.alias("_period"), *[F.col(c).alias(f"_{c}") for c in by], F.col(name).alias("_member"))
    same = (F.col(period) == F.col("_period")) & (F.col(name) == F.col("_member"))
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    paired = members.join(later, same, "left")
    return paired.groupBy(period, *by).agg(F.count(name).alias(name), F.count("_member").alias(kept))


def beside_next(states: DataFrame, period: str, by: Sequence[str], before: Column, name: str) -> DataFrame:
    """States with the state ``name`` of the next period as ``{name}_next``, null where there is none.

    ``before`` is the period before a row's own; the ``by`` groups may be null.
    """
    later = states.select(before.alias("_period"), *[F.col(c).alias(f"_{c}") for c in by], F.col(name).alias(f"{name}_next"))
    same = F.col(period) == F.col("_period")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return states.join(later, same, "left").drop("_period", *[f"_{c}" for c in by])
