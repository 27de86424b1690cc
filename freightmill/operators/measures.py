"""Named measures evaluated under a filter context.

A measure is defined once and evaluated for any grouping and any set of filters.
Leaves are counts and sums over one fact, so a whole evaluation is a single pass:
the fact is totalled by its own keys, dimensions are joined to those totals, and
the totals are regrouped and combined by the measures' formulas.

Filter rules:
  * a filter names a column as ``table.column`` and gives a predicate on it;
  * a measure's own filter replaces the context filter on the same column and adds
    to all others;
  * filters on a dimension reach the facts related to it, never the reverse.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightmill.functions.numeric import ratio
from freightmill.operators.prior_period import with_prior_year, with_prior_year_daily

YEAR = "dim_date.year_num"
DAY = "dim_date.full_date"
REPEATS_YEARLY = {"dim_date.month_num", "dim_date.month_name", "dim_date.quarter_num"}

Predicate = Callable[[Column], Column]
Filters = Mapping[str, Predicate]


@dataclass(frozen=True)
class Rows:
    """Number of fact rows."""

    table: str
    where: Filters = field(default_factory=dict)


@dataclass(frozen=True)
class Total:
    """Sum of a fact column."""

    column: str
    where: Filters = field(default_factory=dict)


@dataclass(frozen=True)
class Average:
    """Mean of the non-null values of a fact column."""

    column: str
    where: Filters = field(default_factory=dict)


@dataclass(frozen=True)
class DimensionAverage:
    """Mean over dimension rows, each counted once however many facts point at it."""

    column: str
    divisor: float = 1.0


@dataclass(frozen=True)
class Formula:
    """A combination of other measures."""

    inputs: tuple[str, ...]
    combine: Callable[..., Column]


@dataclass(frozen=True)
class YearOnYear:
    """Growth of an additive measure over the same period one year earlier.

    The grouping must hold ``dim_date.year_num`` (with any columns that repeat every
    year, such as the month) or ``dim_date.full_date``. NULL where the year before
    has nothing.
    """

    base: str


Measure = Rows | Total | Average | DimensionAverage | Formula | YearOnYear


@dataclass(frozen=True)
class Relationship:
    """``dimension`` (one) to ``fact`` (many). ``as_date`` compares calendar days."""

    dimension: str
    dimension_key: str
    fact: str
    fact_key: str
    active: bool = True
    as_date: bool = False


def split_name(name: str) -> tuple[str, str]:
    table, _, column = name.partition(".")
    if not column:
        raise ValueError(f"expected table.column, got {name!r}")
    return table, column


@dataclass(frozen=True)
class Rollup:
    """Stored totals of a fact, to answer from where they are fine enough.

    ``keys`` are fact columns the totals are kept by, under their own names; ``days`` names, for
    a fact column, the key that holds its calendar day. ``rows`` counts fact rows, ``sums`` and
    ``present`` name the total and the number of known values of a fact column.
    """

    fact: str
    table: DataFrame
    keys: frozenset[str]
    rows: str
    sums: Mapping[str, str] = field(default_factory=dict)
    present: Mapping[str, str] = field(default_factory=dict)
    days: Mapping[str, str] = field(default_factory=dict)

    def holds(self, kind: str, column: str | None) -> str | None:
        """The column with a total of the fact, None if it is not kept."""
        if kind == "rows":
            return self.rows
        return (self.sums if kind == "sum" else self.present).get(column)


@dataclass(frozen=True)
class Model:
    tables: Mapping[str, DataFrame]
    relationships: tuple[Relationship, ...]
    measures: Mapping[str, Measure]
    # Dimensions under row-level security: joined in even when nobody asks for them.
    secured: frozenset[str] = frozenset()
    # (dimension, fact column) pairs to use instead of the active relationship.
    roles: Mapping[str, str] = field(default_factory=dict)
    # Stored totals, the ones to be preferred first.
    rollups: tuple[Rollup, ...] = ()

    def with_rollup(self, rollup: Rollup) -> "Model":
        """Answer from ``rollup`` where it covers what is asked, else as before."""
        return replace(self, rollups=(*self.rollups, rollup))

    def use_relationship(self, dimension: str, fact_key: str) -> "Model":
        return replace(self, roles={**self.roles, dimension: fact_key})

    def restrict(self, dimension: str, allowed: DataFrame) -> "Model":
        """Row-level security: only ``allowed`` rows of the dimension exist."""
        return replace(
            self,
            tables={**self.tables, dimension: allowed},
            secured=self.secured | {dimension},
        )

    def path(self, dimension: str, fact: str) -> Relationship | None:
        wanted = self.roles.get(dimension)
        for r in self.relationships:
            if (r.dimension, r.fact) != (dimension, fact):
                continue
            if (r.fact_key == wanted) if wanted else r.active:
                return r
        return None


# A leaf: (kind, fact, column, own filters); kind is "rows", "sum" or "present".
@dataclass
class _Leaf:
    kind: str
    fact: str
    column: str | None
    where: Filters
    name: str = ""


class _Evaluation:
    def __init__(self, model: Model, by: tuple[str, ...], context: Filters):
        self.model, self.by, self.context = model, by, dict(context)
        self.leaves: list[_Leaf] = []
        self.dimension_means: dict[str, DimensionAverage] = {}

    # -- measures to leaves -------------------------------------------------

    def _leaf(self, kind: str, fact: str, column: str | None, where: Filters) -> Column:
        for known in self.leaves:
            if (known.kind, known.fact, known.column, known.where) == (kind, fact, column, where):
                return F.col(known.name)
        leaf = _Leaf(kind, fact, column, where, f"_leaf{len(self.leaves)}")
        self.leaves.append(leaf)
        return F.col(leaf.name)

    def value(self, name: str) -> Column:
        m = self.model.measures[name]
        if isinstance(m, Rows):
            return self._leaf("rows", m.table, None, m.where)
        if isinstance(m, Total):
            fact, column = split_name(m.column)
            return self._leaf("sum", fact, column, m.where)
        if isinstance(m, Average):
            fact, column = split_name(m.column)
            return ratio(
                self._leaf("sum", fact, column, m.where),
                self._leaf("present", fact, column, m.where),
            )
        if isinstance(m, DimensionAverage):
            slot = f"_mean_{len(self.dimension_means)}"
            for known, mean in self.dimension_means.items():
                if mean == m:
                    slot = known
            self.dimension_means[slot] = m
            return F.col(slot)
        if isinstance(m, YearOnYear):
            raise ValueError(f"{name} can be asked for, but not used inside another measure")
        return m.combine(*[self.value(i) for i in m.inputs])

    # -- stored totals or the fact itself -------------------------------------

    def _rollup(self, fact: str, joins: dict[str, Relationship]) -> Rollup | None:
        """The first rollup that is kept by everything the evaluation groups, joins or filters
        by on the fact, and has all its totals."""
        asked = {split_name(c)[1] for c in (*self.by, *self.context) if split_name(c)[0] == fact}
        asked |= {split_name(c)[1] for leaf in self.leaves for c in leaf.where}
        for rollup in self.model.rollups:
            if rollup.fact != fact or not asked <= rollup.keys:
                continue
            reached = all(
                r.fact_key in (rollup.days if r.as_date else rollup.keys) for r in joins.values()
            )
            if reached and all(rollup.holds(leaf.kind, leaf.column) for leaf in self.leaves):
                return rollup
        return None

    @staticmethod
    def _from_fact(leaf: _Leaf, condition: Column | None) -> Column:
        subject = F.lit(1) if leaf.kind == "rows" else F.col(leaf.column)
        if condition is not None:
            subject = F.when(condition, subject)
        return F.sum(subject) if leaf.kind == "sum" else F.count(subject)

    @staticmethod
    def _from_rollup(leaf: _Leaf, condition: Column | None, rollup: Rollup) -> Column:
        stored = rollup.holds(leaf.kind, leaf.column)
        subject = F.col(stored)
        if condition is not None:
            subject = F.when(condition, subject)
        if leaf.kind != "sum":
            return F.coalesce(F.sum(subject), F.lit(0))
        # In the type it has as the fact's own sum.
        return F.sum(subject).cast(rollup.table.schema[stored].dataType)

    # -- one fact pass ------------------------------------------------------

    def _fact(self) -> str:
        facts = {leaf.fact for leaf in self.leaves}
        if len(facts) != 1:
            raise ValueError(f"one evaluation covers exactly one fact table, got {sorted(facts)}")
        return facts.pop()

    def _condition(self, leaf: _Leaf, kept: list[str]) -> Column | None:
        """Own filters and the context filters it does not replace, on fact columns."""
        tests = [self.context[c](F.col(split_name(c)[1])) for c in kept if c not in leaf.where]
        for name, predicate in leaf.where.items():
            table, column = split_name(name)
            if table != leaf.fact:
                raise ValueError(f"a measure filter must be on its own fact: {name}")
            tests.append(predicate(F.col(column)))
        if not tests:
            return None
        condition = tests[0]
        for t in tests[1:]:
            condition = condition & t
        return condition

    def members(self) -> DataFrame:
        """Grouping rows when only dimension means are asked for: no fact takes part."""
        homes = {split_name(c)[0] for c in self.by}
        if len(homes) > 1:
            raise ValueError(f"without a fact, group by columns of one table, got {sorted(homes)}")
        averaged = next(iter(self.dimension_means.values())).column
        rows = self._filtered(homes.pop() if homes else split_name(averaged)[0])
        return rows.groupBy(*[split_name(c)[1] for c in self.by]).agg(
            F.count(F.lit(1)).alias("_members")
        )

    def totals(self) -> DataFrame:
        if not self.leaves:
            return self.members()
        fact_name = self._fact()
        named = {split_name(c)[0] for c in (*self.by, *self.context)} | set(self.model.secured)
        joins: dict[str, Relationship] = {}
        for table in sorted(named - {fact_name}):
            route = self.model.path(table, fact_name)
            if route is None:
                if table in {split_name(c)[0] for c in self.by}:
                    raise ValueError(f"{table} is not related to {fact_name}")
                continue
            joins[table] = route

        rollup = self._rollup(fact_name, joins)
        fact = rollup.table if rollup else self.model.tables[fact_name]
        on_fact = [c for c in self.context if split_name(c)[0] == fact_name]
        # A context filter every leaf keeps is a plain filter that reaches the scan;
        # one that some leaf replaces has to be tested leaf by leaf.
        shared = [c for c in on_fact if all(c not in leaf.where for leaf in self.leaves)]
        per_leaf = [c for c in on_fact if c not in shared]
        for name in shared:
            fact = fact.filter(self.context[name](F.col(split_name(name)[1])))

        keys = []
        for table, route in joins.items():
            day = rollup.days.get(route.fact_key) if rollup and route.as_date else None
            key = F.col(day or route.fact_key)
            keys.append((key.cast("date") if route.as_date else key).alias(f"_fk_{table}"))
        own_by = [split_name(c)[1] for c in self.by if split_name(c)[0] == fact_name]
        aggs = []
        for leaf in self.leaves:
            condition = self._condition(leaf, per_leaf)
            total = (
                self._from_rollup(leaf, condition, rollup)
                if rollup
                else self._from_fact(leaf, condition)
            )
            aggs.append(total.alias(leaf.name))
        result = fact.groupBy(*keys, *own_by).agg(*aggs)

        for table, route in joins.items():
            result = result.join(
                self._dimension(table, route.dimension_key), f"_fk_{table}"
            ).drop(f"_fk_{table}")
        if joins:
            result = result.groupBy(*[split_name(c)[1] for c in self.by]).agg(
                *[self._regroup(leaf).alias(leaf.name) for leaf in self.leaves]
            )
        return result

    @staticmethod
    def _regroup(leaf: _Leaf) -> Column:
        total = F.sum(leaf.name)
        return total if leaf.kind == "sum" else F.coalesce(total, F.lit(0))

    def _filtered(self, table: str) -> DataFrame:
        frame = self.model.tables[table]
        for name, predicate in self.context.items():
            if split_name(name)[0] == table:
                frame = frame.filter(predicate(F.col(split_name(name)[1])))
        return frame

    def _dimension(self, table: str, key: str) -> DataFrame:
        wanted = [split_name(c)[1] for c in self.by if split_name(c)[0] == table]
        return self._filtered(table).select(F.col(key).alias(f"_fk_{table}"), *wanted)

    # -- dimension means ----------------------------------------------------

    def with_dimension_means(self, totals: DataFrame) -> DataFrame:
        for slot, m in self.dimension_means.items():
            table, column = split_name(m.column)
            rows = self._filtered(table)
            shared = [split_name(c)[1] for c in self.by if split_name(c)[0] == table]
            average = (F.avg(F.col(column).cast("double")) / m.divisor).alias(slot)
            if not shared:
                totals = totals.withColumn(slot, rows.agg(average).scalar())
                continue
            # A NULL group is a group like any other, so its mean must find it.
            means = rows.groupBy(*[F.col(c).alias(f"_of_{c}") for c in shared]).agg(average)
            same = reduce(
                Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in shared]
            )
            totals = totals.join(means, same, "left").drop(*[f"_of_{c}" for c in shared])
        return totals


def evaluate(
    model: Model,
    measures: list[str],
    by: tuple[str, ...] | list[str] = (),
    context: Filters | None = None,
) -> DataFrame:
    """The grouping columns followed by one column per measure, named after it."""
    group = [split_name(c)[1] for c in by]
    if len(set(group)) < len(group):
        raise ValueError(f"grouping columns must differ in name: {group}")
    growth = [n for n in measures if isinstance(model.measures[n], YearOnYear)]
    if growth:
        return _with_growth(model, measures, growth, tuple(by), dict(context or {}))
    run = _Evaluation(model, tuple(by), context or {})
    values = {name: run.value(name) for name in measures}
    rows = run.with_dimension_means(run.totals())
    return rows.select(*group, *[v.alias(name) for name, v in values.items()])


def _with_growth(
    model: Model, measures: list[str], growth: list[str], by: tuple[str, ...], context: dict
) -> DataFrame:
    group = [split_name(c)[1] for c in by]
    period = next((c for c in (YEAR, DAY) if c in by), None)
    dates = [c for c in (*by, *context) if split_name(c)[0] == split_name(YEAR)[0]]
    repeating = {c for c in by if c in REPEATS_YEARLY} if period == YEAR else set()
    if period is None or set(dates) - repeating - {period}:
        raise ValueError(f"growth needs {YEAR} or {DAY} and no other date filter, got {dates}")

    # The year before is outside a filter on the period, so that filter comes last.
    visible = context.pop(period, None)
    rest = [c for c in group if c != split_name(period)[1]]
    other = [n for n in measures if n not in growth]
    bases = [model.measures[n].base for n in growth]
    result = evaluate(model, list(dict.fromkeys(other + bases)), by, context)
    for name, base in zip(growth, bases):
        compare = with_prior_year if period == YEAR else with_prior_year_daily
        now, then = F.col(base), F.col(f"prior_{base}")
        result = (
            compare(result, split_name(period)[1], rest, base)
            .withColumn(name, ratio(now - then, then))
            .drop(f"prior_{base}")
        )
    if visible is not None:
        result = result.filter(visible(F.col(split_name(period)[1])))
    return result.select(*group, *measures)
