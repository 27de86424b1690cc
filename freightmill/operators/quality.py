"""Contract checks. Each returns counts, never the offending rows, so a bad load
cannot flood the report; ``left_anti``/``filter`` on the same rule lists them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightmill.contracts import Contract

def _report(frame: DataFrame, table: str, rules: list[tuple[str, str, str]]) -> DataFrame:
    """One scan of ``frame`` for all rules (kind, column, SQL test of a broken value),
    then one output row per rule."""
    counts = [f"count_if({broken}) AS v{i}" for i, (_, _, broken) in enumerate(rules)]
    lines = [
        f"named_struct('table_name', '{table}', 'rule', '{rule}', 'column_name', '{column}', "
        f"'rows_checked', n, 'violations', v{i})"
        for i, (rule, column, _) in enumerate(rules)
    ]
    return frame.selectExpr("count(*) AS n", *counts).selectExpr(
        f"inline(array({', '.join(lines)}))"
    )


def check_not_null(frame: DataFrame, contract: Contract) -> DataFrame:
    """NOT NULL columns of the contract that the frame carries."""
    have = set(frame.columns)
    rules = [("NOT_NULL", c, f"{c} IS NULL") for c in contract.required if c in have]
    return _report(frame, contract.name, rules)


def check_domain(frame: DataFrame, contract: Contract) -> DataFrame:
    """0/1 flags, text limits and decimal ranges. NULLs are left to ``check_not_null``.

    Decimals that are still text are also checked for lost digits and for being numbers.
    """
    have = set(frame.columns)
    rules: list[tuple[str, str, str]] = []
    for a in contract.attributes:
        if a.name not in have:
            continue
        if a.is_flag:
            rules.append(("FLAG_0_1", a.name, f"{a.name} NOT IN (0, 1)"))
        elif a.max_length is not None:
            longer = f"length(CAST({a.name} AS STRING)) > {a.max_length}"
            rules.append(("MAX_LENGTH", a.name, longer))
        elif isinstance(a.dtype, T.DecimalType):
            limit = f"1e{a.dtype.precision - a.dtype.scale}BD"
            if isinstance(frame.schema[a.name].dataType, T.StringType):
                # Raw text still has what the cast to the contract would cut off.
                number = f"try_cast({a.name} AS DECIMAL(38,12))"
                short = f"round({number}, {a.dtype.scale})"
                rules.append(("DECIMAL_RANGE", a.name, f"abs({number}) >= {limit}"))
                rules.append(("DECIMAL_SCALE", a.name, f"{number} <> {short}"))
                rules.append(("READABLE", a.name, f"{a.name} IS NOT NULL AND {number} IS NULL"))
            else:
                rules.append(("DECIMAL_RANGE", a.name, f"abs({a.name}) >= {limit}"))
    return _report(frame, contract.name, rules)


def check_unique(frame: DataFrame, table: str, key: list[str]) -> DataFrame:
    """Keys that occur more than once, and the rows beyond the first of each."""
    per_key = frame.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    repeated = F.col("_n") > 1
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.lit("+".join(key)).alias("key_columns"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_checked"),
        F.count_if(repeated).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("_n") - 1)), F.lit(0)).alias("surplus_rows"),
    )


def check_references(
    fact: DataFrame, references: Mapping[str, tuple[DataFrame, str]], table: str
) -> DataFrame:
    """Per fact column, the keys (and rows) that no dimension row has. A NULL is an orphan.

    ``references`` maps a fact column to its dimension and key. One pass over the fact
    counts every column's keys by grouping sets, so a hot key is one row by the time
    it is matched.
    """
    columns = list(references)
    # grouping_id has a bit for each column left out of the set, the first column highest.
    everything = 2 ** len(columns) - 1
    ids = {c: everything - 2 ** (len(columns) - 1 - i) for i, c in enumerate(columns)}
    branch = " ".join(f"WHEN {g} THEN '{table}.{c}'" for c, g in ids.items())
    key = " ".join(f"WHEN {g} THEN CAST({c} AS STRING)" for c, g in ids.items())
    per_key = (
        fact.groupingSets([[F.col(c)] for c in columns], *[F.col(c) for c in columns])
        .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
        .selectExpr(f"CASE g {branch} END AS relation", f"CASE g {key} END AS key", "n")
    )
    known = reduce(
        DataFrame.unionAll,
        [
            dimension.selectExpr(
                f"'{table}.{c}' AS relation", f"CAST({name} AS STRING) AS key", "true AS known"
            )
            for c, (dimension, name) in references.items()
        ],
    )
    matched = per_key.join(known.distinct(), ["relation", "key"], "left")
    listed = ", ".join(f"'{table}.{c}'" for c in columns)
    none = fact.sparkSession.sql(
        f"SELECT explode(array({listed})) AS relation, CAST(NULL AS STRING) AS key, "
        "0L AS n, true AS known"
    )
    return (
        matched.unionByName(none)
        .groupBy("relation")
        .agg(
            F.expr("count_if(known IS NULL) AS orphan_keys"),
            F.expr("sum(CASE WHEN known IS NULL THEN n ELSE 0 END) AS orphan_rows"),
        )
    )
