"""Data-quality rules. All row rules of a table are counted in one pass; uniqueness takes one shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule where `bad` holds; a rule with `keys` wants them unique instead."""

    name: str
    bad: str = ""
    keys: tuple[str, ...] = ()


def not_null(c: str) -> Rule:
    return Rule(f"{c} is not null", f"{c} is null")


def gt(c: str, lo: float) -> Rule:
    return Rule(f"{c} > {lo:g}", f"not {c} > {lo}")


def ge(c: str, lo: float) -> Rule:
    return Rule(f"{c} >= {lo:g}", f"not {c} >= {lo}")


def between(c: str, lo: float, hi: float) -> Rule:
    return Rule(f"{c} in [{lo:g}, {hi:g}]", f"not ({c} >= {lo} and {c} <= {hi})")


def isin(c: str, values: list[int]) -> Rule:
    return Rule(f"{c} in {values}", f"{c} not in ({', '.join(map(str, values))})")


def unique(*keys: str) -> Rule:
    return Rule(f"unique {', '.join(keys)}", keys=keys)


def expr(name: str, cond: str) -> Rule:
    return Rule(name, f"not ({cond})")


def feature_rules() -> list[Rule]:
    required = "set_id event_id tournament_id tournament_name completed_at player1_id player2_id p1_elo p2_elo elo_diff p1_expected p1_sets_played p2_sets_played p1_recent_wr p2_recent_wr recent_wr_diff p1_h2h_wins p2_h2h_wins p1_h2h_wr h2h_total p1_seed p2_seed seed_diff num_attendees p1_won".split()
    return [
        *map(not_null, required), unique("set_id"), gt("completed_at", 0), gt("p1_elo", 0), gt("p2_elo", 0), between("p1_expected", 0, 1), ge("p1_sets_played", 0), ge("p2_sets_played", 0), between("p1_recent_wr", 0, 1),
        between("p2_recent_wr", 0, 1), between("recent_wr_diff", -1, 1), ge("p1_h2h_wins", 0), ge("p2_h2h_wins", 0), between("p1_h2h_wr", 0, 1), ge("h2h_total", 0), gt("num_attendees", 0),
        isin("p1_won", [0, 1]), expr("two players", "player1_id <> player2_id"), expr("h2h total is the sum", "h2h_total = p1_h2h_wins + p2_h2h_wins"), expr("seed difference", "seed_diff = p1_seed - p2_seed"),
    ]


def check_schema(df: DataFrame, schema: StructType) -> list[str]:
    """What differs in names, order or types."""
    have, want = [(f.name, f.dataType) for f in df.schema.fields], [(f.name, f.dataType) for f in schema.fields]
    return [] if have == want else [f"{w[0]}: wanted {w}, found {h}" for h, w in zip(have + [("", None)] * len(want), want) if h != w] + [f"{h[0]}: not declared" for h in have[len(want) :]]


def violations(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """rule, violations: rows that break each rule, or keys that occur more than once."""
    rows = [r for r in rules if not r.keys]
    out = None
    if rows:
        one = df.agg(*(F.count_if(F.expr(f"coalesce({r.bad}, false)")).alias(f"r{i}") for i, r in enumerate(rows)))
        out = one.select(F.inline(F.array(*(F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("violations")) for i, r in enumerate(rows)))))
    for r in rules:
        if r.keys:
            n = df.filter(" and ".join(f"{k} is not null" for k in r.keys)).groupBy(*r.keys).count().agg(F.count_if(F.col("count") > 1).alias("violations")).select(F.lit(r.name).alias("rule"), "violations")
            out = n if out is None else out.unionByName(n)
    return out


def validate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return violations(df, rules).filter("violations > 0")


def assert_valid(df: DataFrame, rules: list[Rule], schema: StructType | None = None) -> bool:
    found = [*(check_schema(df, schema) if schema else []), *(f"{r['rule']}: {r['violations']}" for r in validate(df, rules).collect())]  # a row per rule
    if found:
        raise ValueError("; ".join(found))
    return True


def orphans(child: DataFrame, parent: DataFrame, column: str, key: str = "id") -> DataFrame:
    """Rows of child whose reference has no parent; a null reference is allowed."""
    p = parent.select(F.col(key).alias(column))
    return child.filter(F.col(column).isNotNull()).join(p, column, "left_anti")


def table_violations(tables: dict[str, DataFrame], schemas: dict[str, StructType], unique_columns: dict[str, list[str]], foreign: list[tuple[str, str, str]]) -> DataFrame:
    """table_name, rule, violations: the declared constraints of every table, over the columns that it has, and rows
    without a parent for each foreign key."""
    out = None
    for name, df in tables.items():
        schema = StructType([f for f in schemas[name].fields if f.name in df.columns])
        found = violations(df, table_rules(schema, [c for c in unique_columns.get(name, []) if c in df.columns]))
        for child, column, parent in foreign:
            if child == name:
                lost = orphans(df, tables[parent], column).agg(F.count(F.lit(1)).alias("violations"))
                found = found.unionByName(lost.select(F.lit(f"{column} in {parent}").alias("rule"), "violations"))
        found = found.select(F.lit(name).alias("table_name"), "rule", "violations")
        out = found if out is None else out.unionByName(found)
    return out


def table_rules(schema: StructType, unique_columns: list[str] = ()) -> list[Rule]:
    return [*(not_null(f.name) for f in schema.fields if not f.nullable), unique("id"), *(unique(c) for c in unique_columns)]
