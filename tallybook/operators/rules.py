"""Ordered first-match rules, compiled to one CASE expression or, long lists, to lookups.

A rule is plain data, so rules can live in a JSON file next to the budget:

    {"when": CONDITION, "then": VALUE}

    CONDITION  {"col": "merchant.name", "op": OP, "value": V, "fold": true?}
               {"all": [CONDITION, ...]}   {"any": [CONDITION, ...]}
    OP         eq  in  not_in  like  startswith  regex  extract_eq  lt  gt  present
    VALUE      a literal, {"col": name}, or {"col": name, "extract": pattern}

``fold`` compares in lower case.  ``extract_eq`` takes [pattern, value].  Conditions
follow SQL: a comparison with NULL is not true, so ``not_in`` does not match a NULL.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.text import extract_or_null

Rule = dict[str, Any]

_OPS: dict[str, Callable[[Column, Any], Column]] = {
    "eq": lambda c, v: c == F.lit(v),
    "in": lambda c, v: c.isin(list(v)),
    "not_in": lambda c, v: ~c.isin(list(v)),
    "like": lambda c, v: c.like(v),
    "startswith": lambda c, v: c.startswith(v),
    "regex": lambda c, v: c.rlike(v),
    "extract_eq": lambda c, v: extract_or_null(c, v[0]) == F.lit(v[1]),
    "lt": lambda c, v: c < F.lit(v),
    "gt": lambda c, v: c > F.lit(v),
    "present": lambda c, v: c.isNotNull() if v else c.isNull(),
}


def load_rules(path: str) -> list[Rule]:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def condition(spec: dict[str, Any], columns: dict[str, Column] | None = None) -> Column:
    if "all" in spec:
        return reduce(and_, [condition(s, columns) for s in spec["all"]])
    if "any" in spec:
        return reduce(or_, [condition(s, columns) for s in spec["any"]])
    c = _column(spec["col"], columns)
    if spec.get("fold"):
        c = F.lower(c)
    if spec["op"] not in _OPS:
        raise ValueError(f"unknown rule operator {spec['op']!r}")
    return _OPS[spec["op"]](c, spec.get("value", True))


def _column(name: str, columns: dict[str, Column] | None) -> Column:
    return columns[name] if columns and name in columns else F.col(name)


def _value(then: Any, columns: dict[str, Column] | None) -> Column:
    if not isinstance(then, dict):
        return F.lit(then)
    c = _column(then["col"], columns)
    return extract_or_null(c, then["extract"]) if "extract" in then else c


def apply_rules(
    rules: list[Rule], default: Column, columns: dict[str, Column] | None = None
) -> Column:
    """Value of the first rule that matches, else ``default``.

    ``columns`` names expressions a rule may use besides the frame's own columns.
    """
    out = None
    for rule in rules:
        test, value = condition(rule["when"], columns), _value(rule["then"], columns)
        out = F.when(test, value) if out is None else out.when(test, value)
    return default if out is None else out.otherwise(default)


def resolve_name(
    clean: Column,
    candidates: Column,
    rules: list[Rule],
    raw: Column,
    columns: dict[str, Column] | None = None,
) -> Column:
    """Clean name, else the first candidate's name, else the raw name put through rules."""
    return F.coalesce(clean, F.get(candidates, F.lit(0)), apply_rules(rules, raw, columns))


#: Up to so many rules are one CASE; from there on those on one column's text become lookups.
CASE_RULES = 50


def _texts(rule: Rule) -> tuple[str, bool, tuple[str, ...]] | None:
    """Column, whether its beginning is asked for, and texts, of a rule that a lookup can answer."""
    when = rule["when"]
    if "col" not in when or when.get("fold"):
        return None
    op, value = when["op"], when.get("value")
    values = tuple(value) if op == "in" else (value,)
    if not all(isinstance(v, str) for v in values):
        return None
    if op in ("eq", "in"):
        return when["col"], False, values
    if op == "startswith":
        return when["col"], True, values
    if op == "like" and value.endswith("%") and not set(value[:-1]) & set("%_\\"):
        return when["col"], True, (value[:-1],)
    return None


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.select(F.col(column).alias("c")).schema["c"].dataType, T.StringType)


def _result_type(df: DataFrame, rules: list[Rule], default: Column, columns: dict[str, Column] | None) -> T.DataType:
    """The type that one CASE over all rules would have; one rule of each kind of value decides it."""
    kinds = {repr(r["then"]) if isinstance(r["then"], dict) else type(r["then"]): r["then"] for r in rules}
    branches = [F.when(F.lit(True), _value(then, columns)) for then in kinds.values()]
    case = reduce(lambda all_, then: all_.when(F.lit(True), _value(then, columns)), list(kinds.values())[1:], branches[0])
    return df.select(case.otherwise(default).alias("c")).schema["c"].dataType


def with_rules(
    df: DataFrame,
    rules: list[Rule],
    default: Column,
    name: str,
    columns: dict[str, Column] | None = None,
) -> DataFrame:
    """``df`` with the value of the first rule that matches as column ``name``.

    A short list is one CASE. In a long one, rules that compare a text column with text, or with its
    beginning, are looked up in tables: one join for a column's values, one for each length of its
    beginnings. A lookup gives the place of the first rule that matches, the others stay a CASE of
    places, and the smallest place names the value. So values, types and comparisons are those of
    the CASE, whatever the list's length. Tables have as many rows as the list has texts, and
    Spark broadcasts them if they are under its threshold.
    """
    if len(rules) <= CASE_RULES:
        return df.withColumn(name, apply_rules(rules, default, columns))
    spark, kept = df.sparkSession, df.columns
    target = _result_type(df, rules, default, columns)
    tables: dict[tuple[str, int | None], dict[str, int]] = {}
    others: list[tuple[int, Rule]] = []
    text_columns: dict[str, bool] = {}
    for place, rule in enumerate(rules):
        found = _texts(rule)
        if found is not None and not (columns and found[0] in columns):
            column = found[0]
            if column not in text_columns:
                text_columns[column] = _is_text(df, column)
            if text_columns[column]:
                for text in found[2]:
                    length = len(text) if found[1] else None
                    tables.setdefault((column, length), {}).setdefault(text, place)
                continue
        others.append((place, rule))
    places = []
    for k, ((column, length), table) in enumerate(tables.items()):
        lookup = spark.createDataFrame(list(table.items()), f"_key_{k} string, _place_{k} int")
        text = F.col(column) if length is None else F.substring(column, 1, length)
        df = df.join(lookup, text == F.col(f"_key_{k}"), "left")
        places.append(F.col(f"_place_{k}"))
    if others:
        tests = [F.when(condition(rule["when"], columns), F.lit(place)) for place, rule in others]
        places.append(F.coalesce(*tests))
    first = F.least(*places) if len(places) > 1 else places[0]
    df = df.withColumn("_place", first)
    plain = F.array(*[F.lit(None if isinstance(r["then"], dict) else r["then"]).cast(target) for r in rules])
    value = F.when(F.col("_place").isNull(), default)
    for place, rule in enumerate(rules):
        if isinstance(rule["then"], dict):
            value = value.when(F.col("_place") == place, _value(rule["then"], columns))
    return df.withColumn(name, value.otherwise(F.get(plain, F.col("_place"))).cast(target)).select(*kept, name)
