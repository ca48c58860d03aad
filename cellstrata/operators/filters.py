"""Structured predicates. A comparison with null or NaN is false (but ne, which is true), as arrays have no third value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import per_row

OPERATORS = {
    "eq": lambda c, v: c == v, "ne": lambda c, v: c != v, "ge": lambda c, v: c >= v,
    "le": lambda c, v: c <= v, "gt": lambda c, v: c > v, "lt": lambda c, v: c < v,
}


def _number(v) -> bool:
    return isinstance(v, int | float) and not isinstance(v, bool)


def _compared(op: str, x: Column, v) -> Column:
    """Never null, in a form that scans can be given."""
    if _number(v) and v != v:
        return F.lit(op == "ne")
    if op == "ne":
        return x.isNull() | (x != v)
    hit = x.isNotNull() & OPERATORS[op](x, F.lit(v))
    return hit & (x <= float("inf")) if op in ("ge", "gt") and _number(v) else hit  # to Spark NaN is above all numbers


def predicate(spec: dict) -> Column:
    """spec: variable, op, value or values, and optionally column (of an array variable) and keep (false inverts)."""
    unknown = set(spec) - {"variable", "op", "value", "values", "column", "keep", "level"}
    if unknown:
        raise ValueError(f"unknown keys {sorted(unknown)}")
    x = F.col(spec["variable"])
    if "column" in spec:
        x = F.get(x, F.lit(spec["column"]))
    op = spec["op"]
    if op in OPERATORS:
        hit = _compared(op, x, spec["value"])
    elif op in ("in", "not_in"):
        hit = x.isNotNull() & x.isin([v for v in spec["values"] if v == v])
        hit = ~hit if op == "not_in" else hit
    else:
        raise ValueError(f"unknown operator {op!r}")
    return hit if spec.get("keep", True) else ~hit


def quality(dataset: str, value) -> list[dict]:
    """A quality filter is one equality."""
    return [{"variable": dataset, "op": "eq", "value": value}]


def apply(df: DataFrame, filters: list[dict] = (), expression: str | None = None, quality_filter: dict | None = None) -> DataFrame:
    """Rows that all filters keep; the quality filter counts only without others."""
    filters = list(filters) or (quality(quality_filter["dataset"], quality_filter["value"]) if quality_filter else [])
    for spec in filters:
        df = df.where(predicate(spec))
    return df.where(per_row(expression, df.columns)) if expression else df


def in_boxes(boxes: list[tuple[float, float, float, float]], xmin="xmin", ymin="ymin", xmax="xmax", ymax="ymax") -> Column:
    """Whether a bounding box meets any of some boxes."""
    hit = F.lit(False)
    for a, b, c, d in boxes:
        hit = hit | ((F.col(xmin) <= c) & (F.col(xmax) >= a) & (F.col(ymin) <= d) & (F.col(ymax) >= b))
    return hit


def event_mask(kind: str, mask: str = "mask", flag: str = "ais_mask") -> Column:
    """Mask over a static flag: full, ais (inside the flag) or ocean (outside)."""
    options = {"full": F.col(mask), "ais": F.col(mask) * F.col(flag).cast("int"), "ocean": F.col(mask) * (1 - F.col(flag).cast("int"))}
    if kind not in options:
        raise ValueError(f"unknown mask {kind!r}")
    return options[kind]
