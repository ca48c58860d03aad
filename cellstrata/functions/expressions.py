"""A small numpy-like expression language, compiled to Columns.

Only names of columns, numbers, arithmetic, comparisons, masks and the functions
listed here are known; anything else is refused, nothing is evaluated in Python.
`per_row` compiles a mask or a derived column, `aggregate` a reduction over the
rows of a group, where reductions may stand anywhere but inside one another.
"""

from __future__ import annotations

import ast
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")


def is_nan(x: Column) -> Column:
    return F.coalesce(F.isnan(x.cast("double")), F.lit(False))


def present(x: Column) -> Column:
    """x, or null where it is NaN."""
    return F.when(~is_nan(x), x)


def _nan_if(any_nan: Column, value: Column) -> Column:
    return F.when(any_nan, F.lit(NAN)).otherwise(value.cast("double"))


def _strict(agg: Callable[[Column], Column]) -> Callable[..., Column]:
    """A reduction that NaN goes through; NaN for no rows."""
    return lambda x, *a: F.coalesce(_nan_if(F.max(is_nan(x)), agg(x.cast("double"), *a)), F.lit(NAN))


def _skipping(agg: Callable[[Column], Column]) -> Callable[..., Column]:
    return lambda x, *a: F.coalesce(agg(present(x.cast("double")), *a), F.lit(NAN))


def _quantile(x: Column, q) -> Column:
    return F.percentile(x, q)


#: Reductions by name: population moments, exact linear quantiles; the nan forms skip NaN.
REDUCTIONS: dict[str, Callable[..., Column]] = {
    "len": lambda *x: F.count(F.lit(1)), "count": lambda *x: F.count(F.lit(1)),
    "min": _strict(F.min), "max": _strict(F.max), "mean": _strict(F.avg), "sum": _strict(F.sum),
    "var": _strict(F.var_pop), "std": _strict(F.stddev_pop), "median": _strict(lambda x: _quantile(x, 0.5)), "quantile": _strict(_quantile),
    "nanmin": _skipping(F.min), "nanmax": _skipping(F.max), "nanmean": _skipping(F.avg), "nanvar": _skipping(F.var_pop),
    "nanstd": _skipping(F.stddev_pop), "nanmedian": _skipping(lambda x: _quantile(x, 0.5)), "nanquantile": _skipping(_quantile),
    "nansum": lambda x: F.coalesce(F.sum(present(x.cast("double"))), F.lit(0.0)),
    "average": lambda x, w: F.sum(x * w) / F.sum(w),
    "count_distinct": lambda x: F.count_distinct(x),
    "unique_or_zero": lambda x: F.when(F.min(x) == F.max(x), F.min(x)).otherwise(F.lit(0)),
    "single_or_nan": lambda x: F.coalesce(F.when(F.min(x) == F.max(x), F.min(x).cast("double")), F.lit(NAN)),
}

#: Functions of each row by name.
SCALARS: dict[str, Callable[..., Column]] = {
    "sqrt": F.sqrt, "abs": F.abs, "floor": lambda x: F.floor(x).cast("double"), "ceil": lambda x: F.ceil(x).cast("double"), "log": F.ln, "log2": F.log2,
    "log10": F.log10, "exp": F.exp, "sin": F.sin, "cos": F.cos, "tan": F.tan, "arcsin": F.asin, "arccos": F.acos, "arctan": F.atan,
    "arctan2": F.atan2, "radians": F.radians, "degrees": F.degrees, "rint": F.rint, "sign": F.signum,
    "maximum": lambda a, b: F.when(is_nan(a) | is_nan(b), F.lit(NAN)).otherwise(F.greatest(a.cast("double"), b.cast("double"))),
    "minimum": lambda a, b: F.when(is_nan(a) | is_nan(b), F.lit(NAN)).otherwise(F.least(a.cast("double"), b.cast("double"))),
    "where": lambda c, a, b: F.when(c, a).otherwise(b), "isnan": is_nan, "isfinite": lambda x: ~is_nan(x) & (F.abs(x.cast("double")) != float("inf")),
    "float": lambda x: x.cast("double"), "float32": lambda x: x.cast("float"), "float64": lambda x: x.cast("double"), "int": lambda x: x.cast("long"),
    "power": F.pow, "clip": lambda x, a, b: F.greatest(a, F.least(b, x)),
}

_BINARY = {
    ast.Add: lambda a, b: a + b, ast.Sub: lambda a, b: a - b, ast.Mult: lambda a, b: a * b,
    ast.Div: lambda a, b: a.cast("double") / b, ast.Pow: F.pow, ast.BitAnd: lambda a, b: a & b, ast.BitOr: lambda a, b: a | b,
    ast.FloorDiv: lambda a, b: F.floor(a.cast("double") / b), ast.Mod: F.pmod,
}
_COMPARE = {
    ast.Eq: lambda a, b: a == b, ast.NotEq: lambda a, b: a != b, ast.Lt: lambda a, b: a < b,
    ast.LtE: lambda a, b: a <= b, ast.Gt: lambda a, b: a > b, ast.GtE: lambda a, b: a >= b,
}
#: Where NaN would count as equal to itself and above all numbers, the side whose NaN decides.
_CHECKED = {ast.Eq: 0, ast.NotEq: 0, ast.Gt: 0, ast.GtE: 0, ast.Lt: 1, ast.LtE: 1}
CONSTANTS = {"pi": 3.141592653589793, "e": 2.718281828459045, "nan": NAN, "inf": float("inf")}


class ExpressionError(ValueError):
    pass


class _Compiler(ast.NodeVisitor):
    def __init__(self, columns: dict[str, Column], reductions: bool):
        self.columns, self.reductions, self.inside = columns, reductions, False

    def generic_visit(self, node):
        raise ExpressionError(f"{type(node).__name__} is not part of the language")

    def visit_Expression(self, node):
        return self.visit(node.body)

    def visit_Constant(self, node):
        if isinstance(node.value, bool | int | float | str):
            return F.lit(node.value)
        raise ExpressionError(f"constant {node.value!r}")

    def visit_Name(self, node):
        if node.id in self.columns:
            if self.reductions and not self.inside:
                raise ExpressionError(f"{node.id} has a value for each row; reduce it")
            return self.columns[node.id]
        raise ExpressionError(f"unknown name {node.id}")

    def visit_Attribute(self, node):
        if isinstance(node.value, ast.Name) and node.value.id == "np" and node.attr in CONSTANTS:
            return F.lit(CONSTANTS[node.attr])
        raise ExpressionError(f"attribute {node.attr}")

    def visit_UnaryOp(self, node):
        x = self.visit(node.operand)
        if isinstance(node.op, ast.USub):
            return -x
        if isinstance(node.op, ast.Invert | ast.Not):
            return ~x
        return x

    def visit_BinOp(self, node):
        if type(node.op) not in _BINARY:
            raise ExpressionError(f"operator {type(node.op).__name__}")
        return _BINARY[type(node.op)](self.visit(node.left), self.visit(node.right))

    def visit_BoolOp(self, node):
        parts = [self.visit(v) for v in node.values]
        out = parts[0]
        for p in parts[1:]:
            out = out & p if isinstance(node.op, ast.And) else out | p
        return out

    def visit_Compare(self, node):
        nodes = [node.left, *node.comparators]
        sides, out = [self.visit(n) for n in nodes], None
        for k, op in enumerate(node.ops):
            if type(op) not in _COMPARE:
                raise ExpressionError(f"comparison {type(op).__name__}")
            one = _COMPARE[type(op)](sides[k], sides[k + 1])
            checked = k + _CHECKED[type(op)]
            if not any(isinstance(n, ast.Constant) and isinstance(n.value, str) for n in nodes[k : k + 2]) and not isinstance(nodes[checked], ast.Constant):
                nan = F.coalesce(F.isnan(sides[checked].try_cast("double")), F.lit(False))
                one = one | nan if isinstance(op, ast.NotEq) else one & ~nan
            out = one if out is None else out & one
        return out

    def visit_Call(self, node):
        name = node.func.id if isinstance(node.func, ast.Name) else node.func.attr if isinstance(node.func, ast.Attribute) and isinstance(node.func.value, ast.Name) and node.func.value.id == "np" else None
        if name is None or node.keywords:
            raise ExpressionError("only plain calls of known functions")
        if self.reductions and name in REDUCTIONS and not (name in SCALARS and self.inside):
            if self.inside:
                raise ExpressionError(f"{name} inside another reduction")
            self.inside = True
            try:
                values = [self.visit(node.args[0])] if node.args else []
                rest = [a.value if isinstance(a, ast.Constant) else self.visit(a) for a in node.args[1:]]
            finally:
                self.inside = False
            return REDUCTIONS[name](*values, *rest)
        if name in SCALARS:
            return SCALARS[name](*[self.visit(a) for a in node.args])
        raise ExpressionError(f"unknown function {name}")


def _compile(text: str, columns: dict[str, Column], reductions: bool) -> Column:
    try:
        tree = ast.parse(text, mode="eval")
    except SyntaxError as error:
        raise ExpressionError(f"{text!r}: {error.msg}") from error
    return _Compiler(columns, reductions).visit(tree)


def per_row(text: str, columns: list[str]) -> Column:
    return _compile(text, {c: F.col(c) for c in columns}, False)


def aggregate(text: str, columns: list[str], scalars: dict[str, Column] | None = None) -> Column:
    """scalars: names with one value for each group, which may stand outside reductions."""
    known = {c: F.col(c) for c in columns}
    compiler = _Compiler(known, True)
    own = scalars or {}
    plain = compiler.visit_Name
    compiler.visit_Name = lambda node: own[node.id] if node.id in own else plain(node)
    return compiler.visit(ast.parse(text, mode="eval"))


def names_in(text: str) -> set[str]:
    return {n.id for n in ast.walk(ast.parse(text, mode="eval")) if isinstance(n, ast.Name)} - {"np"} - set(REDUCTIONS) - set(SCALARS)
