"""Declared pipelines: parsed, checked before anything is read, and hashed by what defines their output."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from pathlib import Path

import yaml

from ..functions.cells import HealpixGrid, RectGrid
from ..functions.expressions import REDUCTIONS, names_in
from ..functions.packing import digest_of
from ..functions.times import FORMATS
from ..operators.aggregate import Field
from ..operators.pyramid import law_class


class SpecError(ValueError):
    pass


def _only(block: dict, known: set[str], where: str) -> None:
    extra = set(block) - known
    if extra:
        raise SpecError(f"{where}: unknown keys {sorted(extra)}")


@dataclass(frozen=True)
class DigestField:
    """A t-digest of a column, of the rows that `where` (a row expression) takes."""

    name: str
    source: str
    delta: float = 512
    weight: str | None = None
    where: str | None = None


@dataclass(frozen=True)
class PipelineSpec:
    variables: dict[str, str]
    latitude: str
    longitude: str
    grid: HealpixGrid | RectGrid
    fields: tuple[Field, ...]
    digests: tuple[DigestField, ...] = ()
    filters: tuple[dict, ...] = ()
    expression: str | None = None
    quality_filter: dict | None = None
    schedule: str | None = None
    time_field: str | None = None
    chunk_scalars: dict[str, str] = field(default_factory=dict)
    pyramid: tuple[int, ...] = ()
    options: dict = field(default_factory=dict)

    def core(self) -> dict:
        """What defines the output. Options (paths, widths) don't, nor do the grid's orders."""
        fields = [{k: _plain(getattr(f, k)) for k in f.__dataclass_fields__} for f in (*self.fields, *self.digests)]
        grid = {k: v for k, v in self.grid.signature().items() if not k.endswith("order")}
        return {
            "variables": self.variables, "coordinates": [self.latitude, self.longitude], "grid": grid, "fields": fields, "filters": list(self.filters),
            "expression": self.expression, "quality_filter": self.quality_filter, "window": [self.schedule, self.time_field], "chunk": self.chunk_scalars,
        }

    @property
    def semantic_hash(self) -> str:
        return digest_of(self.core())

    def foldable(self) -> dict[str, str]:
        """Fields with an exact merge law and their functions; the others stay at the native level."""
        return {f.name: f.function.removeprefix("np.") for f in self.fields if law_class((f.function or "").removeprefix("np.")) == "exact"}


def _plain(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def load(source: str | Path | dict) -> PipelineSpec:
    """From YAML (a path or text) or a dict."""
    if not isinstance(source, dict):
        text = Path(source).read_text() if isinstance(source, Path) or "\n" not in source else source
        source = yaml.safe_load(text)
    return parse(source)


def parse(config: dict) -> PipelineSpec:
    _only(config, {"data_source", "aggregation", "output", "options"}, "config")
    data, agg, out = config["data_source"], config["aggregation"], config["output"]
    _only(data, {"coordinates", "variables", "filters", "expression", "quality_filter"}, "data_source")
    _only(agg, {"variables", "chunk_precompute"}, "aggregation")
    _only(out, {"grid", "windowing", "pyramid"}, "output")
    variables = dict(data["variables"])
    if "expression" in data:
        unknown = names_in(data["expression"]) - set(variables)
        if unknown:
            raise SpecError(f"filter expression: unknown names {sorted(unknown)}")
    for f in data.get("filters", ()):
        if f.get("variable") not in variables:
            raise SpecError(f"filter on unknown variable {f.get('variable')!r}")
        if ("values" in f) != (f.get("op") in ("in", "not_in")):
            raise SpecError("values go with in and not_in, value with the other operators")
    chunk = dict(agg.get("chunk_precompute", {}))
    fields, digests = [], []
    for name, block in agg["variables"].items():
        _only(block, {"function", "expression", "source", "params", "dtype", "fill_value", "kind", "trailing_shape", "delta", "weights", "where"}, name)
        source = block.get("source")
        if source is not None and source not in variables:
            raise SpecError(f"{name}: unknown source {source!r}")
        if block.get("function") == "tdigest":
            digests.append(DigestField(name, source, block.get("delta", 512), block.get("weights"), block.get("where")))
            continue
        function = (block.get("function") or "").removeprefix("np.")
        if function and function not in REDUCTIONS:
            raise SpecError(f"{name}: unknown function {function!r}")
        if function and function not in ("len", "count") and source is None:
            raise SpecError(f"{name}: no source")
        if "expression" in block:
            unknown = names_in(block["expression"]) - set(variables) - set(chunk)
            if unknown:
                raise SpecError(f"{name}: unknown names {sorted(unknown)}")
        fill = block.get("fill_value", math.nan)
        fill = math.nan if fill == "NaN" else fill
        dtype = block.get("dtype", "float32")
        if not dtype.startswith("float") and (isinstance(fill, str) or isinstance(fill, float) and math.isnan(fill)) and function not in ("len", "count"):
            raise SpecError(f"{name}: an integer field needs a number to fill with")
        try:
            fields.append(Field(name, function or None, source, block.get("expression"), dict(block.get("params", {})), dtype, fill, block.get("kind", "scalar"), block.get("trailing_shape")))
        except ValueError as error:
            raise SpecError(str(error)) from error
    g = dict(out["grid"])
    kind = g.pop("type")
    try:
        grid = HealpixGrid(**g) if kind == "healpix" else RectGrid(**g) if kind == "rectilinear" else None
    except TypeError as error:
        raise SpecError(f"grid: {error}") from error
    if grid is None:
        raise SpecError(f"grid type {kind!r}")
    windowing = out.get("windowing", {})
    schedule = windowing.get("schedule")
    if schedule is not None and schedule not in FORMATS:
        raise SpecError(f"schedule {schedule!r}")
    if schedule and windowing.get("time_field") not in variables:
        raise SpecError("windowing: unknown time_field")
    pyramid = tuple(out.get("pyramid", ()))
    if pyramid and (not isinstance(grid, HealpixGrid) or any(o >= grid.child_order for o in pyramid) or list(pyramid) != sorted(set(pyramid), reverse=True)):
        raise SpecError("pyramid: falling orders above the cells")
    coordinates = data["coordinates"]
    return PipelineSpec(
        variables, coordinates["latitude"], coordinates["longitude"], grid, tuple(fields), tuple(digests), tuple(data.get("filters", ())), data.get("expression"),
        data.get("quality_filter"), schedule, windowing.get("time_field"), chunk, pyramid, dict(config.get("options", {})),
    )
