"""Cells of hierarchical grids as Column arithmetic: nested HEALPix and rectilinear.

A HEALPix cell is its nested number in a long (Gorski et al. 2005); the level is
the schema's. Latitudes are authalic on WGS84 (Snyder 1987), so that cells have
equal areas on the ellipsoid. Coarsening is a shift, what lies under an ancestor
is a range of numbers, and the common ancestor of a set is the shared prefix of
its least and greatest number.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ORDER = 29
_E2 = 0.0066943799901413165  # WGS84
_E = math.sqrt(_E2)
_A = 6378137.0


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def _q(s: Column) -> Column:
    return (1 - _E2) * (s / (1 - _E2 * s * s) - (1 / (2 * _E)) * F.ln((1 - _E * s) / (1 + _E * s)))


_QP = (1 - _E2) * (1 / (1 - _E2) - (1 / (2 * _E)) * math.log((1 - _E) / (1 + _E)))


def authalic_sine(lat) -> Column:
    """Sine of the authalic latitude of a geodetic latitude in degrees."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _q(F.sin(F.radians(_col(lat)))) / _QP))


def geodetic(b: Column) -> Column:
    """Geodetic latitude in degrees of an authalic latitude in radians (Snyder's series)."""
    e4, e6 = _E2**2, _E2**3
    return F.degrees(
        b
        + (_E2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * b)
        + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * b)
        + (761 * e6 / 45360) * F.sin(6 * b)
    )


#: A byte's bits at even places of a word, and the bits at even places of a byte next to each other.
_SPREAD = [sum((v >> k & 1) << (2 * k) for k in range(8)) for v in range(256)]
_GATHER = [sum((v >> (2 * k) & 1) << k for k in range(4)) for v in range(256)]


def _by_byte(x: Column, values: list[int], count: int, width: int) -> Column:
    """Bytes of x, looked up and set side by side; x stands in the expression once a byte."""
    lookup = F.array(*[F.lit(v).cast("long") for v in values])
    out = None
    for k in range(count):
        one = F.shiftleft(F.get(lookup, F.shiftright(x, 8 * k).bitwiseAND(F.lit(255)).cast("int")), width * k)
        out = one if out is None else out.bitwiseOR(one)
    return out


def spread(x: Column) -> Column:
    """The bits of a number below 2**31 at even places."""
    return _by_byte(x.cast("long"), _SPREAD, 4, 16)


def gather(x: Column) -> Column:
    """The bits at even places, next to each other."""
    return _by_byte(x.cast("long"), _GATHER, 8, 4)


def _apart(x: Column) -> Column:
    """x, in a projection through which no filter moves: a filter on x would repeat the whole formula for each of its uses."""
    return x + F.monotonically_increasing_id() * 0


def with_healpix(df: DataFrame, lat: str, lon: str, order: int, out: str = "cell") -> DataFrame:
    """df with the nested cell of each point in degrees; null where a coordinate is null or NaN.

    The formula is laid out over several projections, so that each step is worked
    out once and the generated code stays small.
    """
    nside = 1 << order
    df = df.withColumns({"__z": authalic_sine(lat), "__turn": F.pmod(F.col(lon), F.lit(360.0)) / 90.0})  # quarters of a circle
    z, turn = F.col("__z"), F.col("__turn")
    df = df.withColumns({
        "__up": F.floor(nside * (0.5 + turn) - nside * z * 0.75).cast("long"), "__down": F.floor(nside * (0.5 + turn) + nside * z * 0.75).cast("long"),
        "__quarter": F.least(F.lit(3), F.floor(turn)).cast("long"), "__scale": nside * F.sqrt(F.greatest(3 * (1 - F.abs(z)), F.lit(0.0))),
    })
    part = turn - F.col("__quarter")
    df = df.withColumns({n: F.least(F.floor(p * F.col("__scale")).cast("long"), F.lit(nside - 1)) for n, p in (("__p", part), ("__m", 1 - part))})
    up, down, quarter, cap_p, cap_m = (F.col(c) for c in ("__up", "__down", "__quarter", "__p", "__m"))
    face_up, face_down = F.shiftright(up, order), F.shiftright(down, order)
    belt_face = F.when(face_up == face_down, face_up.bitwiseOR(F.lit(4))).when(face_up < face_down, face_up).otherwise(face_down + 8)
    north, belt = z >= 0, F.abs(z) <= 2.0 / 3.0
    df = df.withColumns({
        "__face": F.when(belt, belt_face).when(north, quarter).otherwise(quarter + 8),
        "__x": F.when(belt, down.bitwiseAND(F.lit(nside - 1))).when(north, nside - cap_m - 1).otherwise(cap_p),
        "__y": F.when(belt, nside - 1 - up.bitwiseAND(F.lit(nside - 1))).when(north, nside - cap_p - 1).otherwise(cap_m),
    })
    cell = F.shiftleft(F.col("__face").bitwiseAND(F.lit(15)), 2 * order) + spread(F.col("__x")) + 2 * spread(F.col("__y"))
    known = F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    return df.withColumn(out, F.when(known, _apart(cell))).drop("__z", "__turn", "__up", "__down", "__quarter", "__scale", "__p", "__m", "__face", "__x", "__y")


def with_center(df: DataFrame, cell: str, order: int, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """df with latitude and longitude (degrees, 0 to 360) of the centre of each nested cell, over several projections."""
    nside = 1 << order
    inner = F.col(cell).bitwiseAND(F.lit((1 << (2 * order)) - 1))
    df = df.withColumns({"__face": (F.shiftright(cell, 2 * order) + 1).cast("int"), "__x": gather(inner), "__y": gather(F.shiftright(inner, 1))})
    rings, starts = (F.array(*[F.lit(v) for v in row]) for row in ((2, 2, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4), (1, 3, 5, 7, 0, 2, 4, 6, 1, 3, 5, 7)))
    x, y, ring = F.col("__x"), F.col("__y"), F.col("__ring")
    df = df.withColumns({"__ring": F.element_at(rings, F.col("__face")) * nside - x - y - 1, "__start": F.element_at(starts, F.col("__face"))})
    df = df.withColumn("__count", F.when(ring < nside, ring).when(ring > 3 * nside, 4 * nside - ring).otherwise(F.lit(nside)).cast("double"))
    count = F.col("__count")
    cap = 1 - count * count / (3.0 * nside * nside)
    df = df.withColumn("__z", F.when(ring < nside, cap).when(ring > 3 * nside, -cap).otherwise((2 * nside - ring) * 2 / (3.0 * nside)))
    df = df.withColumn(lon, F.pmod(45.0 * (F.col("__start") * count + x - y) / count, F.lit(360.0))).withColumn("__b", F.asin("__z"))
    return df.withColumns({lat: _apart(geodetic(F.col("__b"))), lon: F.col(lon)}).drop("__face", "__x", "__y", "__ring", "__start", "__count", "__z", "__b")


def coarsen(cell, levels: int) -> Column:
    return F.shiftright(_col(cell), 2 * levels)


def children(cell, levels: int) -> tuple[Column, Column]:
    """First cell and end (exclusive) of a cell's descendants so many levels down."""
    cell = _col(cell)
    return F.shiftleft(cell, 2 * levels), F.shiftleft(cell + 1, 2 * levels)


def is_under(cell, ancestor: int, levels: int) -> Column:
    """Whether cells lie under an ancestor: a range, which file statistics can prune."""
    return _col(cell).between(ancestor << (2 * levels), ((ancestor + 1) << (2 * levels)) - 1)


def nuniq(cell, order: int) -> Column:
    """One number for cells of mixed orders: 4 * 4**order + cell."""
    return F.lit(4 << (2 * order)) + _col(cell)


def common_levels(low: Column, high: Column) -> Column:
    """Levels up to the first cell that holds both."""
    differ = low.bitwiseXOR(high)
    bits = F.when(differ == 0, F.lit(0)).otherwise(F.length(F.bin(differ)))
    return F.floor((bits + 1) / 2).cast("int")


def ancestor_of(low: Column, high: Column, order: int) -> Column:
    """nuniq of the least cell that holds both cells; null if they have different faces."""
    up = common_levels(low, high)
    shifts = F.element_at(F.array(*[F.shiftright(low, 2 * k) + (4 << (2 * (order - k))) for k in range(order + 1)]), F.least(up, F.lit(order)) + 1)
    return F.when(up <= order, shifts)


def common_ancestor(cell, order: int) -> Column:
    """Aggregate: nuniq of the least cell that holds all of a group's cells; null if they have different faces."""
    return ancestor_of(F.min(_col(cell)), F.max(_col(cell)), order)


def label(cell, order: int) -> Column:
    """A cell as text: hemisphere sign and base, then a digit from 1 to 4 for each order."""
    cell = _col(cell)
    face = F.shiftright(cell, 2 * order)
    base = F.concat(F.when(face < 6, F.lit("")).otherwise(F.lit("-")), (F.when(face < 6, face).otherwise(face - 6) + 1).cast("string"))
    digits = [(F.shiftright(cell, 2 * k).bitwiseAND(F.lit(3)) + 1).cast("string") for k in range(order - 1, -1, -1)]
    return F.concat(base, *digits)


def from_label(text) -> Column:
    """The cell of a label, at the order that its length gives."""
    text = _col(text)
    south = text.startswith("-")
    plain = F.regexp_replace(text, "^-", "")
    face = F.substring(plain, 1, 1).cast("long") - 1 + F.when(south, 6).otherwise(0)
    digits = F.transform(F.regexp_extract_all(F.substring(plain, 2, 64), F.lit("[1-4]"), F.lit(0)), lambda d: d.cast("long") - 1)
    return F.aggregate(digits, face.cast("long"), lambda total, d: total * 4 + d)


def row_col(rank) -> tuple[Column, Column]:
    """Row and column of a nested rank within its parent."""
    rank = _col(rank)
    return gather(F.shiftright(rank, 1)), gather(rank)


@dataclass(frozen=True)
class RectGrid:
    """Row-major cells from (xmin, ymax); shards are tiles of tile_rows x tile_cols cells. Sizes are padded up to whole tiles."""

    xmin: float
    ymin: float
    xmax: float
    ymax: float
    rx: float
    ry: float
    tile_rows: int = 1
    tile_cols: int = 1
    crs: str = "EPSG:4326"

    @property
    def width(self) -> int:
        return -(-math.ceil(round((self.xmax - self.xmin) / self.rx, 9)) // self.tile_cols) * self.tile_cols

    @property
    def height(self) -> int:
        return -(-math.ceil(round((self.ymax - self.ymin) / self.ry, 9)) // self.tile_rows) * self.tile_rows

    def cell(self, x, y) -> Column:
        """Cell of a point in the grid's own coordinates; -1 out of bounds."""
        col = F.floor((_col(x) - self.xmin) / self.rx)
        row = F.floor((self.ymax - _col(y)) / self.ry)
        inside = (col >= 0) & (col < self.width) & (row >= 0) & (row < self.height)
        return F.when(inside, row * self.width + col).otherwise(F.lit(-1)).cast("long")

    def with_cell(self, df: DataFrame, lat: str, lon: str, out: str = "cell") -> DataFrame:
        x, y = project(self.crs, lat, lon)
        return df.withColumns({"__x": x, "__y": y}).withColumn(out, self.cell("__x", "__y")).drop("__x", "__y")

    def shard(self, cell) -> Column:
        cell = _col(cell)
        row, col = F.floor(cell / self.width), F.pmod(cell, F.lit(self.width))
        tile = F.floor(row / self.tile_rows) * (self.width // self.tile_cols) + F.floor(col / self.tile_cols)
        return F.when(cell >= 0, tile).otherwise(F.lit(-1)).cast("long")

    def center(self, cell) -> tuple[Column, Column]:
        cell = _col(cell)
        row, col = F.floor(cell / self.width), F.pmod(cell, F.lit(self.width))
        return self.xmin + (col + 0.5) * self.rx, self.ymax - (row + 0.5) * self.ry

    def nests_with(self, other: object, fields: tuple = (), other_fields: tuple = ()) -> bool:
        """Whether products on both grids have the same cells and fields; tiles may differ."""
        same = isinstance(other, RectGrid) and all(getattr(self, k) == getattr(other, k) for k in ("xmin", "ymin", "xmax", "ymax", "rx", "ry", "crs"))
        return same and tuple(fields) == tuple(other_fields)

    def signature(self) -> dict:
        return {"type": "rectilinear"} | {k: getattr(self, k) for k in self.__dataclass_fields__}


@dataclass(frozen=True)
class HealpixGrid:
    """Cells at child_order, shards their ancestors at parent_order, chunks at chunk_order."""

    parent_order: int
    child_order: int
    chunk_order: int | None = None

    def with_cell(self, df: DataFrame, lat: str, lon: str, out: str = "cell") -> DataFrame:
        return with_healpix(df, lat, lon, self.child_order, out)

    def shard(self, cell) -> Column:
        return coarsen(cell, self.child_order - self.parent_order)

    def chunk(self, cell) -> Column:
        return coarsen(cell, self.child_order - (self.chunk_order if self.chunk_order is not None else self.parent_order))

    def children_per_shard(self) -> int:
        return 1 << (2 * (self.child_order - self.parent_order))

    def signature(self) -> dict:
        return {"type": "healpix", "parent_order": self.parent_order, "child_order": self.child_order, "chunk_order": self.chunk_order}

    def nests_with(self, other: object, fields: tuple = (), other_fields: tuple = ()) -> bool:
        """Whether products on both grids can stand in one hierarchy: nested cells do at any orders, if the output fields are the same."""
        return isinstance(other, HealpixGrid) and tuple(fields) == tuple(other_fields)


def project(crs: str, lat, lon) -> tuple[Column, Column]:
    """x and y of a point in degrees. EPSG:4326, 3857, 3031, 3413, 6933 (equal-area cylindrical), 326xx/327xx (UTM)."""
    lat, lon = _col(lat), _col(lon)
    if crs == "EPSG:4326":
        return lon, lat
    if crs == "EPSG:3857":
        return F.radians(lon) * _A, F.ln(F.tan(math.pi / 4 + F.radians(lat) / 2)) * _A
    if crs == "EPSG:6933":
        k0 = math.cos(math.radians(30)) / math.sqrt(1 - _E2 * math.sin(math.radians(30)) ** 2)
        return F.radians(lon) * _A * k0, _q(F.sin(F.radians(lat))) * _A / (2 * k0)
    if crs in ("EPSG:3031", "EPSG:3413"):
        sign, true_lat, lon0 = (-1, 71.0, 0.0) if crs == "EPSG:3031" else (1, 70.0, -45.0)
        phi, s = F.radians(sign * lat), math.sin(math.radians(true_lat))
        t = F.tan(math.pi / 4 - phi / 2) / F.pow((1 - _E * F.sin(phi)) / (1 + _E * F.sin(phi)), F.lit(_E / 2))
        tc = math.tan(math.pi / 4 - math.radians(true_lat) / 2) / ((1 - _E * s) / (1 + _E * s)) ** (_E / 2)
        mc = math.cos(math.radians(true_lat)) / math.sqrt(1 - _E2 * s * s)
        rho, angle = _A * mc * t / tc, F.radians(lon - lon0)
        return rho * F.sin(angle), (rho * F.cos(angle)) * (1 if sign < 0 else -1)
    zone = crs.removeprefix("EPSG:")
    if zone[:3] in ("326", "327") and len(zone) == 5:
        return _utm(lat, lon, int(zone[3:]), zone[:3] == "327")
    raise ValueError(f"no formula for {crs}")


def _utm(lat: Column, lon: Column, zone: int, south: bool) -> tuple[Column, Column]:
    """Transverse Mercator by Snyder's series."""
    k0, ep2 = 0.9996, _E2 / (1 - _E2)
    phi, lam = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    n = _A / F.sqrt(1 - _E2 * F.sin(phi) * F.sin(phi))
    t, c, a = F.pow(F.tan(phi), 2), ep2 * F.pow(F.cos(phi), 2), F.cos(phi) * lam
    e4, e6 = _E2**2, _E2**3
    m = _A * (
        (1 - _E2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * phi
        - (3 * _E2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * F.sin(2 * phi)
        + (15 * e4 / 256 + 45 * e6 / 1024) * F.sin(4 * phi)
        - (35 * e6 / 3072) * F.sin(6 * phi)
    )
    x = k0 * n * (a + (1 - t + c) * F.pow(a, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * F.pow(a, 5) / 120)
    y = k0 * (m + n * F.tan(phi) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * F.pow(a, 4) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * F.pow(a, 6) / 720))
    return x + 500000.0, y + (10000000.0 if south else 0.0)


def pixel(x, y, affine: tuple[float, float, float, float, float, float], rows: int, cols: int) -> tuple[Column, Column]:
    """Row and column of the pixel at a point; null out of bounds. A singular affine is refused."""
    a, b, c, d, e, f = affine
    det = a * e - b * d
    if det == 0:
        raise ValueError("the affine has no inverse")
    dx, dy = _col(x) - c, _col(y) - f
    col = F.floor((e * dx - b * dy) / det)
    row = F.floor((a * dy - d * dx) / det)
    inside = (col >= 0) & (col < cols) & (row >= 0) & (row < rows)
    return F.when(inside, row).cast("long"), F.when(inside, col).cast("long")
