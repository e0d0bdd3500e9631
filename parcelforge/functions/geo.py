"""Planar geometry and the double-stereographic projection as native expressions.

A ring is an array of struct<x, y> without the closing point repeated.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: GRS80 and the parameters of the local double-stereographic grid (EPSG method 9809).
A, FLATTENING = 6378137.0, 1 / 298.257222101
LAT0, LON0, SCALE, EAST0, NORTH0 = math.radians(47.25), math.radians(-63.0), 0.999912, 400000.0, 800000.0

_E2 = FLATTENING * (2 - FLATTENING)
_E = math.sqrt(_E2)
_RHO = A * (1 - _E2) / (1 - _E2 * math.sin(LAT0) ** 2) ** 1.5
_NU = A / math.sqrt(1 - _E2 * math.sin(LAT0) ** 2)
_R = math.sqrt(_RHO * _NU)
_N = math.sqrt(1 + _E2 * math.cos(LAT0) ** 4 / (1 - _E2))
_S1 = (1 + math.sin(LAT0)) / (1 - math.sin(LAT0))
_S2 = (1 - _E * math.sin(LAT0)) / (1 + _E * math.sin(LAT0))
_W1 = (_S1 * _S2**_E) ** _N
_SIN_CHI00 = (_W1 - 1) / (_W1 + 1)
_C = (_N + math.sin(LAT0)) * (1 - _SIN_CHI00) / ((_N - math.sin(LAT0)) * (1 + _SIN_CHI00))
_W2 = _C * _W1
_CHI0 = math.asin((_W2 - 1) / (_W2 + 1))


def project(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to grid metres."""
    phi, lam = F.radians(lat), _N * (F.radians(lon) - F.lit(LON0))
    sa, sb = (1 + F.sin(phi)) / (1 - F.sin(phi)), (1 - _E * F.sin(phi)) / (1 + _E * F.sin(phi))
    w = _C * F.pow(sa * F.pow(sb, F.lit(_E)), F.lit(_N))
    chi = F.asin((w - 1) / (w + 1))
    b = 1 + F.sin(chi) * math.sin(_CHI0) + F.cos(chi) * math.cos(_CHI0) * F.cos(lam)
    east = EAST0 + 2 * _R * SCALE * F.cos(chi) * F.sin(lam) / b
    north = NORTH0 + 2 * _R * SCALE * (F.sin(chi) * math.cos(_CHI0) - F.cos(chi) * math.sin(_CHI0) * F.cos(lam)) / b
    return east, north


def unproject(east: Column, north: Column) -> tuple[Column, Column]:
    """Grid metres to degrees; the latitude by four Newton steps on the isometric latitude."""
    g = 2 * _R * SCALE * math.tan(math.pi / 4 - _CHI0 / 2)
    h = 4 * _R * SCALE * math.tan(_CHI0) + g
    x, y = east - EAST0, north - NORTH0
    i, j = F.atan2(x, h + y), F.atan2(x, g - y)
    j = j - i
    chi = F.lit(_CHI0) + 2 * F.atan((y - x * F.tan(j / 2)) / (2 * _R * SCALE))
    lam = (j + 2 * i) / _N + LON0
    psi = 0.5 * F.log((1 + F.sin(chi)) / (_C * (1 - F.sin(chi)))) / _N
    phi = 2 * F.atan(F.exp(psi)) - math.pi / 2
    # the steps run inside a fold, where the last value is a variable: written out, the expression would multiply
    start = F.struct(phi.alias("phi"), psi.alias("psi"))

    def newton(v: Column, _: Column) -> Column:
        now = F.log(F.tan(v["phi"] / 2 + math.pi / 4) * F.pow((1 - _E * F.sin(v["phi"])) / (1 + _E * F.sin(v["phi"])), F.lit(_E / 2)))
        slope = F.cos(v["phi"]) * (1 - _E2 * F.sin(v["phi"]) * F.sin(v["phi"])) / (1 - _E2)
        return F.struct((v["phi"] - (now - v["psi"]) * slope).alias("phi"), v["psi"].alias("psi"))

    phi = F.aggregate(F.array(*[F.lit(i) for i in range(4)]), start, newton)["phi"]
    return F.degrees(lam), F.degrees(phi)


def _edges(ring: Column) -> Column:
    return F.arrays_zip(ring.alias("p"), F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1)).alias("q"))


def area(ring: Column) -> Column:
    """Shoelace area."""
    cross = F.transform(_edges(ring), lambda e: e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda a, v: a + v)) / 2


def covers(ring: Column, x: Column, y: Column) -> Column:
    """Point in ring; the boundary counts as inside."""

    def on(e: Column) -> Column:
        p, q = e["p"], e["q"]
        cross = (q["x"] - p["x"]) * (y - p["y"]) - (q["y"] - p["y"]) * (x - p["x"])
        return (cross == 0) & x.between(F.least(p["x"], q["x"]), F.greatest(p["x"], q["x"])) & y.between(F.least(p["y"], q["y"]), F.greatest(p["y"], q["y"]))

    def crossing(e: Column) -> Column:
        p, q = e["p"], e["q"]
        return ((p["y"] > y) != (q["y"] > y)) & (x < (q["x"] - p["x"]) * (y - p["y"]) / F.nullif(q["y"] - p["y"], F.lit(0.0)) + p["x"])

    edges = _edges(ring)
    odd = F.size(F.filter(edges, lambda e: F.coalesce(crossing(e), F.lit(False)))) % 2 == 1
    return F.exists(edges, on) | odd


def boxes_meet(a: Column, b: Column) -> Column:
    """Overlap of two struct<x0, y0, x1, y1> boxes; touching counts."""
    return (a["x0"] <= b["x1"]) & (b["x0"] <= a["x1"]) & (a["y0"] <= b["y1"]) & (b["y0"] <= a["y1"])


def overlap_area(a: Column, b: Column) -> Column:
    """Area that two boxes share."""
    wide = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    high = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.greatest(wide, F.lit(0.0)) * F.greatest(high, F.lit(0.0))


def cells(box: Column, size: float) -> Column:
    """Grid cells (struct<i, j>) that a box touches: the equi-join key of spatial joins."""
    def span(low: str, high: str) -> Column:
        return F.sequence(F.floor(box[low] / size), F.floor(box[high] / size))

    return F.flatten(F.transform(span("x0", "x1"), lambda i: F.transform(span("y0", "y1"), lambda j: F.struct(i.alias("i"), j.alias("j")))))
