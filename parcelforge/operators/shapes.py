"""Polygon operators on Spark: a shape is an array of rings, a ring an array of [x, y] without the closing point.

What folds over one shape is native; true overlay runs in Arrow batches. Joins meet on grid cells first.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StringType

from parcelforge.functions import geo, overlay
from parcelforge.functions.geo import boxes_meet, cells, overlap_area
from parcelforge.operators.sequence import components

SHAPE = ArrayType(ArrayType(ArrayType(DoubleType())))


def _in(rings) -> overlay.Shape:
    return [np.array([[p[0], p[1]] for p in r], dtype=float).reshape(-1, 2) for r in (rings if rings is not None else [])]


def _out(shape: overlay.Shape) -> list:
    return [r.tolist() for r in shape]


PLACES = ArrayType(ArrayType(DoubleType()))
_PAIRS = pa.list_(pa.list_(pa.float64()))
_ARROW = {StringType(): pa.string(), DoubleType(): pa.float64(), BooleanType(): pa.bool_(), SHAPE: pa.list_(_PAIRS), PLACES: _PAIRS}


def _kernel(kernel: Callable, kind, *shapes: Column) -> Column:
    """The kernel on every row, null where a shape is null.

    Arrow lists are read value by value: their conversion to pandas ends the worker on batches that hold no point at all.
    """

    def each(*columns: pa.Array) -> pa.Array:
        rows = zip(*[c.to_pylist() for c in columns], strict=True)
        return pa.array([None if any(v is None for v in row) else kernel(*[_in(v) for v in row]) for row in rows], _ARROW[kind])

    if len(shapes) == 1:

        def one(a: pa.Array) -> pa.Array:
            return each(a)

        return F.arrow_udf(one, kind)(*shapes)

    def two(a: pa.Array, b: pa.Array) -> pa.Array:
        return each(a, b)

    return F.arrow_udf(two, kind)(*shapes)


def shared_area(a: Column, b: Column) -> Column:
    """Area of the intersection of any two shapes, holes and hollow forms included; null for null."""
    return _kernel(overlay.shared_area, DoubleType(), a, b)


def meets(a: Column, b: Column) -> Column:
    """Touching counts."""
    return _kernel(overlay.meets, BooleanType(), a, b)


def intersection(a: Column, b: Column) -> Column:
    return _kernel(lambda x, y: _out(overlay.intersection(x, y)), SHAPE, a, b)


def difference(a: Column, b: Column) -> Column:
    return _kernel(lambda x, y: _out(overlay.difference(x, y)), SHAPE, a, b)


def buffer(shape: Column, reach: float, corners: int = 32) -> Column:
    return _kernel(lambda x: _out(overlay.buffer(x, reach, corners)), SHAPE, shape)


def close_gaps(shape: Column, reach: float) -> Column:
    """Out and in again by ``reach``, holes filled."""
    return _kernel(lambda x: _out(overlay.without_holes(overlay.close_gaps(x, reach))), SHAPE, shape)


def sample_grid(shape: Column) -> Column:
    """Array of [x, y]: an interior point, then the points of a grid inset in the shape, 49 at most in all; null for null."""
    return _kernel(overlay.sample_grid, PLACES, shape)


def hull(shape: Column) -> Column:
    return _kernel(lambda x: [overlay.hull(np.vstack(x)).tolist()] if x else [], SHAPE, shape)


def is_valid(shape: Column) -> Column:
    """Every ring has three corners or more and does not touch itself; an empty shape is valid."""
    return _kernel(lambda x: all(overlay.is_valid(r) for r in x), BooleanType(), shape)


def validity_reason(shape: Column) -> Column:
    """``Valid Geometry`` or what is wrong; null for null."""
    return _kernel(overlay.validity_reason, StringType(), shape)


def is_empty(shape: Column) -> Column:
    """No ring has a point.  A shape of no area, as where two others touch, is not empty."""
    return F.size(F.flatten(shape)) == 0


def area(shape: Column) -> Column:
    """Enclosed area of rings that do not cross: each counts for or against by how many others hold a place on its first edge.

    Rings of one shape may touch in points; the place lies off the edge's ends and middle, where they would.
    """
    def ring(r: Column) -> Column:
        return F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))

    def boxed(r: Column) -> Column:
        side = lambda pick, at: pick(F.transform(r, lambda p: p[at]))
        return F.struct(ring(r).alias("r"), side(F.array_min, 0).alias("x0"), side(F.array_max, 0).alias("x1"), side(F.array_min, 1).alias("y0"), side(F.array_max, 1).alias("y1"))

    def signed(all_: Column, b: Column, i: Column) -> Column:
        p, q = F.get(b["r"], F.lit(0)), F.get(b["r"], F.lit(1))
        x, y = p["x"] + (q["x"] - p["x"]) * 0.381966, p["y"] + (q["y"] - p["y"]) * 0.381966
        # the rings' boxes are worked out once; of many rings few boxes hold the place
        within = F.size(F.filter(all_, lambda o, j: (i != j) & x.between(o["x0"], o["x1"]) & y.between(o["y0"], o["y1"]) & geo.covers(o["r"], x, y)))
        return geo.area(b["r"]) * F.when(within % 2 == 0, 1.0).otherwise(-1.0)

    many = F.array(F.transform(F.filter(shape, lambda r: F.size(r) > 1), boxed))
    several = F.get(F.transform(many, lambda all_: F.aggregate(F.transform(all_, lambda b, i: signed(all_, b, i)), F.lit(0.0), lambda s, v: s + v)), F.lit(0))
    return F.when(F.size(shape) == 1, geo.area(ring(F.get(shape, F.lit(0))))).otherwise(several)


def once_per_shape(rows: DataFrame, shape: str, made: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` with the columns that ``made`` adds to a table of the shapes alone: equal shapes are worked out once, and different ones are dealt over the tasks by their values.

    ``made`` gets the different shapes as the column ``shape`` and keeps it, one row each; null is one of them.  The rows meet the results by a merged join.
    """
    known = made(rows.select(shape).distinct())
    added = [F.col(c) for c in known.columns if c != shape]
    known = known.select(F.col(shape).alias("_shape"), *added)
    return rows.join(known.hint("merge"), F.col(shape).eqNullSafe(F.col("_shape")), "left").drop("_shape")


def envelope(shape: Column) -> Column:
    """struct(x0, y0, x1, y1); nulls for an empty shape."""
    points = F.flatten(shape)
    side = lambda pick, at: pick(F.transform(points, lambda p: p[at]))
    return F.struct(
        side(F.array_min, 0).alias("x0"), side(F.array_min, 1).alias("y0"), side(F.array_max, 0).alias("x1"), side(F.array_max, 1).alias("y1")
    )


def is_rectangle(shape: Column) -> Column:
    """One ring of four different corners, neighbours sharing exactly one coordinate: an upright rectangle."""
    ring = F.get(shape, F.lit(0))
    p = [F.get(ring, F.lit(i)) for i in range(4)]
    steps = [(p[i][0] == p[(i + 1) % 4][0]) != (p[i][1] == p[(i + 1) % 4][1]) for i in range(4)]
    across = (p[0][0] != p[2][0]) & (p[0][1] != p[2][1]) & (p[1][0] != p[3][0]) & (p[1][1] != p[3][1])
    return F.coalesce((F.size(shape) == 1) & (F.size(ring) == 4) & steps[0] & steps[1] & steps[2] & steps[3] & across, F.lit(False))


def make_envelope(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    corner = lambda x, y: F.array(x.cast("double"), y.cast("double"))
    return F.array(F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1)))


def centroid(ring: Column) -> Column:
    """Area-weighted centroid [x, y] of one ring, by one fold relative to its first point; the mean of its points if it has no area."""
    base = F.element_at(ring, 1)
    closed = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))

    def add(s: Column, e: Column) -> Column:
        px, py, qx, qy = e["p"][0] - base[0], e["p"][1] - base[1], e["q"][0] - base[0], e["q"][1] - base[1]
        k = px * qy - qx * py
        return F.struct((s["a"] + k).alias("a"), (s["x"] + (px + qx) * k).alias("x"), (s["y"] + (py + qy) * k).alias("y"))

    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    total = F.aggregate(F.arrays_zip(ring.alias("p"), closed.alias("q")), zero, add)
    mean = lambda i: F.aggregate(ring, F.lit(0.0), lambda s, p: s + p[i]) / F.size(ring)
    at = lambda i, n: F.when(total["a"] == 0, mean(i)).otherwise(base[i] + total[n] / (3 * F.nullif(total["a"], F.lit(0.0))))
    return F.array(at(0, "x"), at(1, "y"))


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.hypot(ax - bx, ay - by)


def transform(shape: Column, a: float, b: float, c: float, d: float, e: float, f: float) -> Column:
    """Affine map x' = ax + by + c, y' = dx + ey + f of every point."""
    return F.transform(shape, lambda r: F.transform(r, lambda p: F.array(a * p[0] + b * p[1] + c, d * p[0] + e * p[1] + f)))


def fit(source: tuple[float, float, float, float], target: tuple[float, float, float, float]) -> tuple[float, ...]:
    """Coefficients (a, b, c, d, e, f) for ``transform`` that lay a drawing's box (x0, y0 at the top, x1, y1) on a map's box (x0, y0, x1, y1 at the top): y turns over."""
    sx, sy = (target[2] - target[0]) / (source[2] - source[0]), (target[3] - target[1]) / (source[3] - source[1])
    return sx, 0.0, target[0] - source[0] * sx, 0.0, -sy, target[3] + source[1] * sy


def compose(first: tuple[float, ...], second: tuple[float, ...]) -> tuple[float, ...]:
    """The affine map that applies ``first``, then ``second``."""
    a, b, c, d, e, f = first
    p, q, r, s, t, u = second
    return p * a + q * d, p * b + q * e, p * c + q * f + r, s * a + t * d, s * b + t * e, s * c + t * f + u


def bounds(rows: DataFrame, shape: str) -> DataFrame:
    """(x0, y0, x1, y1): the box of all shapes."""
    box = envelope(F.col(shape))
    return rows.agg(F.min(box["x0"]).alias("x0"), F.min(box["y0"]).alias("y0"), F.max(box["x1"]).alias("x1"), F.max(box["y1"]).alias("y1"))


def filled_layer(drawings: DataFrame, keys: list[str], colours: dict[str, str], boundary: list, placed: tuple[float, ...], least: float) -> DataFrame:
    """(keys, code, shape, area): closed paths filled in a legend colour, placed on the map and clipped to the boundary, of ``least`` area or more.

    ``drawings`` (keys, fill, shape); ``colours`` gives the code of a fill; the boundary is one shape of a municipality and stands in the expression.
    """
    codes = F.create_map(*[F.lit(x) for pair in colours.items() for x in pair])
    rows = drawings.withColumn("code", F.element_at(codes, F.col("fill"))).where("code is not null")
    rim = F.lit(boundary).cast(SHAPE)
    rows = rows.withColumn("shape", intersection(transform(F.col("shape"), *placed), rim))
    rows = rows.withColumn("area", area(F.col("shape")))
    return rows.where(~is_empty(F.col("shape")) & (F.col("area") >= least)).select(*keys, "code", "shape", "area")


def line_layer(drawings: DataFrame, keys: list[str], widths: tuple[float, ...], boundary: list, placed: tuple[float, ...], least: float = 12.0, reach: float = 0.25) -> DataFrame:
    """(keys, part, line, length): black strokes of the given widths, placed on the map, clipped to the boundary, simplified by ``reach``, in parts of ``least`` length or more."""
    rim = [np.array(r, dtype=float) for r in boundary]
    a, b, c, d, e, f = placed
    kind = ArrayType(ArrayType(ArrayType(DoubleType())))

    def cut(lines: pa.Array) -> pa.Array:
        out = []
        for line in lines.to_pylist():
            if line is None or len(line) < 2:
                out.append([])
                continue
            p = np.array(line, dtype=float)
            p = np.stack([a * p[:, 0] + b * p[:, 1] + c, d * p[:, 0] + e * p[:, 1] + f], axis=1)
            parts = [overlay.simplify(x, reach) for x in overlay.clip_line(p, rim)]
            out.append([x.tolist() for x in parts])
        return pa.array(out, _ARROW[SHAPE])

    def kept(lines: pa.Array) -> pa.Array:
        return cut(lines)

    rows = drawings.where((F.col("colour") == "#000000") & F.round("width", 3).isin(*widths))
    rows = rows.select(*keys, F.posexplode(F.arrow_udf(kept, kind)(F.col("line"))).alias("part", "line"))
    steps = F.transform(F.sequence(F.lit(1), F.size("line") - 1), lambda i: F.hypot(F.get("line", i)[0] - F.get("line", i - 1)[0], F.get("line", i)[1] - F.get("line", i - 1)[1]))
    rows = rows.where(F.size("line") >= 2).withColumn("length", F.aggregate(steps, F.lit(0.0), lambda s, v: s + v))
    return rows.where(F.col("length") >= least)


def diagonal_pairs(parcels: DataFrame, size: float, group: str | None = None) -> DataFrame:
    """(a, b) of triangles (parcel_id, shape) that a diagonal has split: each pair met once, in the cell of the shared box's lower-left corner; ``group`` names a column that must agree.

    Both sides are merged: the size that Spark expects of exploded shapes is far below their own, and a broadcast would be built on the driver.
    """
    ring = F.get("shape", F.lit(0))
    three = parcels.where((F.size("shape") == 1) & (F.size(ring) == 3))
    at = [[F.get(F.get(ring, F.lit(i)), F.lit(j)) for i in range(3)] for j in range(2)]
    box = F.struct(F.least(*at[0]).alias("x0"), F.least(*at[1]).alias("y0"), F.greatest(*at[0]).alias("x1"), F.greatest(*at[1]).alias("y1"))
    boxed = three.select("parcel_id", *[group] * bool(group), F.array(*[v for p in zip(*at, strict=True) for v in p]).alias("places"), box.alias("box"))
    side = lambda p: boxed.select(F.col("parcel_id").alias(p), *([group] if group else []), F.col("places").alias(f"{p}_places"), F.col("box").alias(f"{p}_box"), F.explode(cells(F.col("box"), size)).alias("cell"))
    first = [F.floor(F.greatest(F.col(f"a_box.{c}"), F.col(f"b_box.{c}")) / size) for c in ("x0", "y0")]
    met = side("a").join(side("b").hint("merge"), ["cell", *([group] if group else [])])
    met = met.where((F.col("a") < F.col("b")) & boxes_meet(F.col("a_box"), F.col("b_box")) & (first[0] == F.col("cell.i")) & (first[1] == F.col("cell.j")))

    def split(one: pa.Array, two: pa.Array) -> pa.Array:
        a, b = (x.flatten().to_numpy(zero_copy_only=False).reshape(-1, 3, 2) for x in (one, two))
        return pa.array(overlay.split_by_diagonals(a, b), pa.bool_())

    return met.withColumn("_split", F.arrow_udf(split, BooleanType())(F.col("a_places"), F.col("b_places"))).where("_split").select("a", "b")


def merge_diagonals(parcels: DataFrame, size: float, most_parts: int = 4, most: float = 1.10) -> DataFrame:
    """(parcel_id, source_ids, shape): parcels after split triangles are joined, where 2 to ``most_parts`` of them make one nearly convex outline; others stay as they are."""
    pairs = diagonal_pairs(parcels, size)
    groups = components(pairs)
    sized = groups.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(f"n <= {most_parts}").select("component")
    members = groups.join(sized.hint("merge"), "component").withColumnRenamed("node", "parcel_id").hint("merge").join(parcels.select("parcel_id", "shape"), "parcel_id")
    few = members.groupBy("component").agg(F.array_sort(F.collect_list(F.struct("parcel_id", "shape"))).alias("m"))  # at most ``most_parts`` of them

    def join(shapes: pa.Array) -> pa.Array:
        groups = [[_in(s) for s in parts] for parts in shapes.to_pylist()]
        known: dict[int, overlay.Shape] = {}
        halves = [i for i, g in enumerate(groups) if len(g) == 2 and all(len(s) == 1 and len(s[0]) == 3 for s in g)]
        if halves:
            rings, sure = overlay.union_of_halves(*(np.stack([groups[i][k][0] for i in halves]) for k in (0, 1)))
            known = {i: [ring] for i, ring, yes in zip(halves, rings, sure.tolist(), strict=True) if yes and most >= 1 + 1e-6}
        out = []
        for i, parts in enumerate(groups):
            whole = known.get(i) or overlay.union(parts)
            out.append(_out(whole) if i in known or len(whole) == 1 and overlay.hull_ratio(whole) <= most else None)
        return pa.array(out, _ARROW[SHAPE])

    def merged_shape(shapes: pa.Array) -> pa.Array:
        return join(shapes)

    made = few.withColumn("shape", F.arrow_udf(merged_shape, SHAPE)(F.transform("m", lambda x: x["shape"]))).where("shape IS NOT NULL")
    merged = made.select(F.get("m", F.lit(0))["parcel_id"].alias("parcel_id"), F.transform("m", lambda x: x["parcel_id"]).alias("source_ids"), "shape")
    used = merged.select(F.explode("source_ids").alias("parcel_id"))
    rest = parcels.join(used.hint("merge"), "parcel_id", "left_anti").select("parcel_id", F.array("parcel_id").alias("source_ids"), "shape")
    return merged.unionByName(rest)


def geojson(shape: Column, digits: int = 9) -> Column:
    """Polygon geometry as JSON text, rings closed; null for null."""
    closed = F.transform(shape, lambda r: F.transform(F.concat(r, F.slice(r, 1, 1)), lambda p: F.transform(p, lambda v: F.round(v, digits))))
    return F.when(shape.isNotNull(), F.to_json(F.struct(F.lit("Polygon").alias("type"), closed.alias("coordinates"))))


def overlaps(parcels: DataFrame, zones: DataFrame, size: float, digits: int | None = None) -> DataFrame:
    """(parcel_id, zone_id, shared) of all parcels and zones (id, shape) that meet; pairs that only touch have shared 0.  ``digits`` rounds the area, once for each pair of lists.

    Equal shapes are compared as lists of ids (``id_lists``); pairs of lists are dealt evenly over all tasks and expanded there, so no task's share hangs on how the tables were stored.
    """
    left, right = id_lists(parcels.withColumnRenamed("shape", "a"), "parcel_id", "a"), id_lists(zones.withColumnRenamed("shape", "b"), "zone_id", "b")
    met = shape_overlaps(left, right.hint("merge"), size, ("parcel_id", "zone_id"))
    if digits is not None:
        met = met.withColumn("shared", F.round("shared", digits))
    tasks = int(parcels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the number is given: by their bytes, adaptive execution would put the lists into a few tasks, whatever they expand to
    return met.repartition(tasks).withColumn("zone_id", F.explode("zone_id")).withColumn("parcel_id", F.explode("parcel_id")).select("parcel_id", "zone_id", "shared")


def id_lists(rows: DataFrame, key: str, shape: str, most: int = 256, parts: int = 16) -> DataFrame:
    """(key, shape): the ids of equal shapes as lists in the column ``key``, of about ``most`` where they have more; a null id is kept.

    Lists stay short because Spark holds all that one row expands to.  Shapes of many ids are few: only they are looked up, and each of them is dealt over ``parts``.
    """
    many = rows.groupBy(F.col(shape).alias("_shape")).agg(F.count(F.lit(1)).alias("_n")).where(f"_n > {most}").withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    own = F.xxhash64(key)
    dealt = rows.select(key, shape, F.pmod(own, F.lit(parts)).cast("int").alias("_own"))
    dealt = dealt.join(many.hint("merge"), (F.col(shape) == F.col("_shape")) & (F.col("_own") == F.col("_part")), "left")
    at = F.when(F.col("_n").isNull(), F.lit(0)).otherwise(F.pmod(own, F.ceil(F.col("_n") / most)))
    return dealt.groupBy(shape, at.alias("_list")).agg(F.transform(F.collect_list(F.struct(key)), lambda x: x[key]).alias(key)).drop("_list")


def shape_overlaps(left: DataFrame, right: DataFrame, size: float, names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """(names, shared) of all shapes ``a`` and ``b`` of two tables, each row for itself, that meet.

    A pair meets in several cells and is kept in that of the lower-left corner of the shared box, so no distinct is needed.
    """
    def side(rows: DataFrame, key: str, name: str) -> DataFrame:
        boxed = rows.select(*{key: 0, name: 0}, envelope(F.col(name)).alias(f"{name}_box"), is_rectangle(F.col(name)).alias(f"{name}_plain")).where(f"{name}_box.x0 IS NOT NULL")
        return boxed.withColumn("cell", F.explode(cells(F.col(f"{name}_box"), size)))

    a, b = side(left, names[0], "a"), side(right, names[1], "b")
    first = [F.floor(F.greatest(f"a_box.{c}", f"b_box.{c}") / size) for c in ("x0", "y0")]

    def met(one: DataFrame, two: DataFrame) -> DataFrame:
        return one.join(two, "cell").where(boxes_meet(F.col("a_box"), F.col("b_box")) & (first[0] == F.col("cell.i")) & (first[1] == F.col("cell.j")))

    def kernel(x: overlay.Shape, y: overlay.Shape) -> float | None:
        return overlay.shared_area(x, y) or (0.0 if overlay.meets(x, y) else None)

    # upright rectangles share what their boxes share: those pairs stay in the JVM
    plain = met(a.where("a_plain"), b.where("b_plain")).withColumn("shared", overlap_area(F.col("a_box"), F.col("b_box")))
    others = [met(a.where("NOT a_plain"), b), met(a.where("a_plain"), b.where("NOT b_plain"))]
    out = plain.select(*names, "shared")
    for pairs in others:
        scored = pairs.withColumn("shared", _kernel(kernel, DoubleType(), F.col("a"), F.col("b")))
        out = out.unionByName(scored.where("shared IS NOT NULL").select(*names, "shared"))
    return out


def dissolve(rows: DataFrame, key: str, size: float, levels: int = 3) -> DataFrame:
    """(key, shape): the union of all shapes of each key, merged in cells that grow eightfold, so that only outlines travel upwards.

    Null and empty shapes add nothing; a key with no others has no row.  Equal shapes are one from the start, and only shapes whose boxes meet are compared,
    so a key of many parts that stand apart costs what its parts cost.
    """
    kind = rows.schema[key].dataType.simpleString()
    now = rows.where(F.size(F.flatten("shape")) > 0).select(key, "shape").distinct()
    for level in range(1, levels + 1):
        box = envelope(F.col("shape"))
        cell = [F.floor(box[c] / (size * 8**level)) if level < levels else F.lit(0).cast("long") for c in ("x0", "y0")]

        def merge(level: int) -> Callable[[pa.Table], pa.Table]:
            def one(group: pa.Table) -> pa.Table:
                whole = overlay.union([_in(s) for s in group.column("shape").to_pylist()], level > 1)
                return pa.table({key: group.column(key).slice(0, 1), "shape": pa.array([_out(whole)], _ARROW[SHAPE])})

            return one

        now = now.select(key, "shape", cell[0].alias("_i"), cell[1].alias("_j")).groupBy(key, "_i", "_j").applyInArrow(merge(level), f"{key} {kind}, shape array<array<array<double>>>")
    return now


def polygonize(lines: DataFrame, part: str, least: float = 50.0) -> DataFrame:
    """(part, face, shape) of the bounded faces, of ``least`` area, that the segments (x0, y0, x1, y1) of each part enclose; a part is one map sheet."""
    kind = lines.schema[part].dataType.simpleString()

    def one(group: pd.DataFrame) -> pd.DataFrame:
        found = sorted(overlay.faces(group[["x0", "y0", "x1", "y1"]].to_numpy(float), least), key=lambda r: r.min(axis=0).tolist())
        return pd.DataFrame({part: [group[part].iloc[0]] * len(found), "face": range(len(found)), "shape": [[r.tolist()] for r in found]})

    return lines.select(part, "x0", "y0", "x1", "y1").groupBy(part).applyInPandas(one, f"{part} {kind}, face long, shape array<array<array<double>>>")
