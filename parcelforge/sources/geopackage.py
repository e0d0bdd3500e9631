"""GeoPackage layers as a Spark data source (the format is an SQLite file; the standard library reads it).

``spark.dataSource.register(GeoPackage)``, then ``spark.read.format("geopackage").option("layer", name).load(path)``. The file
must lie where every executor can open it. Rows are split by ranges of row ids, so a layer is read in parallel.

``df.write.format("geopackage").option("layer", name).mode("append").save(folder)`` writes one file per task; a folder of such files is read as
one layer. A file counts once the job is committed: until then it has another name, so lost and repeated tasks leave no rows.
"""

from __future__ import annotations

import os
import sqlite3
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from parcelforge.functions import overlay

_TYPES = (("INT", "long"), ("REAL", "double"), ("DOUBLE", "double"), ("FLOAT", "double"), ("BOOL", "long"), ("BLOB", "binary"))


def _connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path.removeprefix('file:').replace('//', '/')}?mode=ro", uri=True)


def _files(path: str) -> list[str]:
    """The file, or the committed files of a folder."""
    plain = path.removeprefix("file:").replace("//", "/")
    if not os.path.isdir(plain):
        return [plain]
    return sorted(os.path.join(plain, f) for f in os.listdir(plain) if f.endswith(".gpkg"))


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def rings_of(blob: bytes | None) -> list[list[list[float]]] | None:
    """All rings of a stored polygon or multipolygon without their closing points, a line's or point's coordinates as one ring."""
    if blob is None:
        return None
    at = 0
    if blob[:2] == b"GP":
        at = 8 + (0, 32, 48, 48, 64)[blob[3] >> 1 & 7]
    rings: list[list[list[float]]] = []

    def points(n: int, order: str, size: int, start: int) -> tuple[list[list[float]], int]:
        flat = struct.unpack_from(f"{order}{n * size}d", blob, start)
        return [[flat[i], flat[i + 1]] for i in range(0, n * size, size)], start + 8 * n * size

    def read(start: int) -> int:
        order = "<" if blob[start] else ">"
        code = struct.unpack_from(f"{order}I", blob, start + 1)[0]
        kind, dims, start = code % 1000 & 0xFF, 2 + (0, 1, 1, 2)[code // 1000 % 4], start + 5
        if kind == 1:
            ring, start = points(1, order, dims, start)
            rings.append(ring)
            return start
        n = struct.unpack_from(f"{order}I", blob, start)[0]
        start += 4
        if kind == 2:
            ring, start = points(n, order, dims, start)
            rings.append(ring)
        elif kind == 3:
            for _ in range(n):
                size = struct.unpack_from(f"{order}I", blob, start)[0]
                ring, start = points(size, order, dims, start + 4)
                rings.append(ring[:-1] if len(ring) > 1 and ring[0] == ring[-1] else ring)
        else:
            for _ in range(n):
                start = read(start)
        return start

    if at < len(blob):
        read(at)
    return rings


def blob_of(rings: list[list[list[float]]] | None, srid: int) -> bytes | None:
    """A stored multipolygon of the rings; a ring within an odd number of others is a hole of the smallest ring that holds it."""
    if rings is None:
        return None
    shape = [np.array(r, dtype=float).reshape(-1, 2) for r in rings]
    held = [[j for j, o in enumerate(shape) if j != i and overlay.inside([o], r[:1])[0]] for i, r in enumerate(shape)]
    sizes = [overlay.area([r]) for r in shape]
    parts = {i: [r] for i, r in enumerate(shape) if len(held[i]) % 2 == 0}
    for i, r in enumerate(shape):
        if i not in parts:
            parts[min((j for j in held[i] if j in parts), key=sizes.__getitem__)].append(r)

    def ring(r: np.ndarray) -> bytes:
        closed = np.vstack([r, r[:1]])
        return struct.pack("<I", len(closed)) + closed.astype("<f8").tobytes()

    body = b"".join(struct.pack("<BII", 1, 3, len(p)) + b"".join(map(ring, p)) for p in parts.values())
    return b"GP\x00" + struct.pack("<Bi", 1 if parts else 17, srid) + struct.pack("<BII", 1, 6, len(parts)) + body


class _Rows(InputPartition):
    def __init__(self, file: str, low: int, high: int) -> None:
        self.file, self.low, self.high = file, low, high


class _Reader(DataSourceReader):
    def __init__(self, path: str, layer: str, columns: list[str], geometry: str | None, size: int) -> None:
        self.path, self.layer, self.columns, self.geometry, self.size = path, layer, columns, geometry, size

    def partitions(self) -> list[_Rows]:
        parts = []
        for file in _files(self.path):
            with _connect(file) as con:
                low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.layer)}").fetchone()
            if low is not None:
                parts += [_Rows(file, i, min(i + self.size, high + 1)) for i in range(low, high + 1, self.size)]
        return parts

    def read(self, part: _Rows) -> Iterator[tuple]:
        con = _connect(part.file)
        names = ", ".join(_quoted(c) for c in self.columns)
        for row in con.execute(f"SELECT {names} FROM {_quoted(self.layer)} WHERE rowid >= ? AND rowid < ?", (part.low, part.high)):
            yield tuple(rings_of(v) if c == self.geometry else v for c, v in zip(self.columns, row, strict=True))
        con.close()


@dataclass
class _Written(WriterCommitMessage):
    file: str


class _Writer(DataSourceWriter):
    def __init__(self, folder: str, layer: str, columns: list[tuple[str, str]], geometry: str, srid: int, overwrite: bool) -> None:
        self.folder, self.layer, self.columns, self.geometry, self.srid, self.overwrite = folder, layer, columns, geometry, srid, overwrite

    def write(self, iterator: Iterator) -> _Written:
        os.makedirs(self.folder, exist_ok=True)
        file = os.path.join(self.folder, f"part-{uuid.uuid4().hex}.writing")
        con = sqlite3.connect(file)
        con.executescript(
            "PRAGMA application_id = 1196444487; PRAGMA user_version = 10300;"
            "CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, "
            "organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);"
            "CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, srs_id INTEGER);"
            "CREATE TABLE gpkg_geometry_columns (table_name TEXT PRIMARY KEY, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, "
            "srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL);"
        )
        kinds = ", ".join(f"{_quoted(n)} {'MULTIPOLYGON' if n == self.geometry else k}" for n, k in self.columns)
        con.execute(f"CREATE TABLE {_quoted(self.layer)} ({kinds})")
        con.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined', NULL)", (f"EPSG:{self.srid}", self.srid, self.srid))
        con.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, ?)", (self.layer, self.layer, self.srid))
        con.execute("INSERT INTO gpkg_geometry_columns VALUES (?, ?, 'MULTIPOLYGON', ?, 0, 0)", (self.layer, self.geometry, self.srid))
        marks = ", ".join("?" * len(self.columns))
        rows = ([blob_of(v, self.srid) if n == self.geometry else v for (n, _), v in zip(self.columns, row, strict=True)] for row in iterator)
        con.executemany(f"INSERT INTO {_quoted(self.layer)} VALUES ({marks})", rows)
        con.commit()
        con.close()
        return _Written(file)

    def commit(self, messages: list) -> None:
        old = _files(self.folder) if self.overwrite and os.path.isdir(self.folder) else []
        for m in messages:
            if m is not None:
                os.rename(m.file, m.file.removesuffix(".writing") + ".gpkg")
        for file in old:
            os.remove(file)

    def abort(self, messages: list) -> None:
        for m in messages:
            if m is not None and os.path.exists(m.file):
                os.remove(m.file)


class GeoPackage(DataSource):
    """Options: path, layer (default: the first feature layer), rows (rows a partition, 50,000).

    For writing: a folder as path, layer (``features``), geometry (the column of rings, ``geom``), srid (2954).
    """

    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def _layer(self, con: sqlite3.Connection) -> str:
        named = self.options.get("layer")
        if named:
            return named
        found = con.execute("SELECT table_name FROM gpkg_contents WHERE data_type = 'features' ORDER BY table_name LIMIT 1").fetchone()
        if found is None:
            raise ValueError("the file has no feature layer")
        return found[0]

    def _columns(self) -> tuple[str, list[tuple[str, str]], str | None]:
        files = _files(self.options["path"])
        if not files:
            raise ValueError("the folder has no committed file")
        with _connect(files[0]) as con:
            layer = self._layer(con)
            shape = con.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", (layer,)).fetchone()
            geometry = shape[0] if shape else None
            columns = []
            for _, name, kind, *_ in con.execute(f"PRAGMA table_info({_quoted(layer)})"):
                plain = next((t for word, t in _TYPES if word in kind.upper()), "string")
                columns.append((name, "array<array<array<double>>>" if name == geometry else plain))
        return layer, columns, geometry

    def schema(self) -> str:
        return ", ".join(f"`{n}` {t}" for n, t in self._columns()[1])

    def reader(self, schema) -> _Reader:
        layer, columns, geometry = self._columns()
        return _Reader(self.options["path"], layer, [n for n, _ in columns], geometry, int(self.options.get("rows", "50000")))

    def writer(self, schema, overwrite: bool) -> _Writer:
        geometry = self.options.get("geometry", "geom")
        if geometry not in schema.fieldNames():
            raise ValueError(f"no column {geometry}")
        sql = {"long": "INTEGER", "bigint": "INTEGER", "int": "INTEGER", "boolean": "BOOLEAN", "double": "REAL", "float": "REAL", "binary": "BLOB"}
        columns = [(f.name, sql.get(f.dataType.simpleString(), "TEXT")) for f in schema.fields]
        folder = self.options["path"].removeprefix("file:").replace("//", "/")
        return _Writer(folder, self.options.get("layer", "features"), columns, geometry, int(self.options.get("srid", "2954")), overwrite)
