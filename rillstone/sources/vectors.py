"""Vector layers as Spark data sources: shapefiles (.shp with .dbf and .shx) and GeoPackages, also inside zip files.

    spark.dataSource.register(Shapefile); spark.read.format("shapefile").load("basin.shp")
    spark.dataSource.register(GeoPackage); spark.read.format("geopackage").option("layer", "lines").load("outer.zip")

Geometry comes as WKB, longitude first. A shapefile is read in ranges of records by its index; a GeoPackage, an SQLite file,
is opened in each task's memory and read in ranges of rows.
"""

from __future__ import annotations

import io
import re
import sqlite3
import struct
import zipfile

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from rillstone.functions import wkb
from rillstone.sources.arrow_ipc import _filesystem

RECORDS = 20_000


class BadLayer(ValueError):
    pass


class Span(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


def _spans(n: int, size: int) -> list[Span]:
    return [Span(k, min(k + size, n)) for k in range(0, n, size)] or [Span(0, 0)]


# ---- shapefiles -------------------------------------------------------------------------------------------------------


def is_geographic(prj: str) -> bool:
    """Whether a .prj text names WGS 84 in degrees."""
    flat = re.sub(r"[\s_]", "", prj).upper()
    return flat.startswith("GEOGCS") and ("WGS1984" in flat or "WGS84" in flat)


def shape_wkb(raw: bytes) -> bytes | None:
    """WKB of one record's content: points, lines (one part a LineString, several a MultiLineString) and polygons, whose
    clockwise rings are outer ones; holes go with the outer ring that contains their first vertex. Z and M are dropped."""
    kind = struct.unpack_from("<i", raw)[0] % 10
    if kind == 0:
        return None
    if kind == 1:
        return wkb.point(*struct.unpack_from("<dd", raw, 4))
    if kind not in (3, 5, 8):
        raise BadLayer(f"shape of kind {kind}")
    if kind == 8:
        n = struct.unpack_from("<i", raw, 36)[0]
        pts = np.frombuffer(raw, "<f8", 2 * n, 40).reshape(-1, 2)
        return struct.pack("<BII", 1, wkb.MULTIPOINT, n) + b"".join(wkb.point(x, y) for x, y in pts.tolist())
    parts, n = struct.unpack_from("<ii", raw, 36)
    starts = [*struct.unpack_from(f"<{parts}i", raw, 44), n]
    xy = np.frombuffer(raw, "<f8", 2 * n, 44 + 4 * parts).reshape(-1, 2)
    lines = [xy[a:b] for a, b in zip(starts, starts[1:])]
    if kind == 3:
        one = [wkb.linestring(x) for x in lines]
        return one[0] if len(one) == 1 else struct.pack("<BII", 1, wkb.MULTILINESTRING, len(one)) + b"".join(one)
    turn = [float((r[:-1, 0] * r[1:, 1] - r[1:, 0] * r[:-1, 1]).sum()) for r in lines]
    outer = [[r] for r, t in zip(lines, turn) if t <= 0]
    for hole in (r for r, t in zip(lines, turn) if t > 0):
        mine = [o for o in outer if wkb.Edges([[o[0]]]).contain(np.zeros(1, int), hole[:1, 0], hole[:1, 1])[0]]
        (mine[-1] if mine else outer[-1]).append(hole) if outer else outer.append([hole])
    one = [wkb.polygon(o) for o in outer]
    return one[0] if len(one) == 1 else struct.pack("<BII", 1, wkb.MULTIPOLYGON, len(one)) + b"".join(one)


def _columns(head: bytes) -> tuple[list[tuple[str, str, int, int]], int, int, int]:
    """((name, type, start, length) of each field, number of records, length of the header, of a record) of a .dbf file."""
    n, first, size = struct.unpack_from("<IHH", head, 4)
    out, at, start = [], 32, 1
    while head[at] != 13:
        name = head[at : at + 11].split(b"\0")[0].decode("latin-1").strip()
        letter, length, decimals = chr(head[at + 11]), head[at + 16], head[at + 17]
        kind = {"N": "double" if decimals else "bigint", "F": "double", "L": "boolean"}.get(letter, "string")
        out.append((name, "double" if kind == "bigint" and length > 18 else kind, start, length))
        at, start = at + 32, start + length
    return out, n, first, size


def _value(raw: bytes, kind: str, code: str):
    text = raw.decode(code, "replace").strip().strip("\0")
    if kind == "string":
        return text or None
    if kind == "boolean":
        return True if text in "YyTt" and text else False if text in "NnFf" and text else None
    try:
        return float(text) if kind == "double" else int(float(text))
    except (ValueError, OverflowError):
        return None


class ShapefileReader(DataSourceReader):
    def __init__(self, path: str, code: str):
        self.base, self.code = path.removesuffix(".shp"), code

    def partitions(self):
        fs, p = _filesystem(self.base + ".shx")
        return _spans((fs.get_file_info(p).size - 100) // 8, RECORDS)

    def read(self, part):
        n = part.last - part.first
        if not n:
            return
        read = {}
        for end in (".shx", ".shp", ".dbf"):
            fs, p = _filesystem(self.base + end)
            read[end] = fs.open_input_file(p)
        try:
            index = struct.unpack(f">{2 * n}i", read[".shx"].read_at(8 * n, 100 + 8 * part.first))
            fields, _, first, size = _columns(read[".dbf"].read_at(32 * 257, 0))
            rows = read[".dbf"].read_at(n * size, first + part.first * size)
            lo, hi = 2 * min(index[::2]), max(2 * (a + b) + 8 for a, b in zip(index[::2], index[1::2]))
            shapes = read[".shp"].read_at(hi - lo, lo)
            for k in range(n):
                record = rows[k * size : (k + 1) * size]
                if record[:1] == b"*":  # deleted
                    continue
                at = 2 * index[2 * k] - lo + 8
                yield (*(_value(record[s : s + w], t, self.code) for _, t, s, w in fields), shape_wkb(shapes[at : at + 2 * index[2 * k + 1]]))
        finally:
            for f in read.values():
                f.close()


class Shapefile(DataSource):
    """Columns of the .dbf file and geometry. Options: encoding of texts (latin-1); require_wgs84 (true): an error where there
    is a .prj file of another system."""

    @classmethod
    def name(cls):
        return "shapefile"

    def schema(self):
        base = self.options["path"].removesuffix(".shp")
        fs, p = _filesystem(base + ".prj")
        if self.options.get("require_wgs84", "true") == "true" and fs.get_file_info(p).is_file:
            with fs.open_input_file(p) as f:
                if not is_geographic(f.read().decode("latin-1")):
                    raise BadLayer("the layer is not in longitude and latitude of WGS 84")
        with fs.open_input_file(_filesystem(base + ".dbf")[1]) as f:
            fields = _columns(f.read_at(32 * 257, 0))[0]
        return ", ".join([*(f"`{n}` {t}" for n, t, _, _ in fields), "geometry binary"])

    def reader(self, schema):
        return ShapefileReader(self.options["path"], self.options.get("encoding", "latin-1"))


# ---- geopackages -------------------------------------------------------------------------------------------------------


def package_bytes(path: str) -> bytes:
    """A GeoPackage's bytes; of zip files, also one in another, the one .gpkg they hold."""
    fs, p = _filesystem(path)
    with fs.open_input_file(p) as f:
        raw = f.read()
    while raw[:4] == b"PK\3\4":
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            inner = [n for n in z.namelist() if n.lower().endswith(".gpkg")] or [n for n in z.namelist() if n.lower().endswith(".zip")]
            if len(inner) != 1:
                raise BadLayer(f"{len(inner)} packages in {path} instead of one")
            raw = z.read(inner[0])
    return raw


def _connect(raw: bytes) -> sqlite3.Connection:
    con = sqlite3.connect(":memory:")
    con.deserialize(raw)
    return con


def blob_wkb(blob: bytes | None) -> bytes | None:
    """WKB behind the header of a GeoPackage geometry; None for null and empty ones."""
    if blob is None or blob[:2] != b"GP" or len(blob) < 8 or blob[3] >> 4 & 1:
        return None
    return blob[8 + {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}.get(blob[3] >> 1 & 7, 0) :]


def _layer(con: sqlite3.Connection, wanted: str | None) -> tuple[str, str, int]:
    layers = con.execute("select table_name, column_name, srs_id from gpkg_geometry_columns").fetchall()
    mine = [x for x in layers if wanted in (None, x[0])]
    if len(mine) != 1:
        raise BadLayer(f"{len(mine)} layers instead of one; there are {', '.join(sorted(x[0] for x in layers))}")
    return mine[0]


_SQLITE = {"INT": "bigint", "INTEGER": "bigint", "MEDIUMINT": "bigint", "SMALLINT": "bigint", "TINYINT": "bigint", "REAL": "double", "DOUBLE": "double", "FLOAT": "double", "BOOLEAN": "boolean", "BLOB": "binary"}


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class GeoPackageReader(DataSourceReader):
    def __init__(self, path: str, layer: str | None, fields: list[tuple[str, str]]):
        self.path, self.layer, self.fields = path, layer, fields

    def partitions(self):
        con = _connect(package_bytes(self.path))
        name, _, _ = _layer(con, self.layer)
        return _spans((con.execute(f"select max(rowid) from {_quoted(name)}").fetchone()[0] or -1) + 1, 10 * RECORDS)

    def read(self, part):
        con = _connect(package_bytes(self.path))
        name, geometry, _ = _layer(con, self.layer)
        cols = [n for n, _ in self.fields]
        for row in con.execute(f"select {', '.join(map(_quoted, [*cols, geometry]))} from {_quoted(name)} where rowid >= ? and rowid < ? order by rowid", (part.first, part.last)):
            yield (*(v if v is None else bool(v) if t == "boolean" else float(v) if t == "double" else v for v, (_, t) in zip(row, self.fields)), blob_wkb(row[-1]))


class GeoPackage(DataSource):
    """Columns of one layer and geometry. Options: layer (where there are several); require_wgs84 (true)."""

    @classmethod
    def name(cls):
        return "geopackage"

    def _described(self) -> list[tuple[str, str]]:
        con = _connect(package_bytes(self.options["path"]))
        name, geometry, system = _layer(con, self.options.get("layer"))
        if self.options.get("require_wgs84", "true") == "true" and system not in (4326, 0, -1):
            raise BadLayer(f"the layer is in system {system}, not EPSG:4326")
        return [(c[1], _SQLITE.get(c[2].upper().split("(")[0], "string")) for c in con.execute(f"pragma table_info({_quoted(name)})") if c[1] != geometry]

    def schema(self):
        return ", ".join([*(f"`{n}` {t}" for n, t in self._described()), "geometry binary"])

    def reader(self, schema):
        return GeoPackageReader(self.options["path"], self.options.get("layer"), self._described())
