"""GeoTIFF in plain Python: tags, geotransform and coordinate system by ranges of bytes; tiles as a Spark data source; a
cloud-optimised writer for tables of tiles, and a small one for arrays. Compressed data: none or deflate."""

from __future__ import annotations

import struct
import uuid
import zlib
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from rillstone.sources.arrow_ipc import _filesystem

META = "path string, label string, width long, height long, bits int, sample_format string, is_tiled boolean, tile_w int, tile_h int, nodata double, crs string, minx double, miny double, maxx double, maxy double, pixel_w double, pixel_h double, n_images int, problem string"
#: Bytes of each TIFF field type, its struct letter, and the names of sample formats.
_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 16: 8, 17: 8, 18: 8}
_CODE = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q", 18: "Q"}
_FORMAT = {1: "uint", 2: "int", 3: "float", 4: "void"}


class BadTiff(ValueError):
    pass


class _Held:
    """Bytes in memory, read like a file."""

    def __init__(self, raw: bytes):
        self.raw = raw

    def read_at(self, n: int, at: int) -> bytes:
        return self.raw[at : at + n]


def _source(f):
    return _Held(f) if isinstance(f, (bytes, bytearray)) else f


def _take(f, n: int, at: int) -> bytes:
    raw = f.read_at(n, at)
    if len(raw) < n:
        raise BadTiff("truncated file")
    return bytes(raw)


def _directory(f, at: int, end: str, big: bool, places: bool) -> tuple[dict, int]:
    """Tags of one image and where the next one's are. Where tiles lie (two numbers each) is read only if asked for."""
    n = struct.unpack(end + ("Q" if big else "H"), _take(f, 8 if big else 2, at))[0]
    if n > 4096:
        raise BadTiff("too many tags")
    at += 8 if big else 2
    size, inline, word = (20, 12, "Q") if big else (12, 8, "I")
    raw = _take(f, n * size + (8 if big else 4), at)
    tags = {}
    for k in range(n):
        tag, kind = struct.unpack_from(end + "HH", raw, k * size)
        count = struct.unpack_from(end + word, raw, k * size + 4)[0]
        need = _SIZE.get(kind, 1) * count
        field = raw[k * size + inline : (k + 1) * size]
        if tag in (273, 279, 324, 325) and not places:
            continue
        if kind not in (2, 7) and kind not in _CODE:
            continue
        value = field[:need] if need <= len(field) else _take(f, need, struct.unpack(end + word, field)[0])
        tags[tag] = value if kind in (2, 7) else struct.unpack(f"{end}{count}{_CODE[kind]}", value)
    return tags, struct.unpack_from(end + word, raw, n * size)[0]


def directories(f, places: bool = True) -> tuple[list[dict], str]:
    """The tags of each image (overviews follow the first), and the byte order. f: bytes, or an open file of which only the
    tags are read."""
    f = _source(f)
    start = bytes(f.read_at(16, 0))
    if start[:4] not in (b"II*\0", b"MM\0*", b"II+\0", b"MM\0+"):
        raise BadTiff("not a TIFF file")
    end, big = ("<" if start[:2] == b"II" else ">"), start[2:4] in (b"+\0", b"\0+")
    if len(start) < (16 if big else 8):
        raise BadTiff("truncated header")
    at = struct.unpack_from(end + ("Q" if big else "I"), start, 8 if big else 4)[0]
    out, seen = [], set()
    while at and at not in seen and len(out) < 64:
        seen.add(at)
        tags, at = _directory(f, at, end, big, places)
        out.append(tags)
    if not out:
        raise BadTiff("no image")
    return out, end


def transform(tags: dict) -> tuple[float, ...] | None:
    """(x0, dx, rx, y0, ry, dy): x = x0 + column * dx + row * rx, y = y0 + column * ry + row * dy."""
    if 34264 in tags:
        m = tags[34264]
        return m[3], m[0], m[1], m[7], m[4], m[5]
    if 33550 in tags and 33922 in tags:
        (sx, sy, *_), (i, j, _, x, y, *_) = tags[33550], tags[33922]
        return x - i * sx, sx, 0.0, y + j * sy, 0.0, -sy
    return None


def extent(t: tuple[float, ...], width: int, height: int) -> tuple[float, float, float, float]:
    """Box over the four corners; right also for rotated rasters."""
    xs = [t[0] + c * t[1] + r * t[2] for c in (0, width) for r in (0, height)]
    ys = [t[3] + c * t[4] + r * t[5] for c in (0, width) for r in (0, height)]
    return min(xs), min(ys), max(xs), max(ys)


def crs(tags: dict) -> str | None:
    keys = tags.get(34735, ())
    found = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    code = found.get(3072) or found.get(2048)
    return f"EPSG:{code}" if code and code != 32767 else None


@dataclass
class Header:
    width: int
    height: int
    bits: int
    sample_format: str
    is_tiled: bool
    tile_w: int | None
    tile_h: int | None
    nodata: float | None
    crs: str | None
    minx: float | None
    miny: float | None
    maxx: float | None
    maxy: float | None
    pixel_w: float | None
    pixel_h: float | None
    n_images: int


def header(f) -> Header:
    """Of bytes, or of an open file: a few hundred bytes are read, whatever its size."""
    images, _ = directories(f, False)
    t = images[0]
    if 256 not in t or 257 not in t:
        raise BadTiff("no width or height")
    w, h = t[256][0], t[257][0]
    try:
        nodata = float(t[42113].rstrip(b"\0 ").decode()) if 42113 in t else None
    except ValueError:
        nodata = None
    g = transform(t)
    box = extent(g, w, h) if g else (None,) * 4
    size = (float(np.hypot(g[1], g[4])), float(np.hypot(g[2], g[5]))) if g else (None, None)
    tiled = 322 in t and 323 in t
    return Header(w, h, t.get(258, (1,))[0], _FORMAT.get(t.get(339, (1,))[0], "uint"), tiled, t[322][0] if tiled else None, t[323][0] if tiled else None, nodata, crs(t), *box, *size, len(images))


def read_headers(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """files: label to path. One row per file with META's columns; `problem` tells why a header can't be read."""

    def run(frames):
        for pdf in frames:
            rows = []
            for label, path in zip(pdf["label"], pdf["path"]):
                row = dict.fromkeys(c.split()[0] for c in META.split(", ")) | {"path": path, "label": label}
                try:
                    fs, p = _filesystem(path)
                    with fs.open_input_file(p) as f:
                        row |= asdict(header(f))
                except OSError as e:
                    row["problem"] = f"raster.open: {e}"
                except BadTiff as e:
                    row["problem"] = f"raster.parse: {e}"
                rows.append(row)
            yield pd.DataFrame(rows)[[c.split()[0] for c in META.split(", ")]].astype({"width": "Int64", "height": "Int64", "bits": "Int32", "tile_w": "Int32", "tile_h": "Int32", "n_images": "Int32", "is_tiled": "boolean", **{c: "float64" for c in ("nodata", "minx", "miny", "maxx", "maxy", "pixel_w", "pixel_h")}})

    df = spark.createDataFrame([(k, v) for k, v in files.items()], "label string, path string").repartition(max(1, len(files)))
    return df.mapInPandas(run, META)


class Image:
    """One image of a tiled file: its tiles by place, each read by itself. f: bytes or an open file."""

    def __init__(self, f, number: int = 0):
        self.f = _source(f)
        images, end = directories(self.f)
        t = images[number]
        if 322 not in t:
            raise BadTiff("raster is not tiled")
        self.width, self.height, self.tw, self.th = t[256][0], t[257][0], t[322][0], t[323][0]
        self.kind = np.dtype({"uint": "u", "int": "i", "float": "f"}[_FORMAT[t.get(339, (1,))[0]]] + str(t[258][0] // 8)).newbyteorder(end)
        self.packed = t.get(259, (1,))[0]
        if self.packed not in (1, 8, 32946) or t.get(317, (1,))[0] != 1 or t.get(277, (1,))[0] != 1:
            raise BadTiff("compression is neither none nor deflate, or there is a predictor or more than one band")
        self.at, self.size = t[324], t[325]
        self.across, self.down = -(-self.width // self.tw), -(-self.height // self.th)
        head = header(self.f)
        g = transform(images[0]) or (0.0, 1.0, 0.0, 0.0, 0.0, -1.0)
        scale = images[0][256][0] / self.width
        self.x0, self.y0, self.pixel = g[0], g[3], g[1] * scale
        self.nodata = head.nodata

    def tile(self, row: int, col: int) -> np.ndarray:
        """Cut where the image ends; a tile that the file leaves out is all nodata."""
        k = row * self.across + col
        h, w = min(self.th, self.height - row * self.th), min(self.tw, self.width - col * self.tw)
        if not self.size[k]:
            return np.full((h, w), 0 if self.nodata is None else self.nodata, self.kind.newbyteorder("="))
        data = _take(self.f, self.size[k], self.at[k])
        data = data if self.packed == 1 else zlib.decompress(data)
        return np.frombuffer(data, self.kind, self.tw * self.th).reshape(self.th, self.tw)[:h, :w].astype(self.kind.newbyteorder("="))


def tiles(f):
    """(tile_row, tile_col, array) of the first image of a tiled file."""
    image = Image(f)
    for r in range(image.down):
        for c in range(image.across):
            yield r, c, image.tile(r, c)


class TileRun(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class GeoTiffReader(DataSourceReader):
    #: Tiles that a task reads.
    RUN = 64

    def __init__(self, path: str, number: int, box: tuple[float, ...] | None):
        self.path, self.number, self.box = path, number, box

    def _open(self, f):
        return Image(f, self.number)

    def _range(self, i: Image) -> tuple[int, int, int, int]:
        """Rows and columns of tiles that meet the box; all without one."""
        if self.box is None:
            return 0, i.down, 0, i.across
        w, s, e, n = self.box
        step_x, step_y = i.tw * i.pixel, i.th * i.pixel
        clip = lambda v, most: int(min(max(v, 0), most))
        return clip((i.y0 - n) // step_y, i.down), clip((i.y0 - s) // step_y + 1, i.down), clip((w - i.x0) // step_x, i.across), clip((e - i.x0) // step_x + 1, i.across)

    def partitions(self):
        fs, p = _filesystem(self.path)
        with fs.open_input_file(p) as f:
            r0, r1, c0, c1 = self._range(self._open(f))
        n = (r1 - r0) * (c1 - c0)
        return [TileRun(k, min(k + self.RUN, n)) for k in range(0, n, self.RUN)] or [TileRun(0, 0)]

    def read(self, part):
        fs, p = _filesystem(self.path)
        with fs.open_input_file(p) as f:
            i = self._open(f)
            r0, _, c0, c1 = self._range(i)
            for k in range(part.first, part.last):
                r, c = r0 + k // (c1 - c0), c0 + k % (c1 - c0)
                a = i.tile(r, c)
                flat = pa.array(a.ravel(), pa.float32() if a.dtype.kind == "f" else pa.int32() if a.dtype.itemsize < 4 or a.dtype.kind == "i" and a.dtype.itemsize == 4 else pa.int64())
                values = pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([c], pa.int32()), pa.array([i.x0 + c * i.tw * i.pixel]), pa.array([i.y0 - r * i.th * i.pixel]), pa.array([i.pixel]), pa.array([a.shape[1]], pa.int32()), values], ["tile_row", "tile_col", "x0", "y0", "pixel", "width", "values"])


class GeoTiff(DataSource):
    """Tiles of a tiled GeoTIFF as rows, see operators.rasters. Only the tiles that are wanted are read, each by its range of
    bytes, some dozens to a task.

        spark.dataSource.register(GeoTiff)
        spark.read.format("geotiff").option("bbox", "west,south,east,north").option("image", 0).load(path)

    bbox and image (1 and up are overviews) are optional.
    """

    @classmethod
    def name(cls):
        return "geotiff"

    def _number(self) -> int:
        return int(self.options.get("image", "0"))

    def schema(self):
        fs, p = _filesystem(self.options["path"])
        with fs.open_input_file(p) as f:
            kind = Image(f, self._number()).kind
        item = "float" if kind.kind == "f" else "int" if kind.itemsize < 4 or kind.kind == "i" and kind.itemsize == 4 else "bigint"
        return f"tile_row int, tile_col int, x0 double, y0 double, pixel double, width int, values array<{item}>"

    def reader(self, schema):
        box = self.options.get("bbox")
        return GeoTiffReader(self.options["path"], self._number(), tuple(float(x) for x in box.split(",")) if box else None)


def _image_tags(w: int, h: int, tile: int, dtype: np.dtype, nodata: float, at: list, size: list, x0: float, y0: float, pixel: float, epsg: int, reduced: bool) -> list[tuple]:
    key = 2048 if epsg == 4326 else 3072
    keys = (1, 1, 0, 2, 1024, 0, 1, 2 if epsg == 4326 else 1, key, 0, 1, epsg)
    fmt = {"u": 1, "i": 2, "f": 3}[dtype.kind]
    first = [(254, "I", (1,))] if reduced else []
    place = [] if reduced else [(33550, "d", (pixel, pixel, 0.0)), (33922, "d", (0.0, 0.0, 0.0, x0, y0, 0.0)), (34735, "H", keys)]
    return [*first, (256, "I", (w,)), (257, "I", (h,)), (258, "H", (dtype.itemsize * 8,)), (259, "H", (8,)), (262, "H", (1,)), (277, "H", (1,)), (322, "I", (tile,)), (323, "I", (tile,)), (324, "Q", at), (325, "Q", size), (339, "H", (fmt,)), *place, (42113, "s", f"{nodata:g}".encode() + b"\0")]


def _big_directory(tags: list[tuple], at: int, last: bool) -> bytes:
    """A BigTIFF directory that lies at `at`, its longer values behind it."""
    code = {"H": 3, "I": 4, "d": 12, "s": 2, "Q": 16}
    entries, tail = [], b""
    after = at + 8 + 20 * len(tags) + 8
    for tag, c, v in tags:
        raw = v if c == "s" else struct.pack(f"<{len(v)}{c}", *v)
        if len(raw) <= 8:
            entries.append(struct.pack("<HHQ", tag, code[c], len(v)) + raw.ljust(8, b"\0"))
        else:
            entries.append(struct.pack("<HHQQ", tag, code[c], len(v), after + len(tail)))
            tail += raw.ljust(-(-len(raw) // 8) * 8, b"\0")
    end = after + len(tail)
    return struct.pack("<Q", len(tags)) + b"".join(entries) + struct.pack("<Q", 0 if last else end) + tail


def write_cog(levels: list[DataFrame], path: str, width: int, height: int, tile: int, x0: float, y0: float, pixel: float, dtype: str, nodata: float, epsg: int = 4326) -> int:
    """A cloud-optimised BigTIFF: directories first, overviews before the full image, tiles deflated. Number of tiles.

    levels: tiles of the full image, then of each overview (see rasters.overview). Tasks deflate their tiles into files
    beside the target; the driver knows where each tile lies (16 bytes a tile) and joins the files block by block, so
    neither holds the raster. Tiles without a row are left out of the file and read as nodata.
    """
    kind = np.dtype(dtype)
    fs, p = _filesystem(path)
    stage = f"{p}-staging-{uuid.uuid4().hex}"

    def pack(level: int):
        def run(batches):
            out, index, name = None, [], f"{stage}/{level}-{uuid.uuid4().hex}"
            there, _ = _filesystem(path)
            for b in batches:
                for r, c, w, v in zip(*(b[k].to_pylist() for k in ("tile_row", "tile_col", "width")), b["values"]):
                    if out is None:
                        there.create_dir(stage, recursive=True)
                        out, at = there.open_output_stream(name), 0
                    a = v.values.to_numpy(zero_copy_only=False).reshape(-1, w)
                    block = np.full((tile, tile), nodata, kind)
                    block[: a.shape[0], : a.shape[1]] = a
                    raw = zlib.compress(block.astype(kind.newbyteorder("<")).tobytes())
                    out.write(raw)
                    index.append((r, c, name, at, len(raw)))
                    at += len(raw)
            if out is not None:
                out.close()
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in index], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))], ["tile_row", "tile_col", "name", "at", "n"])

        return run

    try:
        index = [df.select("tile_row", "tile_col", "width", "values").mapInArrow(pack(k), "tile_row int, tile_col int, name string, at long, n long").collect() for k, df in enumerate(levels)]
        sizes = [(-(-width // (1 << k)), -(-height // (1 << k))) for k in range(len(levels))]
        grids = [(-(-w // tile), -(-h // tile)) for w, h in sizes]
        head_size = 16 + sum(len(_big_directory(_image_tags(w, h, tile, kind, nodata, [0] * (a * d), [0] * (a * d), x0, y0, pixel, epsg, k > 0), 0, False)) for k, ((w, h), (a, d)) in enumerate(zip(sizes, grids)))
        names = [sorted({r["name"] for r in rows}) for rows in index]
        base, at = {}, head_size
        for k in range(len(levels) - 1, -1, -1):
            for name in names[k]:
                base[name] = at
                at += max(r["at"] + r["n"] for r in index[k] if r["name"] == name)
        with fs.open_output_stream(p) as out:
            out.write(struct.pack("<2sHHHQ", b"II", 43, 8, 0, 16))
            where = 16
            for k, ((w, h), (a, d)) in enumerate(zip(sizes, grids)):
                places, lengths = [0] * (a * d), [0] * (a * d)
                for r in index[k]:
                    places[r["tile_row"] * a + r["tile_col"]], lengths[r["tile_row"] * a + r["tile_col"]] = base[r["name"]] + r["at"], r["n"]
                raw = _big_directory(_image_tags(w, h, tile, kind, nodata, places, lengths, x0, y0, pixel, epsg, k > 0), where, k == len(levels) - 1)
                out.write(raw)
                where += len(raw)
            for k in range(len(levels) - 1, -1, -1):
                for name in names[k]:
                    with fs.open_input_stream(name) as part:
                        while block := part.read(1 << 23):
                            out.write(block)
        return sum(map(len, index))
    finally:
        import pyarrow.fs as pafs

        if fs.get_file_info(stage).type == pafs.FileType.Directory:
            fs.delete_dir(stage)


def cog_problems(f, overviews: int = 4) -> list[str]:
    """What keeps a raster from being a cloud-optimised one: tiles, enough overviews each half as large, directories before
    the data. Small images need no more overviews than halve them to a tile."""
    images, _ = directories(f)
    t = images[0]
    if 322 not in t:
        return ["raster is not tiled"]
    out = []
    needed, size = 0, max(t[256][0], t[257][0])
    while needed < overviews and size > t[322][0]:
        needed, size = needed + 1, -(-size // 2)
    if len(images) - 1 < needed:
        out.append(f"{len(images) - 1} overviews instead of {needed}")
    for a, b in zip(images, images[1:]):
        if b[256][0] >= a[256][0]:
            out.append("overviews don't get smaller")
    firsts = [min((x for x in i.get(324, ()) if x), default=0) for i in images]
    if any(x and y and x < y for x, y in zip(firsts, firsts[1:])):
        out.append("an overview lies behind a larger image")
    return out


def write_tiled(a: np.ndarray, x0: float, y0: float, pixel: float, nodata: float, tile: int = 256, epsg: int = 4326, deflate: bool = True) -> bytes:
    """A little-endian, tiled, optionally deflated file of one band, geographic or projected by its EPSG code."""
    h, w = a.shape
    data = []
    for r in range(0, h, tile):
        for c in range(0, w, tile):
            block = np.full((tile, tile), nodata, a.dtype)
            part = a[r : r + tile, c : c + tile]
            block[: part.shape[0], : part.shape[1]] = part
            raw = block.astype(a.dtype.newbyteorder("<")).tobytes()
            data.append(zlib.compress(raw) if deflate else raw)
    fmt = {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
    key = 2048 if epsg == 4326 else 3072
    keys = (1, 1, 0, 2, 1024, 0, 1, 2 if epsg == 4326 else 1, key, 0, 1, epsg)
    text = f"{nodata:g}".encode() + b"\0"
    tags = [(256, "I", (w,)), (257, "I", (h,)), (258, "H", (a.dtype.itemsize * 8,)), (259, "H", (8 if deflate else 1,)), (262, "H", (1,)), (277, "H", (1,)), (322, "I", (tile,)), (323, "I", (tile,)), (324, "I", (0,) * len(data)), (325, "I", tuple(map(len, data))), (339, "H", (fmt,)), (33550, "d", (pixel, pixel, 0.0)), (33922, "d", (0.0, 0.0, 0.0, x0, y0, 0.0)), (34735, "H", keys), (42113, "s", text)]
    code = {"H": 3, "I": 4, "d": 12, "s": 2}
    at = 8 + 2 + 12 * len(tags) + 4
    extra: dict = {}
    for tag, c, v in tags:
        raw = v if c == "s" else struct.pack(f"<{len(v)}{c}", *v)
        if len(raw) > 4:
            extra[tag] = (at, len(raw))
            at += len(raw)
    offsets = []
    for d in data:
        offsets.append(at)
        at += len(d)
    head, tail = [struct.pack("<2sHIH", b"II", 42, 8, len(tags))], []
    for tag, c, v in tags:
        v = tuple(offsets) if tag == 324 else v
        raw = v if c == "s" else struct.pack(f"<{len(v)}{c}", *v)
        head.append(struct.pack("<HHI", tag, code[c], len(v)) + (raw.ljust(4, b"\0") if tag not in extra else struct.pack("<I", extra[tag][0])))
        if tag in extra:
            tail.append(raw)
    return b"".join([*head, struct.pack("<I", 0), *tail, *data])
