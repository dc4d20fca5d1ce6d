"""WKB in numpy: points, last vertices, polygons. Geometry that can't be read gives None or NaN, never an error."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

POINT, LINESTRING, POLYGON, MULTIPOINT, MULTILINESTRING, MULTIPOLYGON, COLLECTION = range(1, 8)
_DIMENSIONS = {0: 2, 1: 3, 2: 3, 3: 4}


class Unreadable(ValueError):
    """Truncated, of unknown type, or with a count beyond the bytes that are there."""


def _head(b: bytes, i: int) -> tuple[str, int, int, int]:
    if len(b) < i + 5 or b[i] > 1:
        raise Unreadable
    end = "<" if b[i] == 1 else ">"
    code = struct.unpack_from(end + "I", b, i + 1)[0]
    if code // 1000 not in _DIMENSIONS:
        raise Unreadable
    return end, code % 1000, _DIMENSIONS[code // 1000], i + 5


def _run(b: bytes, i: int, end: str, dims: int) -> tuple[np.ndarray, int]:
    if len(b) < i + 4:
        raise Unreadable
    n = struct.unpack_from(end + "I", b, i)[0]
    stop = i + 4 + 8 * dims * n
    if len(b) < stop:
        raise Unreadable
    return np.frombuffer(b, end + "f8", dims * n, i + 4).reshape(n, dims)[:, :2], stop


def parse(b: bytes | None) -> tuple[int, list]:
    """(type, content): coordinates for a point or line, rings for a polygon, parts for the multi types."""
    if b is None:
        raise Unreadable
    kind, content, _ = _parse(bytes(b), 0, 0)
    return kind, content


def _parse(b: bytes, i: int, depth: int) -> tuple[int, list, int]:
    end, kind, dims, i = _head(b, i)
    if kind == POINT:
        if len(b) < i + 8 * dims:
            raise Unreadable
        return kind, np.frombuffer(b, end + "f8", dims, i)[:2], i + 8 * dims
    if kind == LINESTRING:
        xy, i = _run(b, i, end, dims)
        return kind, xy, i
    if len(b) < i + 4 or kind not in (POLYGON, MULTIPOINT, MULTILINESTRING, MULTIPOLYGON, COLLECTION) or depth > 16:
        raise Unreadable
    n = struct.unpack_from(end + "I", b, i)[0]
    i += 4
    if n > len(b):
        raise Unreadable
    parts = []
    for _ in range(n):
        if kind == POLYGON:
            ring, i = _run(b, i, end, dims)
            parts.append(ring)
        else:
            inner, content, i = _parse(b, i, depth + 1)
            if kind != COLLECTION and inner != kind - 3:
                raise Unreadable
            parts.append((inner, content))
    return kind, parts, i


def rings(b: bytes | None) -> list[np.ndarray] | None:
    """All rings, outer and holes, of a Polygon or MultiPolygon; None if unreadable, of another type, empty or not finite."""
    try:
        kind, content = parse(b)
    except Unreadable:
        return None
    if kind == MULTIPOLYGON:
        content = [r for _, polygon in content for r in polygon]
    elif kind != POLYGON:
        return None
    content = [r for r in content if len(r) >= 3]
    if not content or not all(np.isfinite(r).all() for r in content):
        return None
    return content


def last_vertex(b: bytes | None) -> tuple[float, float]:
    """Longitude and latitude of a Point or of the last vertex of a LineString; NaN where there is none."""
    try:
        kind, content = parse(b)
        if kind == LINESTRING and len(content):
            content = content[-1]
        elif kind != POINT:
            return np.nan, np.nan
        x, y = float(content[0]), float(content[1])
        return (x, y) if np.isfinite(x) and np.isfinite(y) and abs(y) <= 90 else (np.nan, np.nan)
    except Unreadable:
        return np.nan, np.nan


def is_readable(b: bytes | None) -> bool:
    try:
        parse(b)
        return True
    except Unreadable:
        return False


def polygon(ring_list: list) -> bytes:
    """A little-endian WKB Polygon of rings of (x, y)."""
    out = [struct.pack("<BII", 1, POLYGON, len(ring_list))]
    for r in ring_list:
        out.append(struct.pack("<I", len(r)) + np.asarray(r, "<f8")[:, :2].tobytes())
    return b"".join(out)


def multipolygon(polygons: list) -> bytes:
    return struct.pack("<BII", 1, MULTIPOLYGON, len(polygons)) + b"".join(polygon(p) for p in polygons)


def linestring(xy: list, end: str = "<") -> bytes:
    return struct.pack(end + "BII", end == "<", LINESTRING, len(xy)) + np.asarray(xy, end + "f8").tobytes()


def point(x: float, y: float, end: str = "<") -> bytes:
    return struct.pack(end + "BIdd", end == "<", POINT, x, y)


# ---- many geometries at once ------------------------------------------------------------------------------------------


class _Bytes:
    """A binary Arrow column as one run of bytes, read at many places at once."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary())
        off = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
        data = column.buffers()[2]
        self.raw = np.concatenate([np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), np.zeros(16, np.uint8)])
        self.start, self.stop = off[:-1].copy(), off[1:].copy()
        self.stop[column.is_null().to_numpy(zero_copy_only=False)] = self.start[column.is_null().to_numpy(zero_copy_only=False)]

    def u32(self, at: np.ndarray, little: np.ndarray) -> np.ndarray:
        b = [self.raw[at + k].astype(np.int64) for k in range(4)]
        return np.where(little, b[0] | b[1] << 8 | b[2] << 16 | b[3] << 24, b[3] | b[2] << 8 | b[1] << 16 | b[0] << 24)

    def f64(self, at: np.ndarray, little: np.ndarray) -> np.ndarray:
        """Doubles that start at any byte: eight shifted views of the run, each in both byte orders."""
        out = np.empty(len(at))
        shift = at & 7
        for k in range(8):
            whole = (len(self.raw) - k) // 8
            for end, mine in (("<f8", little), (">f8", ~little)):
                i = np.flatnonzero((shift == k) & mine)
                if len(i):
                    out[i] = self.raw[k : k + 8 * whole].view(end)[at[i] >> 3]
        return out


def last_vertices(column: pa.Array) -> np.ndarray:
    """last_vertex of a whole column: rows of longitude and latitude."""
    b = _Bytes(column)
    size = b.stop - b.start
    out = np.full((len(size), 2), np.nan)
    i = np.flatnonzero(size >= 9)
    at = b.start[i]
    little = b.raw[at] == 1
    code = b.u32(at + 1, little)
    dims = np.select([code // 1000 == k for k in _DIMENSIONS], list(_DIMENSIONS.values()), 0)
    n = np.where(code % 1000 == LINESTRING, b.u32(at + 5, little), 1)
    first = np.where(code % 1000 == LINESTRING, at + 9, at + 5)
    ok = (b.raw[at] <= 1) & (dims > 0) & np.isin(code % 1000, (POINT, LINESTRING)) & (n > 0) & (first + 8 * dims * n <= b.stop[i])
    i, last, little = i[ok], (first + 8 * dims * (n - 1))[ok], little[ok]
    x, y = b.f64(last, little), b.f64(last + 8, little)
    good = np.isfinite(x) & np.isfinite(y) & (np.abs(y) <= 90)
    out[i[good], 0], out[i[good], 1] = x[good], y[good]
    return out


def _walked(b: _Bytes) -> tuple:
    """(rows of polygons of two dimensions, which of them can't be read, rows to be read one by one, rings: place in rows,
    first byte, vertices, byte order, whether a polygon's first)."""
    i = np.flatnonzero(b.stop - b.start >= 9)
    at = b.start[i]
    little = b.raw[at] == 1
    code, n = b.u32(at + 1, little), b.u32(at + 5, little)
    fast = (b.raw[at] <= 1) & np.isin(code, (POLYGON, MULTIPOLYGON))
    slow = i[(b.raw[at] <= 1) & ~fast & np.isin(code % 1000, (POLYGON, MULTIPOLYGON))]  # of more dimensions
    i, at, little, code, n = i[fast], at[fast] + 9, little[fast], code[fast], n[fast]
    parts, left = np.where(code == MULTIPOLYGON, n, 0), np.where(code == POLYGON, n, 0)
    bad, fresh = np.zeros(len(i), bool), np.ones(len(i), bool)
    found = []
    live = np.flatnonzero((parts > 0) | (left > 0))
    while len(live):
        # a polygon of a multipolygon begins: its own header
        k = live[left[live] == 0]
        if len(k):
            short = at[k] + 9 > b.stop[i[k]]
            bad[k[short]] = True
            k = k[~short]
            little[k] = b.raw[at[k]] == 1
            odd = (b.raw[at[k]] > 1) | (b.u32(at[k] + 1, little[k]) != POLYGON)
            bad[k[odd]] = True
            slow = np.concatenate([slow, i[k[odd]]])  # unreadable, or of more dimensions
            k = k[~odd]
            left[k], parts[k], at[k] = b.u32(at[k] + 5, little[k]), parts[k] - 1, at[k] + 9
            fresh[k] = True
        k = live[(left[live] > 0) & ~bad[live]]
        short = at[k] + 4 > b.stop[i[k]]
        count = np.where(short, 0, b.u32(np.minimum(at[k], len(b.raw) - 4), little[k]))
        stop = at[k] + 4 + 16 * count
        short |= stop > b.stop[i[k]]
        bad[k[short]] = True
        k, count, stop = k[~short], count[~short], stop[~short]
        found.append(np.stack([k, at[k] + 4, count, little[k], fresh[k]]))
        at[k], left[k], fresh[k] = stop, left[k] - 1, False
        live = live[~bad[live] & ((parts[live] > 0) | (left[live] > 0))]
    k, pos, count, end, first = np.concatenate(found, axis=1) if found else np.zeros((5, 0), np.int64)
    return i, bad, slow.astype(np.int64), (k, pos, count, end, first)


def readable(column: pa.Array) -> np.ndarray:
    """is_readable of a whole column."""
    b = _Bytes(column)
    out = np.zeros(len(b.start), bool)
    i = np.flatnonzero(b.stop - b.start >= 5)
    at = b.start[i]
    little = b.raw[at] == 1
    code = b.u32(at + 1, little)
    base = code % 1000
    dims = np.select([code // 1000 == k for k in _DIMENSIONS], list(_DIMENSIONS.values()), 0)
    known = (b.raw[at] <= 1) & (dims > 0)
    n = np.where((base == LINESTRING) & (at + 9 <= b.stop[i]), b.u32(np.minimum(at + 5, len(b.raw) - 4), little), 0)
    need = np.where(base == POINT, 5 + 8 * dims, 9 + 8 * dims * n)
    out[i] = known & np.isin(base, (POINT, LINESTRING)) & (at + need <= b.stop[i])
    rows, bad, slow, _ = _walked(b)
    out[rows] = ~bad
    rest = i[known & np.isin(base, (MULTIPOINT, MULTILINESTRING, COLLECTION))]
    for r in np.concatenate([slow, rest]).tolist():
        out[r] = is_readable(column[r].as_py())
    return out


def all_rings(column: pa.Array, outer: bool = False) -> tuple[np.ndarray, ...]:
    """rings of a whole column, as (row of each ring, number of its vertices, vertices, and with `outer` whether it is a
    polygon's first): rows that `rings` gives None for have none. Polygons of two dimensions are walked ring by ring, all
    rows at once; other rows go one by one."""
    b = _Bytes(column)
    i, bad, slow, (k, pos, count, end, first) = _walked(b)
    keep = ~bad[k] & (count >= 3)
    order = np.flatnonzero(keep)[np.argsort(k[keep], kind="stable")]
    k, pos, count, end, first = k[order], pos[order], count[order], end[order] == 1, first[order] == 1
    where = np.repeat(pos - 16 * np.concatenate([[0], np.cumsum(count)[:-1]]), count) + 16 * np.arange(count.sum())
    flag = np.repeat(end, count)
    xy = np.stack([b.f64(where, flag), b.f64(where + 8, flag)], axis=1)
    row = i[k]
    wild = np.unique(np.repeat(row, count)[~np.isfinite(xy).all(axis=1)])
    if len(wild):
        drop = np.isin(row, wild)
        xy, row, count, first = xy[~np.repeat(drop, count)], row[~drop], count[~drop], first[~drop]
    for r in slow.tolist():
        more = rings(column[r].as_py()) or []
        row, count = np.concatenate([row, np.full(len(more), r)]), np.concatenate([count, np.array([len(x) for x in more], np.int64)])
        first = np.concatenate([first, np.arange(len(more)) == 0])
        xy = np.concatenate([xy, *more])
    return (row, count, xy, first) if outer else (row, count, xy)


class Edges:
    """Edges of many polygons in one array, for even-odd tests of many (point, polygon) pairs at once."""

    def __init__(self, polygons: list[list[np.ndarray]]):
        starts, ends, counts = [], [], []
        for ring_list in polygons:
            n = 0
            for r in ring_list:
                starts.append(r)
                ends.append(np.roll(r, -1, axis=0))
                n += len(r)
            counts.append(n)
        self.a = np.concatenate(starts) if starts else np.zeros((0, 2))
        self.b = np.concatenate(ends) if ends else np.zeros((0, 2))
        self.count = np.array(counts, dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.count)[:-1]]) if counts else np.zeros(0, dtype=np.int64)

    @classmethod
    def of_lines(cls, xy: np.ndarray, count: np.ndarray) -> Edges:
        """From runs of vertices, one run of count[i] vertices to a polygon; rows of NaN part the lines within a run and end
        each run."""
        out = cls([])
        whole = ~np.isnan(xy[:-1, 0]) & ~np.isnan(xy[1:, 0]) if len(xy) else np.zeros(0, bool)
        out.a, out.b = xy[:-1][whole], xy[1:][whole]
        owner = np.repeat(np.arange(len(count)), count)[:-1][whole] if len(xy) else np.zeros(0, int)
        out.count = np.bincount(owner, minlength=len(count)).astype(np.int64)
        out.first = np.concatenate([[0], np.cumsum(out.count)[:-1]]) if len(count) else np.zeros(0, np.int64)
        return out

    def contain(self, poly: np.ndarray, x: np.ndarray, y: np.ndarray, block: int = 2_000_000) -> np.ndarray:
        """Whether polygon poly[i] contains (x[i], y[i]); holes excluded."""
        out = np.zeros(len(poly), dtype=bool)
        if not len(poly):
            return out
        cum = np.cumsum(self.count[poly])
        lo = 0
        while lo < len(poly):
            hi = max(lo + 1, int(np.searchsorted(cum, (cum[lo - 1] if lo else 0) + block)))
            n = self.count[poly[lo:hi]]
            at = np.repeat(self.first[poly[lo:hi]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            px, py = np.repeat(x[lo:hi], n), np.repeat(y[lo:hi], n)
            ax, ay, bx, by = self.a[at, 0], self.a[at, 1], self.b[at, 0], self.b[at, 1]
            with np.errstate(divide="ignore", invalid="ignore"):
                cross = ((ay > py) != (by > py)) & (px < (bx - ax) * (py - ay) / (by - ay) + ax)
            ends = np.cumsum(n)
            hits = np.concatenate([[0], np.cumsum(cross)])
            out[lo:hi] = ((hits[ends] - hits[ends - n]) & 1) == 1
            lo = hi
        return out
