"""Union of regions that share whole edges, by cancelling edges; areas on the sphere."""

from __future__ import annotations

import numpy as np

#: Radius in metres of the sphere with the area of the WGS 84 ellipsoid.
AUTHALIC_M = 6371007.181


def signed_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0], ring[:, 1]
    return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2)


def sphere_area_km2(ring: np.ndarray) -> float:
    """Area within a ring of longitude and latitude, on the equal-area sphere (edges straight in the cylindrical map)."""
    lon, sin = np.radians(ring[:, 0]), np.sin(np.radians(ring[:, 1]))
    return abs(float((lon * np.roll(sin, -1) - np.roll(lon, -1) * sin).sum() / 2)) * (AUTHALIC_M / 1000) ** 2


class Unsupported(ValueError):
    """Regions overlap or share only parts of edges."""


def dissolve(polygons: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Boundary rings of the union of polygons, each a list of rings with the outer one first. Outer rings come out
    counter-clockwise, holes clockwise. An edge that two polygons share, once in each direction, vanishes."""
    edges: dict = {}
    for rings in polygons:
        for k, r in enumerate(rings):
            pts = [tuple(p) for p in np.asarray(r, float)]
            if len(pts) > 1 and pts[0] == pts[-1]:
                pts = pts[:-1]
            if len(pts) < 3:
                continue
            if (signed_area(np.array(pts)) > 0) != (k == 0):
                pts.reverse()
            for a, b in zip(pts, pts[1:] + pts[:1]):
                if (b, a) in edges:
                    edges[b, a] -= 1
                    if not edges[b, a]:
                        del edges[b, a]
                elif (a, b) in edges:
                    raise Unsupported("an edge is used twice in one direction")
                else:
                    edges[a, b] = 1
    return stitch(list(edges))


def stitch(edges: list[tuple]) -> list[np.ndarray]:
    """Rings of directed edges ((x, y), (x, y)), each of which is used once."""
    nexts: dict = {}
    for a, b in edges:
        nexts.setdefault(a, []).append(b)
    rings = []
    while nexts:
        start = a = min(nexts)
        ring, came = [], None
        while True:
            outs = nexts[a]
            b = outs[0] if len(outs) == 1 or came is None else max(outs, key=lambda o: _turn(came, a, o))
            outs.remove(b)
            if not outs:
                del nexts[a]
            ring.append(a)
            came, a = a, b
            if a == start:
                break
            if a not in nexts:
                raise Unsupported("boundary does not close")
        rings.append(_straightened(np.array(ring)))
    return rings


def _turn(a, b, c) -> float:
    """Where several edges leave a point: the sharpest turn to the left, so that touching rings stay apart."""
    u, v = np.subtract(b, a), np.subtract(c, b)
    return float(np.arctan2(u[0] * v[1] - u[1] * v[0], u @ v))


def _straightened(r: np.ndarray) -> np.ndarray:
    """Without points on straight lines between their neighbours."""
    p, n = np.roll(r, 1, axis=0), np.roll(r, -1, axis=0)
    u, v = r - p, n - r
    bent = u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0] != 0
    return r[bent] if bent.sum() >= 3 else r
