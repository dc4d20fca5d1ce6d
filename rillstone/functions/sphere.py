"""Great-circle geometry in numpy: Voronoi cells around pivots, and vantage-point trees."""

from __future__ import annotations

import numpy as np

RADIUS_M = 6371008.8
#: Metres by which bounds are widened against rounding.
SLACK_M = 1.0


def unit(lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
    lon, lat = np.radians(lon), np.radians(lat)
    c = np.cos(lat)
    return np.stack([c * np.cos(lon), c * np.sin(lon), np.sin(lat)], axis=-1)


def metres(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Great-circle distance of unit vectors, accurate also for short ones."""
    chord = np.sqrt(((u - v) ** 2).sum(axis=-1))
    return 2 * RADIUS_M * np.arcsin(np.minimum(chord / 2, 1))


def _table(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return RADIUS_M * np.arccos(np.clip(u @ v.T, -1, 1))


def box_ball(minx: float, miny: float, maxx: float, maxy: float) -> tuple[float, float, float]:
    """Centre and a radius in metres that surely covers a box of longitude and latitude."""
    dy, dx = np.radians(maxy - miny) / 2, np.radians(maxx - minx) / 2
    widest = 1.0 if miny <= 0 <= maxy else max(np.cos(np.radians(np.clip(miny, -90, 90))), np.cos(np.radians(np.clip(maxy, -90, 90))))
    return (minx + maxx) / 2, (miny + maxy) / 2, float(min(RADIUS_M * np.hypot(dy, dx * widest), np.pi * RADIUS_M)) + SLACK_M


class Pivots:
    """Voronoi cells on two levels: the nearest of some top pivots, then the nearest of its own pivots.

    A point belongs to one cell. An object that reaches `reach` metres is also sent to each cell whose pivot is, on
    both levels, at most 2 * reach farther than the nearest: by the triangle inequality no cell that owns a point within
    reach is missed.
    """

    def __init__(self, lon: np.ndarray, lat: np.ndarray, per_top: int | None = None):
        u = unit(np.asarray(lon, float), np.asarray(lat, float))
        per_top = per_top or max(128, round(len(u) ** 0.5))
        k = max(1, -(-len(u) // per_top))
        self.top = u[:k] if len(u) else np.array([[1.0, 0, 0]])
        near = np.concatenate([_table(u[i : i + 4096], self.top).argmin(axis=1) for i in range(0, len(u), 4096)]) if len(u) else np.zeros(0, int)
        self.own = [u[near == t] if (near == t).any() else self.top[t : t + 1] for t in range(len(self.top))]
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in self.own])[:-1]])

    def assign(self, u: np.ndarray, reach: np.ndarray | float, block: int = 8192) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, owner): every cell each row goes to; owner marks the one it belongs to."""
        rows, cells, owners = [], [], []
        reach = np.broadcast_to(np.asarray(reach, float), (len(u),))
        for lo in range(0, len(u), block):
            x, margin = u[lo : lo + block], 2 * reach[lo : lo + block] + SLACK_M
            d = _table(x, self.top)
            own = d.argmin(axis=1)
            near = d <= d.min(axis=1)[:, None] + margin[:, None]
            for t in np.flatnonzero(near.any(axis=0)):
                i = np.flatnonzero(near[:, t])
                e = _table(x[i], self.own[t])
                mine = e.argmin(axis=1)
                a, s = np.nonzero(e <= e.min(axis=1)[:, None] + margin[i][:, None])
                rows.append(lo + i[a])
                cells.append(self.first[t] + s)
                owners.append((own[i[a]] == t) & (mine[a] == s))
        if not rows:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool)
        return np.concatenate(rows), np.concatenate(cells), np.concatenate(owners)


class VantageTree:
    """A vantage-point tree over unit vectors; ball queries run for many centres at once."""

    def __init__(self, u: np.ndarray, leaf: int = 48):
        self.u, self.nodes = u, []
        if len(u):
            self._build(np.arange(len(u)), leaf)

    def _build(self, at: np.ndarray, leaf: int) -> int:
        me = len(self.nodes)
        self.nodes.append(None)
        d = metres(self.u[at], self.u[at[0]]) if len(at) > leaf else None
        if d is None or d.max() == 0:
            self.nodes[me] = (at, None, 0.0, 0.0, 0, 0)
            return me
        cut = float(np.median(d))
        inner = d <= cut
        if inner.all():
            inner = d < cut
        a = self._build(at[inner], leaf)
        b = self._build(at[~inner], leaf)
        self.nodes[me] = (None, int(at[0]), float(d[inner].max()), float(d[~inner].min()), a, b)
        return me

    def balls(self, centre: np.ndarray, radius: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
        """(query, item) of every item within its query's radius."""
        radius = np.broadcast_to(np.asarray(radius, float), (len(centre),))
        qs, items = [], []
        stack = [(0, np.arange(len(centre)))] if self.nodes and len(centre) else []
        while stack:
            n, q = stack.pop()
            at, vantage, inmost, outleast, a, b = self.nodes[n]
            if at is not None:
                for lo in range(0, len(q), 4096):
                    part = q[lo : lo + 4096]
                    d = metres(centre[part][:, None, :], self.u[at][None, :, :])
                    i, j = np.nonzero(d <= radius[part][:, None])
                    qs.append(part[i])
                    items.append(at[j])
                continue
            d = metres(centre[q], self.u[vantage])
            left, right = q[d - radius[q] <= inmost + SLACK_M], q[d + radius[q] >= outleast - SLACK_M]
            if len(left):
                stack.append((a, left))
            if len(right):
                stack.append((b, right))
        if not qs:
            return np.zeros(0, int), np.zeros(0, int)
        return np.concatenate(qs), np.concatenate(items)
