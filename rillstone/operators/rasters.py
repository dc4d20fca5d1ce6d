"""Rasters as tables of tiles: remapping, masks, mosaics, histograms, comparison, tracing upstream.

A tile is a row: tile_row, tile_col, x0, y0 (upper left corner), pixel, width, values (array, row by row). Tiles have a
fixed size, so every operator works on one tile at a time; only mosaics and comparisons join tiles, by their place.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions import wkb

DIR_NODATA, ACC_NODATA = 255, -1.0
#: The eight directions clockwise from east, as ESRI and as TauDEM write them, and their row and column steps.
ESRI = (1, 2, 4, 8, 16, 32, 64, 128)
TAUDEM = (1, 8, 7, 6, 5, 4, 3, 2)
STEPS = ((0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1))


def transcode_direction(values: Column) -> Column:
    """Directions, 0 and 255 stay; every other value is nodata. A null is nodata."""
    keep = [0, *ESRI, DIR_NODATA]
    return F.transform(values, lambda v: F.when(v.isin(*keep), v).otherwise(F.lit(DIR_NODATA)))


def transcode_accumulation(values: Column) -> Column:
    """As float; 0 and null are nodata."""
    return F.transform(values, lambda v: F.when(v.isNull() | (v == 0), F.lit(ACC_NODATA)).otherwise(v).cast("float"))


def to_esri(values: Column, encoding: Column | str) -> Column:
    """Directions in the ESRI convention; 0 stays, what is no direction of the encoding is nodata."""
    table = F.create_map(*[F.lit(x) for t, e in zip(TAUDEM, ESRI) for x in (t, e)])
    enc = F.lit(encoding) if isinstance(encoding, str) else encoding

    def one(v: Column) -> Column:
        esri = F.when(v.isin(*ESRI), v.cast("int"))
        taudem = F.try_element_at(table, v.cast("int"))
        return F.when(v == 0, F.lit(0)).otherwise(F.coalesce(F.when(enc == "taudem", taudem).when(enc == "esri", esri), F.lit(DIR_NODATA)))

    return F.transform(values, one)


def histogram(tiles: DataFrame) -> DataFrame:
    """value, n over all tiles; counted in each task before anything is shuffled."""
    return tiles.select(F.explode("values").alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def statistics(tiles: DataFrame, nodata: float) -> DataFrame:
    v = tiles.select(F.explode("values").alias("v")).where((F.col("v") != nodata) & ~F.isnan(F.col("v").cast("double")))
    return v.agg(F.min("v").alias("least"), F.max("v").alias("most"), F.avg("v").alias("mean"), F.count("v").alias("n"))


def window(tiles: DataFrame, box: tuple[float, float, float, float], pad: int = 10) -> DataFrame:
    """Tiles that meet a box widened by pad pixels."""
    h = F.size("values") / F.col("width")
    p = F.col("pixel") * pad
    right, bottom = F.col("x0") + F.col("width") * F.col("pixel"), F.col("y0") - h * F.col("pixel")
    return tiles.where((F.col("x0") < box[2] + p) & (right > box[0] - p) & (bottom < box[3] + p) & (F.col("y0") > box[1] - p))


def extent_contains(extents: DataFrame, boxes: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """id, label, contained: whether a raster (label, minx, miny, maxx, maxy: a few) reaches around each box (id, and the four
    sides of a catchment), within a tolerance in degrees."""
    e = extents.select("label", *[F.col(c).alias(f"r_{c}") for c in ("minx", "miny", "maxx", "maxy")])
    e = e.groupBy().agg(F.collect_list(F.struct(*e.columns)).alias("rasters"))  # one row to a raster file, so no rows are paired
    j = boxes.join(F.broadcast(e)).withColumn("r", F.explode("rasters"))
    t = F.lit(tolerance)
    ok = (F.col("r.r_minx") <= F.col("bbox_minx") + t) & (F.col("r.r_miny") <= F.col("bbox_miny") + t) & (F.col("r.r_maxx") >= F.col("bbox_maxx") - t) & (F.col("r.r_maxy") >= F.col("bbox_maxy") - t)
    return j.select("id", "r.label", F.coalesce(ok, F.lit(False)).alias("contained"))


def mask(tiles: DataFrame, region: bytes, nodata: float) -> DataFrame:
    """Pixels whose centre lies outside the region become nodata. masked: how many there were."""
    rings = wkb.rings(region)
    edges = wkb.Edges([rings] if rings else [])
    item = tiles.schema["values"].dataType.elementType.simpleString()

    def run(frames):
        for pdf in frames:
            out, n = [], []
            for t in pdf.itertuples(index=False):
                v = np.array(t.values, dtype=float)
                k = np.arange(len(v))
                x, y = t.x0 + (k % t.width + 0.5) * t.pixel, t.y0 - (k // t.width + 0.5) * t.pixel
                inside = edges.contain(np.zeros(len(v), int), x, y) if rings else np.zeros(len(v), bool)
                n.append(int((~inside & (v != nodata)).sum()))
                out.append(np.where(inside, v, nodata).tolist())
            pdf = pdf.assign(values=out, masked=n)
            if item not in ("float", "double"):
                pdf["values"] = [[int(x) for x in v] for v in pdf["values"]]
            yield pdf

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tiles.schema.fields)
    return tiles.mapInPandas(run, f"{schema}, masked long")


def mosaic(layers: DataFrame, nodata: float, order: str = "layer") -> DataFrame:
    """One tile per place from overlapping layers: each pixel from the first layer, by order, that has data there.
    Pixels are combined one by one, so any number of layers may meet."""
    px = layers.select("tile_row", "tile_col", "x0", "y0", "pixel", "width", F.col(order).alias("o"), F.posexplode("values").alias("pos", "v"))
    place = ["tile_row", "tile_col", "pos"]
    best = px.groupBy(*place).agg(F.coalesce(F.min(F.when(F.col("v") != nodata, F.struct("o", "v")))["v"], F.lit(nodata)).alias("v"), *[F.first(c).alias(c) for c in ("x0", "y0", "pixel", "width")])
    tile = best.groupBy("tile_row", "tile_col").agg(*[F.first(c).alias(c) for c in ("x0", "y0", "pixel", "width")], F.sort_array(F.collect_list(F.struct("pos", "v"))).alias("p"))
    return tile.select("tile_row", "tile_col", "x0", "y0", "pixel", "width", F.col("p.v").alias("values"))


def overview(tiles: DataFrame, tile: int) -> DataFrame:
    """Tiles of the image at half the resolution, every second pixel of every second row; up to four tiles make one."""
    item = tiles.schema["values"].dataType.elementType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = {}
        for t in pdf.itertuples(index=False):
            a = np.asarray(t.values).reshape(-1, t.width)[::2, ::2]
            parts[t.tile_row % 2, t.tile_col % 2] = a
        half = tile // 2
        first = lambda a, k: a.shape[k]
        h = max(r * half + first(a, 0) for (r, _), a in parts.items())
        w = max(c * half + first(a, 1) for (_, c), a in parts.items())
        out = np.zeros((h, w), next(iter(parts.values())).dtype)
        for (r, c), a in parts.items():
            out[r * half : r * half + a.shape[0], c * half : c * half + a.shape[1]] = a
        t = pdf.iloc[0]
        row, col = int(t.tile_row) // 2, int(t.tile_col) // 2
        return pd.DataFrame([(row, col, t.x0 - (t.tile_col % 2) * tile * t.pixel, t.y0 + (t.tile_row % 2) * tile * t.pixel, 2 * t.pixel, w, out.ravel().tolist())], columns=["tile_row", "tile_col", "x0", "y0", "pixel", "width", "values"])

    up = [F.floor(F.col(c) / 2).alias(f"up_{c}") for c in ("tile_row", "tile_col")]
    return tiles.groupBy(*up).applyInPandas(run, f"tile_row int, tile_col int, x0 double, y0 double, pixel double, width int, values array<{item}>")


def differences(a: DataFrame, b: DataFrame, nodata: float, rtol: float = 0.0, atol: float = 0.0) -> DataFrame:
    """n_compared, n_different over the pixels where both have data; exact where both tolerances are 0."""
    j = a.select("tile_row", "tile_col", F.col("values").alias("va")).join(b.select("tile_row", "tile_col", F.col("values").alias("vb")), ["tile_row", "tile_col"])
    p = j.select(F.explode(F.arrays_zip("va", "vb")).alias("p")).select(F.col("p.va").cast("double").alias("x"), F.col("p.vb").cast("double").alias("y")).where((F.col("x") != nodata) & (F.col("y") != nodata))
    return p.agg(F.count(F.lit(1)).alias("n_compared"), F.count_if(F.abs(F.col("x") - F.col("y")) > atol + rtol * F.abs("y")).alias("n_different"))


def trace(direction: np.ndarray, row: int, col: int) -> np.ndarray:
    """Which pixels drain to (row, col), itself included; direction in the ESRI convention. One window at a time."""
    back = {(-dr, -dc): code for code, (dr, dc) in zip(ESRI, STEPS)}
    seen = np.zeros(direction.shape, bool)
    seen[row, col] = True
    stack = [(row, col)]
    while stack:
        r, c = stack.pop()
        for (dr, dc), code in back.items():
            i, j = r + dr, c + dc
            if 0 <= i < direction.shape[0] and 0 <= j < direction.shape[1] and not seen[i, j] and direction[i, j] == code:
                seen[i, j] = True
                stack.append((i, j))
    return seen


def nearest_above(acc: np.ndarray, row: int, col: int, least: float = 1000.0) -> tuple[int, int] | None:
    """The pixel nearest to (row, col) whose accumulation is at least `least`; ties by row, then column."""
    r, c = np.nonzero(acc >= least)
    if not len(r):
        return None
    k = np.lexsort((c, r, (r - row) ** 2 + (c - col) ** 2))[0]
    return int(r[k]), int(c[k])


def outline(mask_: np.ndarray, x0: float, y0: float, pixel: float) -> list[np.ndarray]:
    """Rings around the marked pixels, as coordinates."""
    from rillstone.functions.dissolve import dissolve

    squares = [[np.array([(c, r), (c + 1, r), (c + 1, r + 1), (c, r + 1)], float)] for r, c in zip(*np.nonzero(mask_))]
    return [np.stack([x0 + ring[:, 0] * pixel, y0 - ring[:, 1] * pixel], axis=1) for ring in dissolve(squares)]


def refine(windows: DataFrame, threshold: float = 1000.0) -> DataFrame:
    """outlet_id, n_pixels, area_km2, geometry: the part of an outlet's atom that drains to it.

    windows: outlet_id, row, col, x0, y0, pixel, width, direction (array), accumulation (array): the atom's window. The
    outlet moves to the nearest pixel of enough accumulation; without one it stays.
    """
    from rillstone.functions.dissolve import sphere_area_km2

    def run(frames):
        for pdf in frames:
            out = []
            for w in pdf.itertuples(index=False):
                d = np.array(w.direction).reshape(-1, w.width)
                a = np.array(w.accumulation, float).reshape(-1, w.width)
                r, c = nearest_above(a, w.row, w.col, threshold) or (w.row, w.col)
                rings = outline(trace(d, r, c), w.x0, w.y0, w.pixel)
                area = sum(sphere_area_km2(x) for x in rings[:1]) if len(rings) == 1 else abs(sum(np.sign(_area(x)) * sphere_area_km2(x) for x in rings))
                out.append((w.outlet_id, int(trace(d, r, c).sum()), float(area), wkb.polygon([np.vstack([x, x[:1]]) for x in rings])))
            yield pd.DataFrame(out, columns=["outlet_id", "n_pixels", "area_km2", "geometry"])

    return windows.mapInPandas(run, "outlet_id long, n_pixels long, area_km2 double, geometry binary")


def _area(r: np.ndarray) -> float:
    from rillstone.functions.dissolve import signed_area

    return signed_area(r)


def pixel_area_km2(latitude: Column, degrees: float) -> Column:
    return F.pow(F.lit(degrees * 111.32), 2) * F.cos(F.radians(latitude))
