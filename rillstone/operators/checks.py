"""The catalogue of checks. Each takes tables and yields diagnostics; none collects, none needs another's result.

Rules of single rows are lists (null_rules and others), so that all of a table's go in one pass (diagnostics.each).

`row` places a record in its file (see with_row): a column, its name, or None.
"""

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.functions import wkb
from rillstone.operators import diagnostics as D
from rillstone.sources.schemas import BOX

ROW = "_row"


def with_row(df: DataFrame) -> DataFrame:
    """_row: the record's place in its file, from the reader."""
    return df.select("*", F.col("_metadata.row_index").alias("_row"))


def finite(c: str) -> Column:
    v = F.col(c).cast("double")
    return F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))


def _fmt(text: str, *cols) -> Column:
    return F.format_string(text, *[F.col(c) if isinstance(c, str) else c for c in cols])


# ---- identity and values of single rows -----------------------------------------------------------------------------


def null_rules(artifact: str, required: dict[str, list[str]]) -> list[D.Rule]:
    """required: name in the check id to its columns; several columns give one finding."""
    out = []
    for name, cols in required.items():
        miss = F.lit(False)
        for c in cols:
            miss = miss | F.col(c).isNull()
        out.append((miss, f"{artifact}.null_{name}", F.lit(f"null in required column {name}"), "Schema"))
    return out


def id_rules(prefix: str, key: str = "id") -> list[D.Rule]:
    v = F.col(key)
    return [(v == 0, f"ids.{prefix}_zero", F.lit("id is 0, which is reserved for the terminal sink"), "IdConstraint"), (v < 0, f"ids.{prefix}_negative", _fmt("id %d is negative", key), "IdConstraint")]


def duplicates(df: DataFrame, artifact: str, prefix: str, key: str = "id", row: D.Place = ROW) -> DataFrame:
    """Every occurrence of a positive id after its first by row. Hot ids: the first rows are found by an aggregate, so no
    id's rows are sorted in one task."""
    pos = df.where(F.col(key) > 0).select(F.col(key).alias("k"), D.place(row).alias("r"))
    first = pos.groupBy("k").agg(F.min("r").alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = pos.join(first, "k").where("r > f")
    return D.where(again, F.lit(True), f"ids.{prefix}_duplicate", "IdConstraint", artifact, F.format_string("id %d occurs again; first in row %d", "k", "f"), F.col("r"))


def upstream_entries(graph: DataFrame, row: D.Place = ROW) -> DataFrame:
    """Entries that are 0 (a null entry reads as 0) or negative."""
    e = graph.select(D.place(row).alias("_row"), F.posexplode("upstream_ids").alias("pos", "u")).withColumn("u", F.coalesce("u", F.lit(0)))
    return D.each(e, [(F.col("u") == 0, "ids.upstream_zero", _fmt("entry %d is 0", "pos"), "IdConstraint"), (F.col("u") < 0, "ids.upstream_negative", _fmt("entry %d is negative: %d", "pos", "u"), "IdConstraint")], "graph", ROW)


def snap_id_rules() -> list[D.Rule]:
    return [(F.col("id") <= 0, "ids.snap_id", _fmt("id %d is not positive", "id"), "IdConstraint"), (F.col("catchment_id") <= 0, "ids.snap_catchment_id", _fmt("catchment_id %d is not positive", "catchment_id"), "IdConstraint")]


def measure_rules(column: str, check_id: str) -> list[D.Rule]:
    """Not finite, else negative; zero is allowed. Nulls are the null check's."""
    v, there = F.col(column), F.col(column).isNotNull()
    return [(there & ~finite(column), check_id, F.lit(f"{column} is not finite"), "IdConstraint"), (there & finite(column) & (v < 0), check_id, F.concat(F.lit(f"{column} is negative: "), v.cast("string")), "IdConstraint")]


def box_rules(prefix: str, strictly: bool) -> list[D.Rule]:
    """Corners that are not finite; only where all are: range of longitude and latitude, and order of the corners."""
    there = F.lit(True)
    for c in BOX:
        there = there & F.col(c).isNotNull()
    good = there
    for c in BOX:
        good = good & finite(c)
    cid = f"ids.{prefix}_bbox"
    checks = [(there & ~finite(c), F.lit(f"{c} is not finite")) for c in BOX]
    checks += [(good & ~F.col(c).between(-180, 180), F.lit(f"{c} is out of range")) for c in ("bbox_minx", "bbox_maxx")]
    checks += [(good & ~F.col(c).between(-90, 90), F.lit(f"{c} is out of range")) for c in ("bbox_miny", "bbox_maxy")]
    for a, b in (("bbox_minx", "bbox_maxx"), ("bbox_miny", "bbox_maxy")):
        wrong = F.col(a) >= F.col(b) if strictly else F.col(a) > F.col(b)
        checks.append((good & wrong, F.lit(f"{a} and {b} are in the wrong order" + (" or equal" if strictly else ""))))
    return [(bad, cid, text, "IdConstraint") for bad, text in checks]


# ---- across tables --------------------------------------------------------------------------------------------------


def coverage(catchments: DataFrame, graph: DataFrame) -> DataFrame:
    """Ids of one table that the other lacks, both ways; sets, so each id once."""
    c, g = catchments.select("id").where("id is not null").distinct(), graph.select("id").where("id is not null").distinct()
    a = D.where(c.join(g, "id", "left_anti"), F.lit(True), "referential.catchment_not_in_graph", "ReferentialIntegrity", "cross_file", _fmt("catchment %d has no graph row", "id"), F.col("id"))
    b = D.where(g.join(c, "id", "left_anti"), F.lit(True), "referential.graph_not_in_catchments", "ReferentialIntegrity", "cross_file", _fmt("graph id %d has no catchment", "id"), F.col("id"))
    return a.unionByName(b)


def dangling(refs: DataFrame, parents: DataFrame, check_id: str, what: str, row: D.Place = ROW) -> DataFrame:
    """refs: ref and what row needs; one finding per occurrence of a reference that parents(id) lacks."""
    gone = refs.join(parents.select(F.col("id").alias("ref")).distinct(), "ref", "left_anti").where("ref is not null")
    return D.where(gone, F.lit(True), check_id, "ReferentialIntegrity", "cross_file", _fmt(f"{what} %d is not in catchments", "ref"), row)


def up_area(catchments: DataFrame, declared: bool) -> DataFrame:
    """Null up_area_km2 where the manifest declares it."""
    n = catchments.agg(F.count_if(F.col("up_area_km2").isNull()).alias("n"), F.count(F.lit(1)).alias("total"))
    return D.where(n, (F.col("n") > 0) & F.lit(declared), "values.up_area_consistency", "ValueConsistency", "catchments", _fmt("%d of %d rows have no up_area_km2", "n", "total"))


def union_box(catchments: DataFrame, *by: str) -> DataFrame:
    """minx, miny, maxx, maxy as doubles over the rows whose four corners are finite; nulls where there is none. One row,
    or one for each value of by."""
    good = F.lit(True)
    for c in BOX:
        good = good & finite(c)
    f = catchments.where(good)
    return f.groupBy(*by).agg(*[(F.min if "min" in c else F.max)(F.col(c).cast("double")).alias(c[5:]) for c in BOX])


def enclosure(boxes: DataFrame, row: D.Place = None) -> DataFrame:
    """boxes: minx, miny, maxx, maxy of catchments, and the manifest's bbox. Sides on which bbox does not enclose them;
    compared as doubles."""
    at = lambda i: F.col("bbox")[i]
    tests = [(F.col("minx") < at(0), "west"), (F.col("miny") < at(1), "south"), (F.col("maxx") > at(2), "east"), (F.col("maxy") > at(3), "north")]
    return D.each(boxes, [(bad, "values.bbox_enclosure", F.lit(f"catchments reach beyond the manifest's box in the {side}"), "ValueConsistency") for bad, side in tests], "cross_file", row)


def atom_count(counts: DataFrame, row: D.Place = None) -> DataFrame:
    """counts: n (rows of catchments) and declared (by the manifest, may be null)."""
    return D.where(counts, ~F.col("declared").eqNullSafe(F.col("n")), "schema.atom_count_mismatch", "Schema", "cross_file", F.concat(F.lit("manifest declares "), F.coalesce(F.col("declared").cast("string"), F.lit("no number of")), F.lit(" atoms, catchments has "), F.col("n").cast("string"), F.lit(" rows")), row)


# ---- manifest -------------------------------------------------------------------------------------------------------

#: RFC 3339 with an upper-case T; seconds up to 60, no calendar.
RFC3339 = r"\A\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])T(?:[01]\d|2[0-3]):[0-5]\d:(?:[0-5]\d|60)(?:\.\d+)?(?:[Zz]|[+-](?:[01]\d|2[0-3]):[0-5]\d)\z"
FABRIC_NAME = r"\A[a-z][a-z0-9_-]*\z"


def manifest(m: DataFrame, row: D.Place = None) -> DataFrame:
    """The rules for each field, for any number of manifests at once."""
    c = F.col
    size = F.size("bbox")
    at = lambda i: F.when(size == 4, F.element_at("bbox", F.when(size == 4, i + 1).otherwise(1)))

    def must(field: str, good: Column, text: str):
        return [(c(field).isNull(), f"manifest.{field}", F.lit(f"{field} is missing")), (c(field).isNotNull() & ~good, f"manifest.{field}", F.lit(f"{field} {text}"))]

    checks = [
        *must("format_version", c("format_version") == "0.1", "is not supported"),
        *must("fabric_name", F.rlike("fabric_name", F.lit(FABRIC_NAME)), "is empty or not in lower case"),
        *[(b, i, F.concat(t, F.lit(": "), F.coalesce("crs", F.lit("null")))) for b, i, t in must("crs", c("crs") == "EPSG:4326", "is not EPSG:4326")],
        *must("terminal_sink_id", c("terminal_sink_id") == 0, "is not 0"),
        *must("topology", c("topology").isin("tree", "dag"), "is neither tree nor dag"),
        *[(c(f).isNull(), f"manifest.{f}", F.lit(f"{f} is missing")) for f in ("has_up_area", "has_rasters", "has_snap")],
        (c("bbox").isNull(), "manifest.bbox", F.lit("bbox is missing")),
        (c("bbox").isNotNull() & (size != 4), "manifest.bbox", F.lit("bbox has not four numbers")),
        (at(0) >= at(2), "manifest.bbox", F.lit("bbox minx is not below maxx")),
        (at(1) >= at(3), "manifest.bbox", F.lit("bbox miny is not below maxy")),
        *must("atom_count", c("atom_count") >= 1, "is below 1"),
        *must("created_at", F.rlike("created_at", F.lit(RFC3339)), "is not an RFC 3339 time"),
        *must("adapter_version", F.length("adapter_version") > 0, "is empty"),
        (c("has_rasters") & c("flow_dir_encoding").isNull(), "manifest.flow_dir_encoding", F.lit("flow_dir_encoding is missing")),
        (c("has_rasters") & ~c("flow_dir_encoding").isin("esri", "taudem"), "manifest.flow_dir_encoding", F.lit("flow_dir_encoding is unknown")),
    ]
    return D.each(m, [(*c_, "Manifest") for c_ in checks], "manifest", row)


def buildable(m: DataFrame) -> DataFrame:
    """ok: the manifest meets every rule and its box lies on the globe; only then are rasters compared with it."""
    box = F.col("bbox")
    on_globe = F.forall(F.transform(box, lambda x, i: F.when(i % 2 == 0, F.abs(x) <= 180).otherwise(F.abs(x) <= 90)), lambda x: x)
    numbered = m.withColumn("_n", F.monotonically_increasing_id())
    bad = manifest(numbered, F.col("_n")).select(F.col("row").alias("_n")).distinct().withColumn("_bad", F.lit(True))
    return numbered.join(bad, "_n", "left").withColumn("ok", F.col("_bad").isNull() & F.coalesce(on_globe, F.lit(False))).drop("_n", "_bad")


# ---- geometry -------------------------------------------------------------------------------------------------------


def wkb_type(g: Column) -> Column:
    """The type code in the header: little-endian where the first byte is 1, else big-endian. Needs 5 bytes."""
    h = lambda i: F.hex(F.substring(g, i, 1))
    little = F.concat(h(5), h(4), h(3), h(2))
    big = F.concat(h(2), h(3), h(4), h(5))
    return F.conv(F.when(h(1) == "01", little).otherwise(big), 16, 10).cast("long")


def _readable(g: Column) -> Column:
    def run(s: pa.Array) -> pa.Array:
        return pa.array(wkb.readable(s))

    return F.arrow_udf(run, "boolean")(g)


def geometry(df: DataFrame, artifact: str, prefix: str, allowed: tuple[int, ...], row: D.Place = ROW) -> DataFrame:
    """Too short, else of a wrong type, else not to be parsed: the first that holds. Null geometry is the null check's."""
    g = F.col("geometry")
    long_ok = F.length(g) >= 5
    type_ok = (wkb_type(g) % 1000).isin(*allowed)
    x = df.where(g.isNotNull()).withColumn("_long", long_ok).withColumn("_type", F.coalesce(F.col("_long") & type_ok, F.lit(False)))
    x = x.withColumn("_wkb", _readable(F.when(F.col("_type"), g)))
    checks = [
        (~F.col("_long"), f"geometry.{prefix}_too_short", F.format_string("geometry has %d bytes", F.length(g))),
        (F.col("_long") & ~F.col("_type"), f"geometry.{prefix}_wrong_type", F.concat(F.lit("geometry has WKB type "), F.when(long_ok, wkb_type(g)).cast("string"))),
        (F.col("_type") & ~F.col("_wkb"), f"geometry.{prefix}_invalid_wkb", F.lit("geometry can't be parsed")),
    ]
    return D.each(x, [(*c, "Geometry") for c in checks], artifact, row)


def exact_sample(df: DataFrame, percent: float, key: str = "_row", seed: int = 0) -> DataFrame:
    """ceil(n * percent / 100) rows, at least one, the same for the same seed: those with the smallest hash.

    A histogram of the hash (of fixed size) tells the cut-off; rows below it are taken where they are, and only those of
    the bucket at the cut-off, one in 65,536, are sorted.
    """
    h = F.xxhash64(F.col(key), F.lit(seed))
    bucket = F.pmod(F.shiftright(h, 32), F.lit(1 << 16))
    counts = sorted((r[0], r[1]) for r in df.groupBy(bucket.alias("b")).count().collect())  # at most 65,536 rows
    n = sum(c for _, c in counts)
    k = min(max(-(-int(n * percent * 1_000_000) // 100_000_000), 1), n)
    for edge, c in counts:
        if k <= c:
            break
        k -= c
    if not n:
        return df.limit(0)
    at_edge = df.where(bucket == edge).orderBy(h, key).limit(k)
    return df.where(bucket < edge).unionByName(at_edge)


# ---- rasters and row groups -----------------------------------------------------------------------------------------

#: What the two rasters must hold.
RASTER_RULES = {"flow_dir": ("uint", 8, 255.0), "flow_acc": ("float", 32, -1.0)}


def raster(meta: DataFrame, box: list[float] | None, crs: str | None) -> DataFrame:
    """meta: label, sample_format, bits, is_tiled, nodata, crs, minx, miny, maxx, maxy, pixel_w, pixel_h.
    box and crs are given only where the manifest could be built."""
    checks = []
    for label, (form, bits, nodata) in RASTER_RULES.items():
        mine = F.col("label") == label
        checks += [
            (mine & ~((F.col("sample_format") == form) & (F.col("bits") == bits)), f"raster.{label}_dtype", F.lit(f"samples are not {form}{bits}")),
            (mine & ~F.col("is_tiled"), f"raster.{label}_not_tiled", F.lit("raster is not tiled")),
            (mine & F.col("nodata").isNull(), f"raster.{label}_nodata", F.lit("nodata is not declared")),
            (mine & (F.abs(F.col("nodata") - nodata) > 1e-9), f"raster.{label}_nodata", F.lit(f"nodata is not {nodata:g}")),
        ]
    if crs is not None:
        checks.append((F.col("crs").isNotNull() & (F.col("crs") != crs), "raster.crs_mismatch", F.concat(F.lit("raster is in "), "crs")))
    if box is not None:
        eps = F.greatest("pixel_w", "pixel_h") / 100
        inside = (F.col("minx") <= box[0] + eps) & (F.col("miny") <= box[1] + eps) & (F.col("maxx") >= box[2] - eps) & (F.col("maxy") >= box[3] - eps)
        checks.append((~inside, "raster.extent_not_contained", F.lit("raster does not contain the manifest's box")))
    parts = [D.each(meta.where(F.col("label") == label), [(*c, "Raster") for c in checks if f"raster.{label}" in c[1] or c[1] in ("raster.crs_mismatch", "raster.extent_not_contained")], label) for label in RASTER_RULES]
    return D.union(parts)


def row_groups(footers: DataFrame, artifact: str, least: int = 4096, most: int = 8192) -> DataFrame:
    """footers: row_group, n_rows, has_stats. Layout (a warning; the first group that offends) and statistics (an error)."""
    total = Window.partitionBy(F.lit(1))
    f = footers.withColumn("total", F.sum("n_rows").over(total)).withColumn("groups", F.count(F.lit(1)).over(total))
    small = F.col("total") < least
    count = f.where(small & (F.col("groups") > 1)).limit(1)
    size = f.where(~small & ~F.col("n_rows").between(least, most)).orderBy("row_group").limit(1)
    return D.union([
        D.where(count, F.lit(True), f"schema.{artifact}.rg_count", "Schema", artifact, _fmt("%d rows are in %d row groups instead of one", "total", "groups"), severity="WARN"),
        D.where(size, F.lit(True), f"schema.{artifact}.rg_size", "Schema", artifact, _fmt("row group %d has %d rows", "row_group", "n_rows"), severity="WARN"),
        D.where(footers, ~F.col("has_stats"), f"schema.{artifact}.bbox_stats_missing", "Schema", artifact, _fmt("row group %d has no statistics of the box", "row_group")),
    ])
