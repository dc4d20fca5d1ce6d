"""Queries of the reference's own operators over the river tables and the star-schema tables, with equivalent SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.operators import checks
from rillstone.operators import diagnostics as D
from rillstone.plans.data_quality import WALK_SQL, _u32
from rillstone.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _n(d: DataFrame) -> DataFrame:
    return d.groupBy("check_id", "message").agg(F.count(F.lit(1)).alias("n"))


# ---- ids and values -------------------------------------------------------------------------------------------------


def _case(items: list[tuple[str, str, str]], src: str) -> str:
    """One row per finding: (predicate, check_id, message SQL)."""
    return " union all ".join(f"select '{c}' check_id, {m} as message from {src} where {p}" for p, c, m in items)


def _counted(inner: str) -> str:
    return f"select check_id, message, count(*) n from ({inner}) group by all"


_ZERO = "'id is 0, which is reserved for the terminal sink'"


@query(_counted(_case([("id = 0", "ids.catchment_zero", _ZERO), ("id < 0", "ids.catchment_negative", "'id ' || id || ' is negative'")], "catchments") + " union all " + _case([("id = 0", "ids.graph_zero", _ZERO), ("id < 0", "ids.graph_negative", "'id ' || id || ' is negative'")], "graph_arrow") + " union all " + _case([("o_orderkey = 0", "ids.order_zero", _ZERO), ("o_orderkey < 0", "ids.order_negative", "''")], "orders")))
def id_signs(spark: SparkSession, d: str) -> DataFrame:
    c, g, o = (table(spark, d, t, k) for t, k in (("catchments", "id"), ("graph_arrow", "id"), ("orders", "o_orderkey")))
    parts = [D.each(c, checks.id_rules("catchment"), "catchments"), D.each(g, checks.id_rules("graph"), "graph"), D.each(o, checks.id_rules("order", "o_orderkey"), "orders")]
    return _n(D.union(parts))


def _again_sql(t: str, prefix: str) -> str:
    rows = f"(select id, row_number() over () - 1 r from {t})"
    return f"select 'ids.{prefix}_duplicate' check_id, r as row, 'id ' || id || ' occurs again; first in row ' || f as message from (select *, min(r) over (partition by id) f from {rows} where id > 0) where r > f"


@query(" union all ".join(_again_sql(t, p) for t, p in (("catchments", "catchment"), ("graph_arrow", "graph"), ("snap", "snap"))))
def id_duplicate(spark: SparkSession, d: str) -> DataFrame:
    parts = [checks.duplicates(checks.with_row(table(spark, d, t)).select("id", "_row"), a, p) for t, a, p in (("catchments", "catchments", "catchment"), ("graph_arrow", "graph", "graph"), ("snap", "snap", "snap"))]
    return D.union(parts).select("check_id", "row", "message")


@query(_counted("select case when u = 0 then 'ids.upstream_zero' else 'ids.upstream_negative' end check_id, case when u = 0 then 'entry ' || pos || ' is 0' else 'entry ' || pos || ' is negative: ' || u end as message from (select coalesce(u, 0) u, pos from (select unnest(upstream_ids) u, unnest(range(len(upstream_ids))) pos from graph_arrow)) where u <= 0"))
def upstream_entry_signs(spark: SparkSession, d: str) -> DataFrame:
    return _n(checks.upstream_entries(table(spark, d, "graph_arrow", "upstream_ids"), None))


@query(_counted(_case([("id <= 0", "ids.snap_id", "'id ' || id || ' is not positive'"), ("catchment_id <= 0", "ids.snap_catchment_id", "'catchment_id ' || catchment_id || ' is not positive'")], "snap")))
def snap_ids(spark: SparkSession, d: str) -> DataFrame:
    return _n(D.each(table(spark, d, "snap", "id", "catchment_id"), checks.snap_id_rules(), "snap"))


def _sign_sql(t: str, c: str, cid: str) -> str:
    return f"select '{cid}' check_id, case when isnan({c}) or isinf({c}) then 'not finite' else 'negative' end as kind, count(*) n from {t} where isnan({c}) or isinf({c}) or {c} < 0 group by all"


@query(_sign_sql("catchments", "area_km2", "ids.catchment_area") + " union all " + _sign_sql("snap", "weight", "ids.snap_weight"))
def measure_invalid(spark: SparkSession, d: str) -> DataFrame:
    a = D.each(table(spark, d, "catchments", "area_km2"), checks.measure_rules("area_km2", "ids.catchment_area"), "catchments")
    w = D.each(table(spark, d, "snap", "weight"), checks.measure_rules("weight", "ids.snap_weight"), "snap")
    return a.unionByName(w).groupBy("check_id", F.when(F.col("sub") == 0, "not finite").otherwise("negative").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def _box_sql(t: str, cid: str, strictly: bool) -> str:
    b = ("bbox_minx", "bbox_miny", "bbox_maxx", "bbox_maxy")
    there = " and ".join(f"{c} is not null" for c in b)
    good = there + " and " + " and ".join(f"not isnan({c}) and not isinf({c})" for c in b)
    items = [(f"{there} and (isnan({c}) or isinf({c}))", cid, f"'{c} is not finite'") for c in b]
    items += [(f"{good} and not ({c} between -180 and 180)", cid, f"'{c} is out of range'") for c in (b[0], b[2])]
    items += [(f"{good} and not ({c} between -90 and 90)", cid, f"'{c} is out of range'") for c in (b[1], b[3])]
    items += [(f"{good} and {x} {'>=' if strictly else '>'} {y}", cid, f"'{x} and {y} are in the wrong order{' or equal' if strictly else ''}'") for x, y in ((b[0], b[2]), (b[1], b[3]))]
    return _counted(_case(items, t))


@query(_box_sql("catchments", "ids.catchment_bbox", True))
def bbox_strict(spark: SparkSession, d: str) -> DataFrame:
    return _n(D.each(table(spark, d, "catchments", *checks.BOX), checks.box_rules("catchment", True), "catchments"))


@query(_box_sql("snap", "ids.snap_bbox", False))
def bbox_nonstrict(spark: SparkSession, d: str) -> DataFrame:
    return _n(D.each(table(spark, d, "snap", *checks.BOX), checks.box_rules("snap", False), "snap"))


def _listed(capped: DataFrame) -> DataFrame:
    """check_id, listed, more: how many findings of each check are listed, and how many the last row stands for."""
    rest = F.col("sub") == 2**31 - 1
    more = F.max(F.when(rest, F.regexp_extract("message", r"(\d+)", 1).cast("long")))
    return capped.groupBy("check_id").agg(F.count_if(~rest).alias("listed"), F.coalesce(more, F.lit(0)).alias("more"))


def _nulls_sql(t: str, artifact: str, required: dict[str, list[str]]) -> str:
    return " union all ".join(f"select '{artifact}.null_{k}' check_id, count(*) n from {t} where {' or '.join(f'{c} is null' for c in cols)}" for k, cols in required.items())


_REQUIRED = {
    "catchments": ("catchments", {"id": ["id"], "area_km2": ["area_km2"], "bbox": list(checks.BOX), "geometry": ["geometry"]}),
    "graph_arrow": ("graph", {"id": ["id"], "upstream_ids": ["upstream_ids"]}),
    "snap": ("snap", {"id": ["id"], "catchment_id": ["catchment_id"], "weight": ["weight"], "is_mainstem": ["is_mainstem"], "bbox": list(checks.BOX), "geometry": ["geometry"]}),
}


@query(f"select check_id, least(n, 10) listed, greatest(n - 10, 0) more from ({' union all '.join(_nulls_sql(t, a, r) for t, (a, r) in _REQUIRED.items())}) where n > 0")
def null_required(spark: SparkSession, d: str) -> DataFrame:
    return _listed(D.cap(D.union([D.each(table(spark, d, t), checks.null_rules(a, r), a) for t, (a, r) in _REQUIRED.items()])))


@query("select 'values.up_area_consistency' check_id, n || ' of ' || total || ' rows have no up_area_km2' as message from (select count(*) filter (up_area_km2 is null) n, count(*) total from catchments) where n > 0")
def up_area_nulls(spark: SparkSession, d: str) -> DataFrame:
    return checks.up_area(table(spark, d, "catchments", "up_area_km2"), True).select("check_id", "message")


_FINITE = " and ".join(f"{c} is not null and not isnan({c}) and not isinf({c})" for c in checks.BOX)


@query(f"select basin, min(bbox_minx::double) minx, min(bbox_miny::double) miny, max(bbox_maxx::double) maxx, max(bbox_maxy::double) maxy from catchments where {_FINITE} group by basin")
def bbox_union(spark: SparkSession, d: str) -> DataFrame:
    return checks.union_box(table(spark, d, "catchments", "basin", *checks.BOX), "basin")


@query(f"""with u as (select basin, min(bbox_minx::double) minx, min(bbox_miny::double) miny, max(bbox_maxx::double) maxx, max(bbox_maxy::double) maxy from catchments where {_FINITE} group by basin)
select basin, 'catchments reach beyond the manifest''s box in the ' || side as message from (select m.basin, unnest([case when minx < bbox[1] then 'west' end, case when miny < bbox[2] then 'south' end, case when maxx > bbox[3] then 'east' end, case when maxy > bbox[4] then 'north' end]) side
from manifest m join u using (basin) where len(bbox) = 4) where side is not null""")
def bbox_enclosure(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "manifest", "basin", "bbox").where(F.size("bbox") == 4)
    found = checks.enclosure(checks.union_box(table(spark, d, "catchments", "basin", *checks.BOX), "basin").join(m, "basin"), F.col("basin"))
    return found.select(F.col("row").cast("int").alias("basin"), "message")


@query("select m.basin, 'manifest declares ' || coalesce(atom_count::varchar, 'no number of') || ' atoms, catchments has ' || coalesce(n, 0) || ' rows' as message from manifest m left join (select basin, count(*) n from catchments group by 1) c using (basin) where atom_count is distinct from coalesce(n, 0)")
def atom_count_mismatch(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "catchments", "basin").groupBy("basin").agg(F.count(F.lit(1)).alias("n"))
    counts = table(spark, d, "manifest", "basin", "atom_count").join(n, "basin", "left").select("basin", F.col("atom_count").alias("declared"), F.coalesce("n", F.lit(0)).alias("n"))
    return checks.atom_count(counts, F.col("basin")).select(F.col("row").cast("int").alias("basin"), "message")


# ---- references -----------------------------------------------------------------------------------------------------


@query("select 'referential.catchment_not_in_graph' check_id, id from (select distinct id from catchments where id is not null) where id not in (select id from graph_arrow where id is not null) union all select 'referential.graph_not_in_catchments', id from (select distinct id from graph_arrow where id is not null) where id not in (select id from catchments where id is not null)")
def coverage_both_ways(spark: SparkSession, d: str) -> DataFrame:
    found = checks.coverage(table(spark, d, "catchments", "id"), table(spark, d, "graph_arrow", "id"))
    return found.select("check_id", F.col("row").alias("id"))


@query("select id, 'upstream id ' || u || ' is not in catchments' as message, count(*) n from (select id, unnest(upstream_ids) u from graph_arrow) where u is not null and u not in (select id from catchments where id is not null) group by all")
def upstream_dangling(spark: SparkSession, d: str) -> DataFrame:
    refs = table(spark, d, "graph_arrow", "id", "upstream_ids").select("id", F.explode("upstream_ids").alias("ref"))
    found = checks.dangling(refs, table(spark, d, "catchments", "id"), "referential.upstream_not_in_catchments", "upstream id", F.col("id"))
    return found.groupBy(F.col("row").alias("id"), "message").agg(F.count(F.lit(1)).alias("n"))


@query("select catchment_id as ref, count(*) n from snap where catchment_id is not null and catchment_id not in (select id from catchments where id is not null) group by all")
def snap_dangling(spark: SparkSession, d: str) -> DataFrame:
    found = checks.dangling(table(spark, d, "snap", F.col("catchment_id").alias("ref")), table(spark, d, "catchments", "id"), "referential.snap_catchment_not_in_catchments", "catchment", F.col("ref"))
    return found.groupBy(F.col("row").alias("ref")).agg(F.count(F.lit(1)).alias("n"))


# ---- manifests and reports ------------------------------------------------------------------------------------------

_TS = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])T([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)(\.\d+)?([Zz]|[+-]([01]\d|2[0-3]):[0-5]\d)$"
_MANIFEST_SQL = " union all ".join(
    f"select basin, 'manifest.{f}' check_id from manifest where {p}"
    for f, p in [
        ("format_version", "format_version is distinct from '0.1'"),
        ("fabric_name", "fabric_name is null or not regexp_full_match(fabric_name, '[a-z][a-z0-9_-]*')"),
        ("crs", "crs is distinct from 'EPSG:4326'"),
        ("terminal_sink_id", "terminal_sink_id is distinct from 0"),
        ("topology", "topology is null or topology not in ('tree', 'dag')"),
        ("has_up_area", "has_up_area is null"),
        ("has_rasters", "has_rasters is null"),
        ("has_snap", "has_snap is null"),
        ("bbox", "bbox is null or len(bbox) <> 4"),
        ("bbox", "len(bbox) = 4 and bbox[1] >= bbox[3]"),
        ("bbox", "len(bbox) = 4 and bbox[2] >= bbox[4]"),
        ("atom_count", "atom_count is null or atom_count < 1"),
        ("created_at", f"created_at is null or not regexp_full_match(created_at, '{_TS[1:-1]}')"),
        ("adapter_version", "coalesce(adapter_version, '') = ''"),
        ("flow_dir_encoding", "has_rasters and (flow_dir_encoding is null or flow_dir_encoding not in ('esri', 'taudem'))"),
    ]
)


@query(_MANIFEST_SQL)
def manifest_checks(spark: SparkSession, d: str) -> DataFrame:
    return checks.manifest(table(spark, d, "manifest"), F.col("basin")).select(F.col("row").cast("int").alias("basin"), "check_id")


_WARNED = ("manifest.crs", "manifest.bbox")


def _manifest_findings(spark: SparkSession, d: str) -> DataFrame:
    """Two of the checks as warnings, so that both severities occur."""
    m = checks.manifest(table(spark, d, "manifest"), F.col("basin"))
    return m.withColumn("severity", F.when(F.col("check_id").isin(*_WARNED), "WARN").otherwise(F.col("severity")))


@query(f"select check_id, count(*) filter (check_id not in {_WARNED}) errors, count(*) filter (check_id in {_WARNED}) warnings, 0::bigint infos, count(*) filter (check_id not in {_WARNED}) = 0 valid from ({_MANIFEST_SQL}) group by 1")
def severity_counts(spark: SparkSession, d: str) -> DataFrame:
    return D.counts(_manifest_findings(spark, d), "check_id")


@query(f"select 'ERROR' severity, count(*) n from ({_MANIFEST_SQL})")
def strict_promotion(spark: SparkSession, d: str) -> DataFrame:
    return D.strict(_manifest_findings(spark, d)).groupBy("severity").agg(F.count(F.lit(1)).alias("n"))


@query("select check_id, least(n, 100) listed, greatest(n - 100, 0) more from (select 'ids.catchment_area' check_id, count(*) n from catchments where isnan(area_km2) or isinf(area_km2) or area_km2 < 0) where n > 0")
def violation_cap(spark: SparkSession, d: str) -> DataFrame:
    found = D.each(checks.with_row(table(spark, d, "catchments")), checks.measure_rules("area_km2", "ids.catchment_area"), "catchments", checks.ROW)
    return _listed(D.cap(found))


@query("""with g as (select geometry, octet_length(geometry) n, hex(geometry) h from catchments where geometry is not null),
t as (select n, case when n >= 5 then cast('0x' || case when h[1:2] = '01' then h[9:10] || h[7:8] || h[5:6] || h[3:4] else h[3:10] end as bigint) % 1000 end k from g)
select case when n < 5 then 'geometry.catchment_too_short' when k not in (3, 6) then 'geometry.catchment_wrong_type' else 'geometry.header_ok' end check_id, count(*) n from t group by 1""")
def geometry_headers(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "catchments", "geometry").where("geometry is not null")
    short = F.length("geometry") < 5
    kind = F.when(short, "geometry.catchment_too_short").when(~(checks.wkb_type(F.col("geometry")) % 1000).isin(3, 6), "geometry.catchment_wrong_type").otherwise("geometry.header_ok")
    return g.groupBy(kind.alias("check_id")).agg(F.count(F.lit(1)).alias("n"))


_TYPED = "select *, octet_length(geometry) len, hex(geometry) h, hex(geometry)[1:2] = '01' le from"


@query(
    f"""with recursive cg as (select row_number() over () g, id, len, h, le from ({_TYPED} catchments) where geometry is not null),
ck as (select *, {_u32("1")} k, {_u32("5")} n from cg where len >= 5),
{WALK_SQL}sk as (select *, {_u32("1")} k, {_u32("5")} n from ({_TYPED} snap) where geometry is not null),
found as (select case when cg.len < 5 then 'geometry.catchment_too_short' when k % 1000 not in (3, 6) then 'geometry.catchment_wrong_type' when cg.h[1:2] not in ('00', '01') or cg.len < 9 or cg.g in (select g from walk where bad) then 'geometry.catchment_invalid_wkb' end check_id from cg left join ck using (g)
  union all select case when len < 5 then 'geometry.snap_too_short' when k % 1000 not in (1, 2) then 'geometry.snap_wrong_type' when h[1:2] not in ('00', '01') or k = 1 and len < 21 or k = 2 and coalesce(9 + 16 * n > len, true) then 'geometry.snap_invalid_wkb' end from sk)
select check_id, count(*) n from found where check_id is not null group by 1"""
)
def geometry_checks(spark: SparkSession, d: str) -> DataFrame:
    c = checks.geometry(table(spark, d, "catchments", "geometry"), "catchments", "catchment", (3, 6), None)
    s = checks.geometry(table(spark, d, "snap", "geometry"), "snap", "snap", (1, 2), None)
    return c.unionByName(s).groupBy("check_id").agg(F.count(F.lit(1)).alias("n"))
