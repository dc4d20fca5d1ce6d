"""Queries of graph, box and snapping operators, with equivalent SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.operators import boxes, compilation, delineation, hierarchy, network, rasters, snapping
from rillstone.plans.data_quality import _P5, UP_SQL as _UP, _hierarchy
from rillstone.sources.schemas import BOX
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


def _graph(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "graph_arrow", "id", "upstream_ids")


@query(_P5 + "x as (select 1) select id, coalesce(u, 0) n_up, coalesce(v, 0) n_down from n left join (select v id, count(*) u from e group by 1) using (id) left join (select u id, count(*) v from e group by 1) using (id)")
def degrees(spark: SparkSession, d: str) -> DataFrame:
    return network.degrees(_graph(spark, d))


@query(_P5 + "x as (select 1) select id from n where id not in (select v from e)")
def headwaters(spark: SparkSession, d: str) -> DataFrame:
    return network.degrees(_graph(spark, d)).where("n_up = 0").select("id")


@query(_P5 + "x as (select 1) select id from roots")
def outlets(spark: SparkSession, d: str) -> DataFrame:
    return network.degrees(_graph(spark, d)).where("n_down = 0").select("id")


@query(_P5 + "x as (select 1) select u as id, count(*) n_down from e group by 1 having count(*) > 1")
def tree_offences(spark: SparkSession, d: str) -> DataFrame:
    return network.tree_offences(_graph(spark, d))


@query("select u as id, list_sort(list(distinct id)) downstream_ids from (select id, unnest(upstream_ids) u from graph_arrow where id is not null) where u is not null group by 1")
def downstream_inversion(spark: SparkSession, d: str) -> DataFrame:
    return network.downstream_lists(_graph(spark, d))


@query(_P5 + "core as (select u, v from e where u in (select v from e)), reach(a, b) as (select u, v from core union select r.a, c.v from reach r join core c on c.u = r.b), cyc as (select distinct a from reach where a = b union select u from e where u = v) select distinct id from (select a id from cyc union all select e2.b from cyc join reach e2 on e2.a = cyc.a union all select e.v from cyc join e on e.u = cyc.a)")
def cycle_nodes(spark: SparkSession, d: str) -> DataFrame:
    return network.blocked(_hierarchy(spark, d))


@query(_UP + " select q query_id, id from up")
def bfs_upstream(spark: SparkSession, d: str) -> DataFrame:
    h = _hierarchy(spark, d)
    return network.upstream(h, h.atoms.where("id % 50 = 0").select("id"))


_AREA = "ar as (select id, max(area_km2::double) a from catchments where area_km2 >= 0 and area_km2 < 'inf'::float group by 1)"


@query(_UP + ", " + _AREA + " select q query_id, count(*) n_atoms, sum(cast(coalesce(a, 0) as decimal(28,6))) area_km2 from up left join ar using (id) group by 1")
def delineate_summary(spark: SparkSession, d: str) -> DataFrame:
    h = _hierarchy(spark, d)
    found = network.upstream_totals(h, h.atoms.where("id % 50 = 0").select("id"), snapping.one_area(table(spark, d, "catchments", "id", "area_km2")), "a")
    return found.select("query_id", "n_atoms", F.col("total").cast("decimal(38,6)").alias("area_km2"))


@query(
    _P5
    + """dn as (select u, count(*) k, min(v) v from e where u <> v group by u), f as (select u id, v parent from dn where k = 1),
up(id, top) as (select id, id from n where id not in (select id from f) union all select f.id, up.top from up join f on f.parent = up.id),
anc(id, a) as (select id, id from up union select anc.id, f.parent from anc join f on f.id = anc.a), """
    + _AREA
    + " select a.a id, sum(cast(coalesce(ar.a, 0) as decimal(28,6))) total from anc a left join ar on ar.id = a.id where a.a in (select id from up) group by 1"
)
def up_area_tree(spark: SparkSession, d: str) -> DataFrame:
    return network.subtree_sums(_hierarchy(spark, d), snapping.one_area(table(spark, d, "catchments", "id", "area_km2")), "a").select("id", F.col("total").cast("decimal(38,6)").alias("total"))


_HEAP = "select o_orderkey + 1 id, cast(floor((o_orderkey + 1) / 2) as bigint) down, o_totalprice area from orders"


@query(f"select id, down, area, coalesce(down = 0 or row_number() over (partition by down order by area desc, id desc) = 1, true) is_mainstem from ({_HEAP})")
def mainstem(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey") + 1
    o = table(spark, d, "orders", "o_orderkey", "o_totalprice").select(k.alias("id"), F.floor(k / 2).cast("long").alias("down"), F.col("o_totalprice").alias("area"))
    return network.mainstem(o)


@query(f"select is_mainstem, count(*) n from (select coalesce(down = 0 or row_number() over (partition by down order by area desc, id desc) = 1, true) is_mainstem from ({_HEAP})) group by 1")
def mainstem_tally(spark: SparkSession, d: str) -> DataFrame:
    return mainstem(spark, d).groupBy("is_mainstem").agg(F.count(F.lit(1)).alias("n"))


@query("with k as (select o_orderkey + 1 id, floor((o_orderkey + 1) / 2)::bigint down from orders) select a.id, coalesce(list_sort(list(b.id) filter (b.id is not null)), []) upstream_ids from k a left join k b on b.down = a.id and b.id <> a.id group by a.id")
def edges_from_next_down(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey") + 1
    return network.edges_from_next_down(table(spark, d, "orders", "o_orderkey").select(k.alias("id"), F.floor(k / 2).cast("long").alias("next_down")))


# ---- boxes ----------------------------------------------------------------------------------------------------------

_SNAP_XY = "select id, (bbox_minx::double + bbox_maxx) / 2 x, (bbox_miny::double + bbox_maxy) / 2 y from snap"
_OK = " and ".join(f"not isnan({{0}}{c}) and abs({{0}}{c}) <= 500" for c in BOX) + " and {0}bbox_minx <= {0}bbox_maxx and {0}bbox_miny <= {0}bbox_maxy"


@query(f"select p.id point_key, c.id box_key from ({_SNAP_XY}) p join catchments c on x between c.bbox_minx::double and c.bbox_maxx::double and y between c.bbox_miny::double and c.bbox_maxy::double where {_OK.format('c.')} and not isnan(x) and abs(x) <= 500 and abs(y) <= 500")
def bbox_contains(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "snap", "id", *BOX)
    mid = lambda a, b: (F.col(a).cast("double") + F.col(b)) / 2
    pts = s.select("id", mid("bbox_minx", "bbox_maxx").alias("x"), mid("bbox_miny", "bbox_maxy").alias("y"))
    return boxes.containing(pts, table(spark, d, "catchments", "id", *BOX))


@query(f"select s.id a_key, c.id b_key from snap s join catchments c on s.bbox_minx::double <= c.bbox_maxx::double and c.bbox_minx::double <= s.bbox_maxx::double and s.bbox_miny::double <= c.bbox_maxy::double and c.bbox_miny::double <= s.bbox_maxy::double where {_OK.format('c.')} and {_OK.format('s.')}")
def bbox_intersects(spark: SparkSession, d: str) -> DataFrame:
    return boxes.intersecting(table(spark, d, "snap", "id", *BOX), table(spark, d, "catchments", "id", *BOX))


@query("select id, bbox_minx::double - 1e-4 minx, bbox_maxx::double + 1e-4 maxx, least(greatest(bbox_miny::double, -60.0), 60.0) miny, least(greatest(bbox_maxy::double, -60.0), 60.0) maxy from catchments where not isnan(bbox_minx) and not isnan(bbox_miny) and not isnan(bbox_maxx) and not isnan(bbox_maxy)")
def outward_bbox(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "catchments", "id", *BOX).where(" and ".join(f"not isnan({x})" for x in BOX)).where(" and ".join(f"{x} is not null" for x in BOX))
    return c.select("id", boxes.outward("bbox_minx").alias("minx"), boxes.outward("bbox_maxx").alias("maxx"), boxes.clamped("bbox_miny", -60.0, 60.0).alias("miny"), boxes.clamped("bbox_maxy", -60.0, 60.0).alias("maxy"))


@query("select id, case when bbox_minx >= bbox_maxx then bbox_minx::double - 1e-4 else bbox_minx::double end lo, case when bbox_minx >= bbox_maxx then bbox_maxx::double + 1e-4 else bbox_maxx::double end hi from snap")
def degenerate_inflate(spark: SparkSession, d: str) -> DataFrame:
    lo, hi = boxes.inflated("bbox_minx", "bbox_maxx")
    return table(spark, d, "snap", "id", "bbox_minx", "bbox_maxx").select("id", lo.alias("lo"), hi.alias("hi"))




def hilbert_sql(keys: str, source: str) -> str:
    """source: keys, x and y as whole numbers below 65,536."""
    return f"""with recursive g as ({source}),
h({keys}, i, x, y, d) as (select {keys}, 15, x, y, cast(0 as bigint) from g union all
  select {keys}, i - 1,
    case when ry = 0 then (case when rx = 1 then s - 1 - (y % s) else y % s end) else x % s end,
    case when ry = 0 then (case when rx = 1 then s - 1 - (x % s) else x % s end) else y % s end,
    d + s * s * (case when rx = 1 then 3 - ry else ry end)
  from (select *, cast(pow(2, i) as bigint) s, cast(floor(x / pow(2, i)) as bigint) % 2 rx, cast(floor(y / pow(2, i)) as bigint) % 2 ry from h where i >= 0))
select {keys}, d as h from h where i = -1"""


def _grid_sql(a: str, b: str, low: int) -> str:
    v = f"(({a}::double + {b}) / 2 + {low}) / {2 * low} * 65535"
    return f"coalesce(case when isnan({v}) then 0 else least(greatest(floor({v}), 0), 65535) end, 0)::bigint"


#: SQL: id, basin, h of the catchments along the globe's curve.
WORLD_SQL = hilbert_sql("id, basin", f"select id, basin, {_grid_sql('bbox_minx', 'bbox_maxx', 180)} x, {_grid_sql('bbox_miny', 'bbox_maxy', 90)} y from catchments")


@query(hilbert_sql("id", "select c_custkey id, (c_custkey * 7919) % 65536 x, (c_custkey * 104729) % 65536 y from customer"))
def hilbert_key(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer", "c_custkey").select(k.alias("id"), boxes.hilbert((k * 7919) % 65536, (k * 104729) % 65536).alias("h"))


@query(WORLD_SQL)
def hilbert_order(spark: SparkSession, d: str) -> DataFrame:
    c = boxes.world_order(table(spark, d, "catchments", "id", "basin", *BOX))
    return c.select("id", "basin", "h").repartitionByRange(F.col("h"), F.col("basin"), F.col("id")).sortWithinPartitions("h", "basin", "id")


# ---- snapping: outlets are the customers' places on a grid of degrees -------------------------------------------------

_CAND = """with s as (select id, weight, is_mainstem, (bbox_minx::double + bbox_maxx) / 2 lon, (bbox_miny::double + bbox_maxy) / 2 lat from snap),
o as (select id outlet_id, lon olon, lat olat from s where id % 50 = 0),
c as (select outlet_id, id, weight, coalesce(is_mainstem, false) m, 2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin(radians(lat - olat) / 2), 2) + cos(radians(olat)) * cos(radians(lat)) * pow(sin(radians(lon - olon) / 2), 2)))) dist from o join s on abs(lat - olat) < 0.02),
k as (select * from c where dist <= 2000)"""


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    mid = lambda a, b: (F.col(a).cast("double") + F.col(b)) / 2
    s = table(spark, d, "snap", "id", "weight", "is_mainstem", *BOX).select("id", "weight", "is_mainstem", mid("bbox_minx", "bbox_maxx").alias("lon"), mid("bbox_miny", "bbox_maxy").alias("lat"))
    o = s.where("id % 50 = 0").select(F.col("id").alias("outlet_id"), "lon", "lat")
    return snapping.within(o, s, 2000.0)


@query(_CAND + " select outlet_id, id from (select *, row_number() over (partition by outlet_id order by weight desc, m desc, dist, id) rn from k where weight is not null and not isnan(weight) and not isinf(weight)) where rn = 1")
def snap_cascade(spark: SparkSession, d: str) -> DataFrame:
    return snapping.cascade(_candidates(spark, d).where("weight is not null and not isnan(weight) and abs(weight) < float('inf')"))


@query(_CAND + " select outlet_id, id from (select *, row_number() over (partition by outlet_id order by dist, id) rn from k) where rn = 1")
def snap_distance_first(spark: SparkSession, d: str) -> DataFrame:
    return snapping.nearest(_candidates(spark, d))


@query(_CAND + " select outlet_id, id from (select *, row_number() over (partition by outlet_id order by m desc, dist, id) rn from k) where rn = 1")
def snap_mainstem_first(spark: SparkSession, d: str) -> DataFrame:
    return snapping.nearest(_candidates(spark, d), mainstem_first=True)


@query(_P5 + "d as (select n.id, coalesce(u, 0) u, coalesce(v, 0) v from n left join (select v id, count(*) u from e group by 1) using (id) left join (select u id, count(*) v from e group by 1) using (id)) select count(*) n_atoms, count(*) filter (u = 0) n_headwaters, count(*) filter (v = 0) n_outlets, max(u) most_upstream, max(v) most_downstream from d")
def graph_summary(spark: SparkSession, d: str) -> DataFrame:
    return network.summary(_graph(spark, d))


@query(_P5 + _AREA + ", best as (select v, (list(u order by coalesce(a, 0) desc, u desc))[1] u from e left join ar on ar.id = e.u where u <> v group by v), up(q, id) as (select id, id from n where id % 50 = 0 union select up.q, best.u from up join best on best.v = up.id) select q query_id, id from up")
def mainstem_upstream(spark: SparkSession, d: str) -> DataFrame:
    area = snapping.one_area(table(spark, d, "catchments", "id", "area_km2")).withColumnRenamed("a", "area")
    h = hierarchy.build(network.mainstem_graph(_graph(spark, d), area))
    return network.upstream(h, h.atoms.where("id % 50 = 0").select("id"))


@query("select min(id) least, max(id) most, count(*) n_rows, count(distinct id) n_distinct from catchments")
def id_range(spark: SparkSession, d: str) -> DataFrame:
    return compilation.id_range(table(spark, d, "catchments", "id"))


@query("with s as (select basin, min(topology) topology, min(region) region from manifest where basin is not null group by 1) select c.id, c.basin, topology, region, count(*) n from catchments c left join s on s.basin = c.basin group by all")
def inherited(spark: SparkSession, d: str) -> DataFrame:
    j = compilation.inherit(table(spark, d, "catchments", "id", "basin"), table(spark, d, "manifest", "basin", "topology", "region"), "basin", ["topology", "region"])
    return j.groupBy("id", "basin", "topology", "region").agg(F.count(F.lit(1)).alias("n"))


@query(_CAND + " select outlet_id, id, rank from (select outlet_id, id, row_number() over (partition by outlet_id order by weight desc, m desc, dist, id) rank from k where weight is not null and not isnan(weight) and not isinf(weight)) where rank <= 3")
def snap_ranked(spark: SparkSession, d: str) -> DataFrame:
    c = _candidates(spark, d).where("weight is not null and not isnan(weight) and abs(weight) < float('inf')")
    return snapping.ranked(c, 3).select("outlet_id", "id", "rank")


@query("select distinct (bbox_miny::double + bbox_maxy) / 2 latitude, pow(0.01 * 111.32, 2) * cos(radians((bbox_miny::double + bbox_maxy) / 2)) km2 from catchments where abs((bbox_miny::double + bbox_maxy) / 2) <= 90 and not isnan(bbox_miny) and not isnan(bbox_maxy)")
def pixel_areas(spark: SparkSession, d: str) -> DataFrame:
    mid = (F.col("bbox_miny").cast("double") + F.col("bbox_maxy")) / 2
    c = table(spark, d, "catchments", "bbox_miny", "bbox_maxy").where(F.abs(mid) <= 90).where("not isnan(bbox_miny) and not isnan(bbox_maxy)")
    return c.select(mid.alias("latitude")).distinct().select("latitude", rasters.pixel_area_km2(F.col("latitude"), 0.01).alias("km2"))


# ---- whole delineation: outlets at every fiftieth snap feature -----------------------------------------------------------


def _outlets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    mid = lambda a, b: (F.col(a).cast("double") + F.col(b)) / 2
    s = table(spark, d, "snap", "id", "catchment_id", "weight", "is_mainstem", *BOX).select("id", "catchment_id", "weight", "is_mainstem", mid("bbox_minx", "bbox_maxx").alias("lon"), mid("bbox_miny", "bbox_maxy").alias("lat"))
    return s.where("id % 50 = 0").select(F.col("id").alias("outlet_id"), "lon", "lat"), s


_PLACED = """o as (select outlet_id, min({'lon': olon, 'lat': olat}) p from (select id outlet_id, (bbox_minx::double + bbox_maxx) / 2 olon, (bbox_miny::double + bbox_maxy) / 2 olat from snap where id % 50 = 0) where not isnan(olon) and not isnan(olat) and abs(olon) <= 360 and abs(olat) <= 90 group by 1),
own as (select id, min(catchment_id) atom_id from snap where id is not null group by 1 having min(catchment_id) in (select id from n)),
k as (select outlet_id, s.id, atom_id, weight, coalesce(is_mainstem, false) m, 2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin(radians(lat - o.p.lat) / 2), 2) + cos(radians(o.p.lat)) * cos(radians(lat)) * pow(sin(radians(lon - o.p.lon) / 2), 2)))) dist
  from o join (select id, weight, is_mainstem, (bbox_minx::double + bbox_maxx) / 2 lon, (bbox_miny::double + bbox_maxy) / 2 lat from snap where weight is not null and not isnan(weight) and not isinf(weight)) s on abs(lat - o.p.lat) < 0.02 join own on own.id = s.id),
pick as (select outlet_id, atom_id from (select *, row_number() over (partition by outlet_id order by weight desc, m desc, dist, id) rn from k where dist <= 2000) where rn = 1),
"""


@query(
    _P5
    + _PLACED
    + """up(q, id) as (select distinct atom_id, atom_id from pick union select up.q, e.u from up join e on e.v = up.id)
select outlet_id, pick.atom_id, 'snap' how, n_atoms from pick join (select q, count(*) n_atoms from up group by 1) on q = pick.atom_id"""
)
def delineate(spark: SparkSession, d: str) -> DataFrame:
    """Outlets that a snap feature takes; the others are in delineate_shapes."""
    o, s = _outlets(spark, d)
    found = delineation.delineate(o, s, table(spark, d, "catchments", "id", "geometry"), _hierarchy(spark, d))
    return found.where("how = 'snap'").select("outlet_id", "atom_id", "how", "n_atoms")


@query()
def delineate_shapes(spark: SparkSession, d: str) -> DataFrame:
    o, s = _outlets(spark, d)
    return delineation.delineate(o, s, table(spark, d, "catchments", "id", "geometry"), _hierarchy(spark, d))
