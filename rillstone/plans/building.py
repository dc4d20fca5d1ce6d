"""Queries of compilation and raster operators, with equivalent SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.operators import checks, compilation, network, rasters
from rillstone.plans.drainage import WORLD_SQL
from rillstone.sources import geotiff
from rillstone.sources.schemas import BOX
from rillstone.sources.tables import table
from rillstone.storage import Workspace

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_FIELDS = compilation.CONSENSUS


@query(" union all ".join(f"select '{f}' field, count(distinct {f}) + max(({f} is null)::int) n_values, count(distinct {f}) + max(({f} is null)::int) = 1 agreed from manifest" for f in _FIELDS))
def basin_consensus(spark: SparkSession, d: str) -> DataFrame:
    return compilation.consensus(table(spark, d, "manifest"))


@query("select greatest(min(bbox[1]) - 1e-4, -180.0) minx, greatest(min(bbox[2]) - 1e-4, -90.0) miny, least(max(bbox[3]) + 1e-4, 180.0) maxx, least(max(bbox[4]) + 1e-4, 90.0) maxy, sum(atom_count)::bigint atom_count from manifest where len(bbox) = 4")
def basin_envelope(spark: SparkSession, d: str) -> DataFrame:
    return compilation.envelope(table(spark, d, "manifest"))


@query("select id, count(distinct basin) n_basins, count(*) n_rows from catchments where id is not null group by id having count(distinct basin) > 1")
def id_collision(spark: SparkSession, d: str) -> DataFrame:
    return compilation.collisions(table(spark, d, "catchments", "id", "basin"))


@query("with a as (select distinct id from catchments where id is not null), b as (select distinct id from graph_arrow where id is not null), c as (select count(*) n from a where id in (select id from b)) select (select count(*) from a) n_a, (select count(*) from b) n_b, n n_common, n / (select count(*) from a) share_a, n / (select count(*) from b) share_b from c")
def comid_reconcile(spark: SparkSession, d: str) -> DataFrame:
    return compilation.coverage(table(spark, d, "catchments", "id"), table(spark, d, "graph_arrow", "id"))


@query("select l_orderkey, l_linenumber, cast([x for x in [l_partkey, l_suppkey] if x % 2 = 0] as bigint[]) ids from lineitem")
def csv_int_list(spark: SparkSession, d: str) -> DataFrame:
    item = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    text = lambda c: F.when(F.col(c) % 2 == 0, F.format_string(" %d ", c)).otherwise(F.lit(" "))
    return item.select("l_orderkey", "l_linenumber", network.csv_ids(F.concat_ws(",", text("l_partkey"), text("l_suppkey"))).alias("ids"))


@query("select basin, coalesce(regexp_full_match(created_at, '\\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\\d|3[01])T([01]\\d|2[0-3]):[0-5]\\d:([0-5]\\d|60)(\\.\\d+)?([Zz]|[+-]([01]\\d|2[0-3]):[0-5]\\d)'), false) ok from manifest")
def rfc3339(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manifest", "basin", "created_at").select("basin", F.coalesce(F.rlike("created_at", F.lit(checks.RFC3339)), F.lit(False)).alias("ok"))


@query("select basin, coalesce(regexp_full_match(fabric_name, '[a-z][a-z0-9_-]*'), false) ok from manifest")
def fabric_name(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manifest", "basin", "fabric_name").select("basin", F.coalesce(F.rlike("fabric_name", F.lit(checks.FABRIC_NAME)), F.lit(False)).alias("ok"))


@query("""with n as (select basin, count(*) * 37 n from catchments group by 1), k as (select basin, n, case when ceil(n / greatest(1, floor(n / 4096))) > 8192 then 1 else greatest(1, floor(n / 4096)) end k from n)
select basin, i::bigint as group_no, (floor(n / k) + case when i < n % k then 1 else 0 end)::bigint size from k, unnest(range(k::bigint)) t(i)""")
def row_group_bounds(spark: SparkSession, d: str) -> DataFrame:
    def run(frames):
        for pdf in frames:
            rows = [(b, k, stop - start) for b, n in zip(pdf["basin"], pdf["n"]) for k, (start, stop) in enumerate(compilation.group_bounds(int(n)))]
            yield pd.DataFrame(rows, columns=["basin", "group_no", "size"])

    n = table(spark, d, "catchments", "basin").groupBy("basin").agg((F.count(F.lit(1)) * 37).alias("n"))
    return n.mapInPandas(run, "basin int, group_no long, size long")


@query(WORLD_SQL)
def global_sort(spark: SparkSession, d: str) -> DataFrame:
    return compilation.merge(table(spark, d, "catchments", "id", "basin", *BOX)).select("id", "basin", "h")


# ---- rasters: tiles of lineitem, a pixel to a row --------------------------------------------------------------------


def _tiles(spark: SparkSession, d: str, value) -> DataFrame:
    item = table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    tile = F.floor(F.col("l_orderkey") / 64).cast("int")
    return item.groupBy(tile.alias("tile_row"), F.lit(0).alias("tile_col")).agg(F.sort_array(F.collect_list(F.struct("l_orderkey", "l_linenumber", value.alias("v")))).alias("p")).select("tile_row", "tile_col", F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(1.0).alias("pixel"), F.lit(8).alias("width"), F.col("p.v").alias("values"))


@query("select case when v in (0, 1, 2, 4, 8, 16, 32, 64, 128, 255) then v else 255 end::int as value, count(*) n from (select (l_partkey % 256)::int v from lineitem) group by 1")
def raster_remap(spark: SparkSession, d: str) -> DataFrame:
    t = _tiles(spark, d, (F.col("l_partkey") % 256).cast("int"))
    return rasters.histogram(t.withColumn("values", rasters.transcode_direction(F.col("values"))))


@query("select (case when v = 0 then -1 else v end)::float as value, count(*) n from (select l_partkey % 100 v from lineitem) group by 1")
def raster_accumulation(spark: SparkSession, d: str) -> DataFrame:
    t = _tiles(spark, d, F.col("l_partkey") % 100)
    return rasters.histogram(t.withColumn("values", rasters.transcode_accumulation(F.col("values"))))


@query("select (l_suppkey % 9)::int as value, count(*) n from lineitem group by 1")
def raster_histogram(spark: SparkSession, d: str) -> DataFrame:
    return rasters.histogram(_tiles(spark, d, (F.col("l_suppkey") % 9).cast("int")))


@query("select (case v when 0 then 0 when 1 then 1 when 8 then 2 when 7 then 4 when 6 then 8 when 5 then 16 when 4 then 32 when 3 then 64 when 2 then 128 else 255 end)::int as value, count(*) n from (select l_partkey % 10 v from lineitem) group by 1")
def d8_normalise(spark: SparkSession, d: str) -> DataFrame:
    t = _tiles(spark, d, (F.col("l_partkey") % 10).cast("int"))
    return rasters.histogram(t.withColumn("values", rasters.to_esri(F.col("values"), "taudem")))


@query("select min(v) least, max(v) most, avg(v) mean, count(*) n from (select (l_partkey % 100)::int v from lineitem) where v <> 0")
def raster_statistics(spark: SparkSession, d: str) -> DataFrame:
    return rasters.statistics(_tiles(spark, d, (F.col("l_partkey") % 100).cast("int")), 0)


@query("select count(*) n_compared, count(*) filter (abs(a - b) > 1) n_different from (select l_partkey % 50 a, l_suppkey % 50 b from lineitem) where a <> 0 and b <> 0")
def raster_differences(spark: SparkSession, d: str) -> DataFrame:
    item = table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    p = item.groupBy(F.floor(F.col("l_orderkey") / 64).cast("int").alias("tile_row"), F.lit(0).alias("tile_col")).agg(F.collect_list(F.struct((F.col("l_partkey") % 50).alias("a"), (F.col("l_suppkey") % 50).alias("b"))).alias("p"))
    return rasters.differences(p.select("tile_row", "tile_col", F.col("p.a").alias("values")), p.select("tile_row", "tile_col", F.col("p.b").alias("values")), 0, atol=1.0)


# ---- a raster file: orders as pixels, 128 to a row, written as a cloud-optimised GeoTIFF with an overview and read again ------


@query("""with p as (select o_orderkey // 128 r, o_orderkey % 128 c, (o_custkey % 200)::int v from orders),
n as (select count(*) n, ((count(*) + 127) // 128)::bigint h from p), pad as (select (n + i) // 128 r, (n + i) % 128 c, 255 v from (select n, unnest(range(h * 128 - n)) i from n)),
a as (from p union all from pad)
select 0 as image, v as value, count(*) n from a group by v union all select 1, v, count(*) from a where r % 2 = 0 and c % 2 = 0 group by v""")
def raster_file(spark: SparkSession, d: str) -> DataFrame:
    side, across = 32, 128
    o = table(spark, d, "orders", "o_orderkey", "o_custkey").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 200).cast("int").alias("v"))
    n = o.count()
    h = -(-n // across)
    px = o.unionByName(spark.range(n, h * across).select(F.col("id").alias("k"), F.lit(255).alias("v")))
    row, col = F.floor(F.col("k") / across).cast("int"), (F.col("k") % across).cast("int")
    px = px.select(F.floor(row / side).cast("int").alias("tile_row"), F.floor(col / side).cast("int").alias("tile_col"), "k", "v")
    full = px.groupBy("tile_row", "tile_col").agg(F.sort_array(F.collect_list(F.struct("k", "v"))).alias("p"))
    full = full.select("tile_row", "tile_col", (F.col("tile_col") * side * 0.01).alias("x0"), (60 - F.col("tile_row") * side * 0.01).alias("y0"), F.lit(0.01).alias("pixel"), F.lit(side).alias("width"), F.col("p.v").alias("values"))
    path = f"{Workspace(spark, 'raster').root}/orders.tif"
    geotiff.write_cog([full, rasters.overview(full, side)], path, across, h, side, 0.0, 60.0, 0.01, "uint8", 255)
    spark.dataSource.register(geotiff.GeoTiff)
    images = [rasters.histogram(spark.read.format("geotiff").option("image", k).load(path)).withColumn("image", F.lit(k)) for k in (0, 1)]
    return images[0].unionByName(images[1])
