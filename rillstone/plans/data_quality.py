"""Queries p1 to p6 over a directory of tables, with equivalent SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.operators import heavy_keys, hierarchy, network, profile, references, schema_drift, spatial
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


# ---- p1: column profiles --------------------------------------------------------------------------------------------

PROFILED = {"catchments": ["area_km2", "up_area_km2"], "snap": ["weight"]}


def _profiled(spark: SparkSession, d: str) -> dict:
    return {t: (table(spark, d, t, "feed", "load_no", *cols), cols) for t, cols in PROFILED.items()}


_P1 = """
with v as (
  select 'catchments' src_table, 'area_km2' column_name, feed, load_no, cast(area_km2 as double) v from catchments
  union all select 'catchments', 'up_area_km2', feed, load_no, cast(up_area_km2 as double) from catchments
  union all select 'snap', 'weight', feed, load_no, cast(weight as double) from snap),
f as (select *, v is not null and not isnan(v) and v >= 0 and v < 'inf'::double ok from v),
g as (select src_table, column_name, feed, load_no, count(*) n_rows, count(*) filter (v is null) n_null,
  count(*) filter (v is not null and not ok) n_invalid, count(*) filter (ok) n_valid,
  median(v) filter (ok) med, count(distinct v) n_distinct,
  min(v) filter (ok) min_valid, max(v) filter (ok) max_valid
  from f group by all),
t as (select src_table, column_name, feed, load_no, max(n) top from
  (select src_table, column_name, feed, load_no, v, count(*) n from f where ok group by all) group by all)
"""


@query(
    _P1
    + """, p as (select g.*, coalesce(t.top, 0) top, lag(med) over (partition by g.src_table, g.column_name, g.feed order by g.load_no) prior
  from g left join t using (src_table, column_name, feed, load_no))
select src_table, column_name, feed, load_no, 'nulls' issue from p where n_null > 0.2 * n_rows
union all select src_table, column_name, feed, load_no, 'invalid' from p where n_invalid > 0.05 * (n_rows - n_null)
union all select src_table, column_name, feed, load_no, 'repeats' from p where top > 0.2 * n_valid
union all select src_table, column_name, feed, load_no, 'shift' from p where greatest(med, prior) > 0
  and med is not null and prior is not null and greatest(med, prior) >= 3 * least(med, prior)"""
)
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return profile.load_issues(profile.load_profile(spark, _profiled(spark, d)))


@query(
    _P1
    + """, p as (select *, case when feed is not null and load_no is not null and lag(load_no) over w is not null then lag(med) over w end prior
  from g window w as (partition by src_table, column_name, feed order by load_no nulls first))
select p.src_table, p.column_name, p.feed, p.load_no, n_rows, n_null, n_invalid, n_distinct, min_valid, max_valid,
  cast(coalesce(top, 0) as bigint) top_count, med median, prior prior_median, med / nullif(prior, 0) change
from p left join t on t.src_table = p.src_table and t.column_name = p.column_name and t.feed is not distinct from p.feed and t.load_no is not distinct from p.load_no"""
)
def p1_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile.full_profile(_profiled(spark, d))


@query(
    " union all ".join(
        f"select '{t}' src_table, '{c}' column_name, count(*) n_rows, count(*) - count({c}) n_null, count(distinct {c}::double) n_distinct, min({c}::double) filter (not isnan({c})) min_value, max({c}::double) filter (not isnan({c})) max_value from {t}"
        for t, cols in PROFILED.items()
        for c in cols
    )
)
def p1_columns(spark: SparkSession, d: str) -> DataFrame:
    return profile.column_profile(_profiled(spark, d))


@query()
def p1_chunks(spark: SparkSession, d: str) -> DataFrame:
    parts = [profile.chunk_plan(df, cols).withColumn("src_table", F.lit(t)).drop("path") for t, (df, cols) in _profiled(spark, d).items()]
    return parts[0].unionByName(parts[1])


# ---- p2: drifting schemas -------------------------------------------------------------------------------------------


def _drift(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    df = table(spark, d, "deliveries", "stream_no", "artifact", "file_no", "line_no", "payload")
    space = Workspace(spark, "drift")
    flat = space.cut(schema_drift.fields(df))
    files = space.cut(schema_drift.file_versions(df))
    return df, flat, schema_drift.migrations(flat, files)


_NUM = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
_P2 = rf"""
with p as (select stream_no s, file_no f, line_no l, payload::json j from deliveries where json_valid(payload) and json_type(payload) = 'OBJECT'),
kv as (select s, f, l, j->>'$.id' rec, k, json_extract(j, '$."' || k || '"') v from (select *, unnest(json_keys(j)) k from p)),
t as (select *, case json_type(v) when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'ARRAY' then 'array' when 'OBJECT' then 'object' when 'NULL' then null else 'number' end kind,
  case when json_type(v) = 'VARCHAR' then v->>'$' else v::varchar end tx from kv),
b as (select *, regexp_replace(trim(tx), '^\[\s*|\s*\]$', '', 'g') bare from t),
x as (select s, f, l, rec, k, kind, case when kind is null then null when bare = '' and kind in ('array', 'string') then '#'
  when kind in ('string', 'number', 'array') and regexp_full_match(bare, '{_NUM}(?:\s*[,;]\s*{_NUM})*') then '#' || array_to_string([try_cast(trim(y) as double)::varchar for y in regexp_split_to_array(bare, '[,;]')], ',')
  else kind || tx end val from b),
files as (select *, lag(f) over w pf, row_number() over w ver from (select distinct stream_no s, file_no f from deliveries) window w as (partition by s order by f)),
c as (select s, f, k, kind, count(*) n from x group by all),
own as (select s, f, k, (list(kind order by n desc, kind) filter (kind is not null))[1] kind from c group by s, f, k),
isl as (select *, ver - row_number() over (partition by s, k order by ver) isl from own join files using (s, f)),
fp as (select s, f, pf, k, last_value(kind ignore nulls) over (partition by s, k, isl order by ver) kind from isl),
bef as (select n.s, n.f, o.k, o.kind from files n join fp o on o.s = n.s and o.f = n.pf),
bo as (select coalesce(a.s, z.s) s, coalesce(a.f, z.f) f, coalesce(a.k, z.k) k, a.kind nk, z.kind ok, case when z.k is null then 'new' when a.k is null then 'gone' else 'kept' end ch
  from (select * from fp where pf is not null) a full join bef z on a.s = z.s and a.f = z.f and a.k = z.k),
one as (select s, f, k, rec, min_by(val, l) val from x where val is not null and rec is not null group by all),
pr as (select n.s, n.f, g.k old, n.k new, count(*) n, count(*) filter (a.val = z.val) same from bo n join bo g on n.s = g.s and n.f = g.f and n.ch = 'new' and g.ch = 'gone'
  join files on files.s = n.s and files.f = n.f join one a on a.s = n.s and a.f = n.f and a.k = n.k join one z on z.s = n.s and z.f = files.pf and z.k = g.k and z.rec = a.rec group by n.s, n.f, g.k, n.k having 2 * count(*) filter (a.val = z.val) > count(*)),
rk as (select *, row_number() over (partition by s, f, new order by same / n desc, same desc, old) r1, row_number() over (partition by s, f, old order by same / n desc, same desc, new) r2 from pr),
rn as (select * from rk where r1 = 1 and r2 = 1),
j as (select bo.*, a.old came, z.new went, fk.kind fk from bo left join rn a on a.s = bo.s and a.f = bo.f and a.new = bo.k and bo.ch = 'new' left join rn z on z.s = bo.s and z.f = bo.f and z.old = bo.k and bo.ch = 'gone' left join bef fk on fk.s = bo.s and fk.f = bo.f and fk.k = a.old)
select f file_no, k field_name, unnest(list_filter([case when came is not null then 'renamed' end, case when ch = 'new' and came is null then 'added' end, case when ch = 'gone' and went is null then 'removed' end, case when nk <> coalesce(ok, fk) then 'retyped' end], lambda q: q is not null)) change_kind from j"""


@query(_P2)
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    _, _, steps = _drift(spark, d)
    return steps.select(F.col("file").alias("file_no"), "field_name", "change_kind")


@query(f"with y as ({_P2.replace('select f file_no, k field_name, unnest', 'select f, k, coalesce(came, k) old_name, coalesce(ok, fk) old_kind, nk new_kind, unnest')}) select change_kind, old_name, k as field_name, old_kind, new_kind, count(distinct f) n_files from y group by all")
def p2_report(spark: SparkSession, d: str) -> DataFrame:
    _, _, steps = _drift(spark, d)
    return steps.groupBy("change_kind", "old_name", "field_name", "old_kind", "new_kind").agg(F.countDistinct("file").alias("n_files"))


@query(
    _P2.split("bef as (")[0].rstrip().removesuffix(",")
    + """, sig as (select s, f, ver, count(*) n_fields, string_agg(k || ':' || coalesce(kind, ''), ',' order by k) sig from (select s, f, k, kind from fp) join files using (s, f) group by s, f, ver)
select s stream_no, f file_no, ver version, n_fields, coalesce(sig <> lag(sig) over (partition by s order by ver), false) changed from sig"""
)
def p2_versions(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "deliveries", "stream_no", "artifact", "file_no", "line_no", "payload")
    v = schema_drift.versions(schema_drift.fingerprints(schema_drift.fields(df), schema_drift.file_versions(df)))
    return v.select(F.col("stream").alias("stream_no"), F.col("file").alias("file_no"), "version", "n_fields", "changed")


def _unified(spark: SparkSession, d: str, artifact: str, casts: dict[str, str]) -> DataFrame:
    df, flat, steps = _drift(spark, d)
    mine = df.where(F.col("artifact") == artifact)
    streams = mine.select(F.col("stream_no").alias("stream")).distinct()
    space = Workspace(spark, "unified")
    flat = flat.join(streams, "stream", "left_semi")
    steps = space.cut(steps.join(streams, "stream", "left_semi"))
    names = schema_drift.canonical_names(steps, flat, casts)
    return schema_drift.one_table(mine, names, casts, placed=space.cut(schema_drift.placements(steps, flat, names)))


_CASTS = {
    "catchments": {"id": "bigint", "area_km2": "double", "up_area_km2": "double", "bbox": "array<double>", "geometry": "string", "strahler": "bigint", "slope_pct": "double", "survey_code": "string", "checked": "boolean", "remark": "string"},
    "graph": {"id": "bigint", "upstream_ids": "array<bigint>", "downstream_id": "bigint", "strahler": "bigint", "survey_code": "string", "checked": "boolean", "remark": "string"},
}


def _table_sql(artifact: str, more: tuple[str, ...]) -> str:
    """more: columns beside the casts, for names that no rename ties to a cast's field. They depend on the data, so the SQL
    is for the tables on which it is compared."""
    casts = _CASTS[artifact] | dict.fromkeys(more, "string")

    def value(c: str, to: str) -> str:
        at = f"any_value({{}}) filter (col = '{c}')"
        text = at.format("tx")
        if to in ("double", "bigint"):
            return f"try_cast({text} as {to})"
        if to == "boolean":
            return f"case when lower({text}) in ('true', 'yes', '1') then true when lower({text}) in ('false', 'no', '0') then false end"
        if to == "string":
            return f"coalesce({text}, {at.format('js')})"
        return at.format("listed") + f"::{to[6:-1]}[]"

    cols = ", ".join(f"{value(c, to)} {c}" for c, to in casts.items())
    lost = " - ".join(f"({c} is not null)::bigint" for c in casts)
    return (
        _P2.split("j as (select bo.*")[0].rstrip().removesuffix(",").replace("with p as", "with recursive p as")
        + f""", mine as (select distinct stream_no s from deliveries where artifact = '{artifact}'),
uses as (select k, count(distinct (s, f)) u from kv where s in (from mine) group by 1),
lk as (select old a, new b from rn where s in (from mine) union select new, old from rn where s in (from mine)),
cl(k, m) as (select k, k from uses union select cl.k, lk.b from cl join lk on lk.a = cl.m),
nm as (select cl.k, coalesce(min(m) filter (m in {tuple(_CASTS[artifact])}), (list(m order by u desc, m))[1]) col from cl join uses on uses.k = cl.m group by 1),
there as (select s, f, l, k, case when json_type(v) = 'OBJECT' then coalesce(v->'$.val', v->'$.ids', v) else v end i, v from kv where s in (from mine) and json_type(v) <> 'NULL'),
val as (select s, f, l, col, case json_type(i) when 'VARCHAR' then i->>'$' when 'ARRAY' then null when 'OBJECT' then null else i::varchar end tx,
  case when json_type(v) = 'OBJECT' and (v->'$.type') is not null then '{{"coordinates":' || (v->'$.coordinates')::varchar || ',"type":' || (v->'$.type')::varchar || '}}' else v::varchar end js,
  case when json_type(i) = 'ARRAY' then try_cast(i as double[]) when trim(i->>'$') = '' then [] else [try_cast(trim(z) as double) for z in regexp_split_to_array(regexp_replace(trim(i->>'$'), '^\\[|\\]$', '', 'g'), ' *[,;] *')] end li from there join nm using (k)),
lst as (select *, case when len(list_filter(li, lambda z: z is null)) = 0 then li end listed from val),
rec as (select s, f, l, count(*) n, {cols} from lst group by s, f, l)
select s stream, f file, l line, {', '.join(casts)}, n - {lost} n_lost from rec"""
    )


@query(_table_sql("catchments", ("unitarea",)))
def p2_catchments(spark: SparkSession, d: str) -> DataFrame:
    return _unified(spark, d, "catchments", _CASTS["catchments"])


@query(_table_sql("graph", ("is_checked", "note_txt")))
def p2_graph(spark: SparkSession, d: str) -> DataFrame:
    return _unified(spark, d, "graph", _CASTS["graph"])


# ---- p3: orphan references ------------------------------------------------------------------------------------------


def _refs(spark: SparkSession, d: str) -> DataFrame:
    snap = table(spark, d, "snap", "id", "catchment_id", "loaded_at")
    graph = table(spark, d, "graph_arrow", "id", "upstream_ids", "loaded_at")
    parts = [
        snap.select(F.lit("snap.catchment_id").alias("ref_field"), F.col("id").alias("record_id"), F.col("catchment_id").alias("ref_id"), F.col("loaded_at").alias("at")),
        graph.select(F.lit("graph_arrow.id").alias("ref_field"), F.col("id").alias("record_id"), F.col("id").alias("ref_id"), F.col("loaded_at").alias("at")),
        graph.select(F.lit("graph_arrow.upstream_ids").alias("ref_field"), F.col("id").alias("record_id"), F.explode("upstream_ids").alias("ref_id"), F.col("loaded_at").alias("at")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    loads = table(spark, d, "catchments", "id", "loaded_at").select(F.col("id").alias("key"), F.col("loaded_at").alias("at"))
    gone = table(spark, d, "withdrawn", "id", "withdrawn_at").select(F.col("id").alias("key"), F.col("withdrawn_at").alias("at"))
    return references.orphans(_refs(spark, d), references.parent_runs(loads, gone))


_P3 = """
with refs as (
  select 'snap.catchment_id' ref_field, id record_id, catchment_id ref_id, loaded_at from snap
  union all select 'graph_arrow.id', id, id, loaded_at from graph_arrow
  union all select 'graph_arrow.upstream_ids', id, unnest(upstream_ids), loaded_at from graph_arrow),
c as (select id, true there, min(loaded_at) l from catchments where id is not null group by id),
w as (select id, true there, min(withdrawn_at) w from withdrawn where id is not null group by id),
k as (select ref_field, strftime(loaded_at, '%Y-%m') loaded_month, record_id, ref_id,
  case when w.w <= loaded_at then 'deleted' when c.there is null and w.there is null then 'missing' when c.l > loaded_at then 'late' end kind
  from refs left join c on c.id = ref_id left join w on w.id = ref_id where ref_id is not null and ref_id <> 0),
p3 as (select distinct * from k where kind is not null)
"""


@query(_P3 + "select * from p3")
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d)


@query(_P3 + "select ref_field, loaded_month, kind, count(*) n_refs, count(distinct ref_id) n_keys from p3 group by all")
def p3_report(spark: SparkSession, d: str) -> DataFrame:
    return references.orphan_report(_orphans(spark, d))


# ---- p6: heavy keys -------------------------------------------------------------------------------------------------

_P6 = "with e as (select id, unnest(upstream_ids) u from graph_arrow), r as (select id, u from e where u is not null and u <> 0) "


@query(
    _P6
    + """select 'id' key_field, id atom_id from graph_arrow where id is not null group by id having count(*) >= 0.02 * (select count(*) from graph_arrow)
union all select 'upstream_ids', u from r group by u having count(*) >= 0.02 * (select count(*) from r)"""
)
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "graph_arrow", "id", "upstream_ids")
    entries = g.select(F.explode("upstream_ids").alias("entry")).where("entry is not null and entry <> 0")
    a = heavy_keys.heavy(g.select("id"), "id", 0.02).select(F.lit("id").alias("key_field"), F.col("key").alias("atom_id"))
    b = heavy_keys.heavy(entries, "entry", 0.02).select(F.lit("upstream_ids").alias("key_field"), F.col("key").alias("atom_id"))
    return a.unionByName(b)


@query(_P6 + "select id, u as upstream_id, count(*) n from r group by all")
def p6_members(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "graph_arrow", "id", "upstream_ids")
    return heavy_keys.members(g, "id", "upstream_ids").select(F.col("key").alias("id"), F.col("member").alias("upstream_id"), "n")


@query(
    _P6
    + """select g.id, n_rows, coalesce(n_entries, 0) n_entries, coalesce(n_distinct, 0) n_distinct, min_member, max_member
from (select id, count(*) n_rows from graph_arrow group by 1) g
left join (select id, count(*) n_entries, count(distinct u) n_distinct, min(u) min_member, max(u) max_member from r group by 1) x on x.id is not distinct from g.id"""
)
def p6_atoms(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "graph_arrow", "id", "upstream_ids")
    return heavy_keys.key_summary(g, "id", "upstream_ids").withColumnRenamed("key", "id")


# ---- p4: near and inside --------------------------------------------------------------------------------------------


def _u32(at: str) -> str:
    """SQL: the whole number at byte `at` of the hexadecimal text h; null beyond its end."""
    pair = lambda k: f"h[2*({at})+{2 * k + 1}:2*({at})+{2 * k + 2}]"
    return f"try_cast('0x' || case when le then {pair(3)} || {pair(2)} || {pair(1)} || {pair(0)} else h[2*({at})+1:2*({at})+8] end as bigint)"


def _f64(at: str) -> str:
    """SQL: the double at byte `at`, from its exponent and mantissa; infinite and NaN as null."""
    pair = lambda k: f"h[2*({at})+{2 * k + 1}:2*({at})+{2 * k + 2}]"
    bits = f"try_cast('0x' || case when le then {' || '.join(pair(k) for k in range(7, -1, -1))} else h[2*({at})+1:2*({at})+16] end as ubigint)"
    return f"(select case when (b >> 52) & 2047 = 2047 then null when (b >> 52) & 2047 = 0 then 0.0 else (1 - 2 * (b >> 63)::double) * (4503599627370496 + (b & 4503599627370495))::double * pow(2.0, ((b >> 52) & 2047)::double - 1075) end from (select {bits} b))"


#: SQL: rings of the polygons ck (g, id, h, len, le, k, n), by walking their bytes; bad marks those that end too soon or
#: hold something else.
WALK_SQL = f"""walk(g, id, h, len, le, parts, rings, pos, ring, n, bad) as (
  select g, id, h, len, le, case when k = 6 then n else 0 end, case when k = 3 then n else 0 end, 9, 0, 0, false from ck where k in (3, 6)
  union all
  select g, id, h, len, le2, parts - (rings = 0)::int, case when rings = 0 then n2 else rings - 1 end, case when rings = 0 then pos + 9 else pos + 4 + 16 * n2 end,
    pos + 4, case when rings = 0 then 0 else n2 end, case when rings = 0 then coalesce(k2 <> 3 or n2 is null, true) else coalesce(pos + 4 + 16 * n2 > len, true) end
  from (select *, case when rings = 0 then {_u32("pos + 5")} else {_u32("pos")} end n2, {_u32("pos + 1")} k2 from (select * replace (case when rings = 0 then h[2*pos+1:2*pos+2] = '01' else le end as le), case when rings = 0 then h[2*pos+1:2*pos+2] = '01' else le end le2 from walk where not bad and (parts > 0 or rings > 0)))),
"""
_P4 = f"""
with recursive sg as (select id, hex(geometry) h, octet_length(geometry) len, hex(geometry)[1:2] = '01' le from snap where id is not null and octet_length(geometry) >= 21),
sk as (select *, {_u32("1")} k, {_u32("5")} n from sg where h[1:2] in ('00', '01')),
sp as (select id, h, le, case when k = 1 then 5 else 9 + 16 * (n - 1) end pos from sk where k = 1 or k = 2 and n > 0 and len >= 9 + 16 * n),
loc as (select distinct id, x, y from (select id, {_f64("pos")} x, {_f64("pos + 8")} y from sp) where x is not null and abs(y) <= 90),
cg as (select row_number() over () g, id, hex(geometry) h, octet_length(geometry) len, hex(geometry)[1:2] = '01' le from catchments where id is not null and octet_length(geometry) >= 9),
ck as (select *, {_u32("1")} k, {_u32("5")} n from cg where h[1:2] in ('00', '01')),
{WALK_SQL}ring as (select g, id, h, le, ring, n, row_number() over () r from walk where n >= 3 and g not in (select g from walk where bad)),
vx as (select g, id, r, i, {_f64("ring + 16 * i")} x, {_f64("ring + 16 * i + 8")} y from (select *, unnest(range(n)) i from ring)),
good as (select * from vx where g not in (select g from vx where x is null or y is null)),
edge as (select g, x ax, y ay, coalesce(lead(x) over w, first_value(x) over w) bx, coalesce(lead(y) over w, first_value(y) over w) by_ from good window w as (partition by r order by i)),
box as (select g, id, min(x) x0, max(x) x1, min(y) y0, max(y) y1 from good group by 1, 2),
cand as (select p.id a, p.x, p.y, b.id b, b.g from loc p join box b on p.x between b.x0 and b.x1 and p.y between b.y0 and b.y1)
select 'near' kind, a.id key_a, b.id key_b from loc a join loc b on b.y between a.y - 0.0006 and a.y + 0.0006 and a.id < b.id
where 2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin(radians(b.y - a.y) / 2), 2) + cos(radians(a.y)) * cos(radians(b.y)) * pow(sin(radians(b.x - a.x) / 2), 2)))) <= 50 group by all
union all select 'inside', a, b from (select a, b, g, x, y from cand join edge using (g) group by all having count(*) filter ((ay > y) <> (by_ > y) and x < (bx - ax) * (y - ay) / (by_ - ay) + ax) % 2 = 1) group by all"""


@query(_P4)
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return spatial.near_and_inside(table(spark, d, "snap", "id", "geometry"), table(spark, d, "catchments", "id", "geometry"), 50.0)


@query(
    _P4.split("cg as (")[0].rstrip().removesuffix(",").replace("with recursive", "with")
    + """, place as (select x, y, min(id) place_id, count(distinct id) n_ids from loc group by 1, 2)
select a.place_id, a.x lon, a.y lat, a.n_ids, count(b.place_id) n_near from place a left join place b on b.y between a.y - 0.0006 and a.y + 0.0006 and (a.x <> b.x or a.y <> b.y)
and 2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin(radians(b.y - a.y) / 2), 2) + cos(radians(a.y)) * cos(radians(b.y)) * pow(sin(radians(b.x - a.x) / 2), 2)))) <= 50 group by all"""
)
def p4_places(spark: SparkSession, d: str) -> DataFrame:
    members, pairs = spatial.near_places(table(spark, d, "snap", "id", "geometry"))
    at = lambda p: pairs.select(F.col(f"{p}_lon").alias("lon"), F.col(f"{p}_lat").alias("lat"))
    near = at("a").unionByName(at("b")).groupBy("lon", "lat").agg(F.count(F.lit(1)).alias("n_near"))
    places = members.groupBy("lon", "lat", "place_id").agg(F.count(F.lit(1)).alias("n_ids"))
    return places.join(near, ["lon", "lat"], "left").select("place_id", "lon", "lat", "n_ids", F.coalesce("n_near", F.lit(0)).alias("n_near"))


# ---- p5: hierarchies ------------------------------------------------------------------------------------------------


def _hierarchy(spark: SparkSession, d: str) -> hierarchy.Hierarchy:
    return hierarchy.build(table(spark, d, "graph_arrow", "id", "upstream_ids"))


_P5 = """
with recursive n as (select distinct id from graph_arrow where id is not null),
e as (select distinct u, v from (select unnest(upstream_ids) u, id v from graph_arrow where id is not null) where u in (select id from n)),
roots as (select id from n where id not in (select u from e)),
"""

_P5_STEPS = """p(atom_id, root_id, steps) using key (atom_id, root_id) as (
  select id, id, cast(0 as bigint) from roots
  union
  select e.u, p.root_id, min(p.steps) + 1 from p join e on e.v = p.atom_id
  where not exists (select 1 from recurring.p q where q.atom_id = e.u and q.root_id = p.root_id) group by 1, 2),
"""


@query(
    _P5
    + _P5_STEPS
    + """core as (select u, v from e where u in (select v from e) and v in (select u from e)),
reach(a, b) as (select u, v from core union select r.a, c.v from reach r join core c on c.u = r.b),
onc as (select distinct a from reach where a = b),
scc as (select x.a, y.a b from onc x join reach r on r.a = x.a join onc y on y.a = r.b join reach s on s.a = y.a and s.b = x.a)
select 'path' kind, atom_id, root_id, steps from p
union all select 'cycle', a, min(b), count(distinct b) from (select a, b from scc union select u, v from e where u = v) group by a"""
)
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    h = _hierarchy(spark, d)
    return hierarchy.outlets(h).select(F.lit("path").alias("kind"), "atom_id", "root_id", "steps").unionByName(hierarchy.cycles(h).select(F.lit("cycle").alias("kind"), "atom_id", "root_id", "steps"))


@query(
    _P5
    + _P5_STEPS
    + """nxt as (select a.atom_id u, a.root_id r, min(e.v) v from p a join e on e.u = a.atom_id join p z on z.atom_id = e.v and z.root_id = a.root_id and z.steps = a.steps - 1 group by 1, 2),
walk(q, r, cur, step) as (select atom_id, root_id, atom_id, cast(0 as bigint) from p where atom_id % 50 = 0 union all select q, walk.r, v, step + 1 from walk join nxt on u = cur and nxt.r = walk.r)
select q atom_id, r root_id, max(step) steps, list(cur order by step) path from walk group by 1, 2"""
)
def p5_paths(spark: SparkSession, d: str) -> DataFrame:
    h = _hierarchy(spark, d)
    return hierarchy.paths(h, h.atoms.where("id % 50 = 0").select("id"))


#: Over all edges, through atoms with several downstream atoms and round rings; queries are the ids divisible by 50.
UP_SQL = _P5 + "up(q, id) as (select id, id from n where id % 50 = 0 union select up.q, e.u from up join e on e.v = up.id)"
_DOWN_SQL = _P5 + "down(q, id) as (select id, id from n where id % 50 = 0 union select down.q, e.v from down join e on e.u = down.id)"


@query(UP_SQL + " select q query_id, id from up where id <> q")
def p5_descendants(spark: SparkSession, d: str) -> DataFrame:
    h = _hierarchy(spark, d)
    return network.upstream(h, h.atoms.where("id % 50 = 0").select("id")).where("id <> query_id")


@query(_DOWN_SQL + " select q query_id, id from down")
def p5_way_down(spark: SparkSession, d: str) -> DataFrame:
    h = _hierarchy(spark, d)
    return network.all_downstream(h, h.atoms.where("id % 50 = 0").select("id"))


@query(
    _P5
    + """dn as (select u, count(*) n, min(v) v from e where u <> v group by u),
f as (select u id, v parent from dn where n = 1),
up(id, top, path) as (select id, id, [id] from n where id not in (select id from f) union all select f.id, up.top, list_append(up.path, f.id) from up join f on f.parent = up.id),
anc(id, a) as (select id, id from up union all select anc.id, f.parent from anc join f on f.id = anc.a),
sz as (select a id, count(*) size from anc group by 1),
ends as (select id, case when coalesce(dn.n, 0) > 1 then 'branch' when coalesce(dn.n, 0) = 0 and id in (select u from e where u = v) then 'sink' when coalesce(dn.n, 0) = 0 then 'outlet' end own from n left join dn on dn.u = id),
pos as (select id, top, len(path) - 1 depth, row_number() over (partition by top order by path) - 1 lft from up)
select n.id, f.parent, coalesce(dn.n, 0) n_down, pos.top, pos.depth, sz.size, pos.lft, pos.lft + sz.size - 1 rgt, ends.own as end
from n left join f on f.id = n.id left join dn on dn.u = n.id left join pos on pos.id = n.id left join sz on sz.id = n.id left join ends on ends.id = pos.top"""
)
def p5_nested_sets(spark: SparkSession, d: str) -> DataFrame:
    return _hierarchy(spark, d).atoms
