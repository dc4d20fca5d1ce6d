"""The drainage graph: edges, degrees, traversal upstream, areas, mainstems, acyclicity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.operators import hierarchy as H


def downstream_lists(graph: DataFrame) -> DataFrame:
    """id, downstream_ids: the graph turned round, distinct and sorted; atoms that drain nowhere are left out."""
    e = graph.select(F.col("id").alias("down"), F.explode("upstream_ids").alias("id")).where("id is not null and down is not null").distinct()
    return e.groupBy("id").agg(F.sort_array(F.collect_list("down")).alias("downstream_ids"))


def degrees(graph: DataFrame) -> DataFrame:
    """id, n_up, n_down over distinct edges between atoms with a row."""
    e = H.edges_of(graph)
    nodes = graph.where("id is not null").select("id").distinct()
    up = e.groupBy(F.col("to_id").alias("id")).agg(F.count(F.lit(1)).alias("n_up"))
    down = e.groupBy(F.col("from_id").alias("id")).agg(F.count(F.lit(1)).alias("n_down"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return nodes.join(up, "id", "left").join(down, "id", "left").select("id", zero("n_up"), zero("n_down"))


def tree_offences(graph: DataFrame) -> DataFrame:
    """Atoms that drain to more than one atom, which a fabric declared as tree must not have."""
    return degrees(graph).where("n_down > 1").select("id", "n_down")


def edges_from_next_down(rivers: DataFrame, key: str = "id", down: str = "next_down") -> DataFrame:
    """id, upstream_ids (sorted) for every river; next_down 0, itself or a river that is not there end a line."""
    ids = rivers.select(F.col(key).cast("long").alias("id")).distinct()
    e = rivers.select(F.col(key).cast("long").alias("u"), F.col(down).cast("long").alias("id")).where("id is not null and id <> 0 and u <> id")
    ups = e.join(ids, "id", "left_semi").groupBy("id").agg(F.sort_array(F.collect_set("u")).alias("upstream_ids"))
    return ids.join(ups, "id", "left").select("id", F.coalesce("upstream_ids", F.array().cast("array<bigint>")).alias("upstream_ids"))


def csv_ids(c: Column) -> Column:
    """Whole numbers of a comma-separated text; blanks dropped, null as empty, other text as null."""
    return F.transform(F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != ""), lambda x: x.try_cast("bigint"))


def mainstem(children: DataFrame) -> DataFrame:
    """children: id, down, area. Adds is_mainstem: of the atoms that drain to one atom, the one with the largest area,
    then the largest id. One aggregate per parent, so a parent with many children is no hot window."""
    top = children.where("down is not null and down <> 0").groupBy("down").agg(F.max(F.struct("area", "id")).alias("t"))
    j = children.join(top, "down", "left")
    return j.select("id", "down", "area", F.coalesce(F.col("t.id") == F.col("id"), F.lit(True)).alias("is_mainstem"))


def mainstem_graph(graph: DataFrame, areas: DataFrame) -> DataFrame:
    """The graph with one entry at most for each atom, its upstream atom of the largest area (id, area; atoms without one
    count as 0), then the largest id: what hierarchy.build and upstream need to follow main stems only."""
    e = H.edges_of(graph).where("from_id <> to_id").join(areas.select(F.col("id").alias("from_id"), "area"), "from_id", "left")
    best = e.groupBy(F.col("to_id").alias("id")).agg(F.max(F.struct(F.coalesce("area", F.lit(0)).alias("a"), "from_id")).alias("m"))
    nodes = graph.where("id is not null").select("id").distinct()
    return nodes.join(best, "id", "left").select("id", F.array_compact(F.array("m.from_id")).alias("upstream_ids"))


def summary(graph: DataFrame) -> DataFrame:
    """n_atoms, n_headwaters, n_outlets, most_upstream, most_downstream: one row."""
    d = degrees(graph)
    most = lambda c: F.coalesce(F.max(c), F.lit(0))
    return d.agg(F.count(F.lit(1)).alias("n_atoms"), F.count_if(F.col("n_up") == 0).alias("n_headwaters"), F.count_if(F.col("n_down") == 0).alias("n_outlets"), most("n_up").alias("most_upstream"), most("n_down").alias("most_downstream"))


def blocked(h: H.Hierarchy) -> DataFrame:
    """id: atoms on a cycle or downstream of one: what repeated removal of atoms without upstream atoms leaves."""
    cyc = h.space.cut(H.cycles(h).select(F.col("atom_id").alias("id")))
    links = h.space.cut(H._contracted(h).select("b", "top", "at", "end"))
    placed = h.atoms.where("top is not null")
    start = cyc.join(placed, "id").select("top", F.col("lft").alias("at"), "end")
    points = h.space.cut(start.select("top", "at"))
    reached, n = h.space.counted(start.where("end = 'branch'").select(F.col("top").alias("b")).distinct().withColumn("fresh", F.lit(True)), n=F.count_if(F.col("fresh")))
    while n["n"]:
        step = h.space.cut(links.join(reached.where("fresh"), "b").select("top", "at", "end"))
        points = points.unionByName(step.select("top", "at"))
        more = step.where("end = 'branch'").select(F.col("top").alias("b")).distinct().join(reached, "b", "left_anti").withColumn("fresh", F.lit(True))
        new, n = h.space.counted(reached.withColumn("fresh", F.lit(False)).unionByName(more), n=F.count_if(F.col("fresh")))
        h.space.drop(reached)
        reached = new
    points = points.distinct()
    below = H.ancestors(h, points.select(F.lit(0).alias("tag"), "top", "at")).select("id")
    return below.unionByName(cyc).distinct()


def reach(h: H.Hierarchy, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ranges, single): what lies above each queried atom, itself included. ranges: query_id, top, lft, rgt, disjoint for
    one query; single: query_id, id of atoms without a range, that lead into a ring. No atom of a range is listed, so the
    answer is as large as the number of trees it comes from.

    A tree whose end, a branch atom, drains into a range is added as a whole. Rounds follow the number of branch atoms on
    a way, those of rings the logarithm of their atoms' number.
    """
    space, rows = h.space, F.count(F.lit(1))
    wanted = queries.select("id").distinct()
    placed = h.atoms.where("top is not null").select("id", "top", "lft", "rgt")
    into = h.links.select(F.col("from_id").alias("b"), F.col("to_id").alias("id"))
    links = space.cut(into.join(placed, "id").select("b", "top", F.col("lft").alias("at")))
    trees = placed.where("id = top").select(F.col("id").alias("b"), "top", "lft", "rgt")
    # atoms of rings: those fewer than 2^k steps above; jump is the atom 2^k below
    t, n = space.counted(h.atoms.where("top is null").select("id", F.col("parent").alias("jump")), n=rows)
    single = space.cut(wanted.join(t.select("id"), "id").select(F.col("id").alias("query_id"), "id"))
    for _ in range(n["n"].bit_length()):
        step = t.join(single.select("query_id", F.col("id").alias("jump")), "jump").select("query_id", "id")
        single = space.cut(single.unionByName(step).distinct())
        t = space.cut(t.join(t.select(F.col("id").alias("jump"), F.col("jump").alias("j2")), "jump").select("id", F.col("j2").alias("jump")))
    own = wanted.join(placed, "id").select(F.col("id").alias("query_id"), F.when(F.col("id") == F.col("top"), F.col("id")).alias("b"), "top", "lft", "rgt")
    entered = single.join(into, "id").select("query_id", "b").distinct().join(trees, "b").select("query_id", "b", "top", "lft", "rgt")
    # b: the branch atom whose whole tree this is, null for a queried atom within one
    known, n = space.counted(own.unionByName(entered).withColumn("fresh", F.lit(True)), n=F.count_if(F.col("fresh")))
    while n["n"]:
        hit = _stab(known.where("fresh").select("query_id", "top", "lft", "rgt"), links, h.levels).distinct()
        hit = hit.join(known.where("b is not null").select("query_id", "b"), ["query_id", "b"], "left_anti").join(trees, "b").select("query_id", "b", "top", "lft", "rgt", F.lit(True).alias("fresh"))
        new, n = space.counted(known.withColumn("fresh", F.lit(False)).unionByName(hit), n=F.count_if(F.col("fresh")))
        space.drop(known)
        known = new
    # a queried atom's own range may lie within a tree that was added as a whole
    ranges = known.groupBy("query_id", "top").agg(F.min("lft").alias("lft"), F.max("rgt").alias("rgt"))
    return space.cut(ranges), single


def upstream(h: H.Hierarchy, queries: DataFrame) -> DataFrame:
    """query_id, id: every atom from which a queried atom is reached, itself included, once each."""
    ranges, single = reach(h, queries)
    placed = h.atoms.where("top is not null").select("id", "top", F.col("lft").alias("at"))
    return _spread(ranges, placed).unionByName(single)


def upstream_totals(h: H.Hierarchy, queries: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """query_id, n_atoms, total: how many atoms lie above each queried atom, itself included, and the sum of their values,
    from two positions of a running sum for each range: the atoms themselves are not listed."""
    ranges, single = reach(h, queries)
    run = _running(h, values, column)
    hi = run.select("top", F.col("lft").alias("rgt"), F.col("upto").alias("last"))
    lo = run.select("top", "lft", (F.col("upto") - F.col("v")).alias("before"))
    part = ranges.join(hi, ["top", "rgt"]).join(lo, ["top", "lft"]).select("query_id", (F.col("rgt") - F.col("lft") + 1).alias("n"), (F.col("last") - F.col("before")).alias("t"))
    zero = F.lit(0).cast(_MONEY)
    alone = single.join(values.select("id", F.col(column).cast(_MONEY).alias("v")), "id", "left").select("query_id", F.lit(1).cast("long").alias("n"), F.coalesce("v", zero).alias("t"))
    return part.unionByName(alone).groupBy("query_id").agg(F.sum("n").alias("n_atoms"), F.sum("t").alias("total"))


def all_downstream(h: H.Hierarchy, queries: DataFrame) -> DataFrame:
    """query_id, id: every atom on any way down from a queried atom, itself included, once each: through atoms with several
    downstream atoms on to the outlets, and round the rings. Rounds follow the number of such atoms on a way."""
    places = h.atoms.select("id", "top", F.col("lft").alias("at"))
    links = h.space.cut(h.links.select(F.col("from_id").alias("b"), F.col("to_id").alias("id")).join(places, "id"))
    points = h.space.cut(queries.select("id").distinct().join(places, "id").select(F.col("id").alias("tag"), "id", "top", "at"))
    fresh = F.count_if(F.col("fresh"))
    seen, n = h.space.counted(points.where("top is not null").select("tag", "top", F.lit(True).alias("fresh")).distinct(), n=fresh)
    while n["n"]:
        step = h.space.cut(seen.where("fresh").select("tag", F.col("top").alias("b")).join(links, "b").select("tag", "id", "top", "at").distinct())
        points = points.unionByName(step)
        more = step.where("top is not null").select("tag", "top").distinct().join(seen, ["tag", "top"], "left_anti").withColumn("fresh", F.lit(True))
        new, n = h.space.counted(seen.withColumn("fresh", F.lit(False)).unionByName(more), n=fresh)
        h.space.drop(seen)
        seen = new
    points = h.space.cut(points.distinct())
    t, n = h.space.counted(h.atoms.where("top is null").select("id", F.col("parent").alias("jump")), n=F.count(F.lit(1)))
    found = h.space.cut(points.where("top is null").select("tag", "id"))
    for _ in range(n["n"].bit_length()):
        found = h.space.cut(found.unionByName(found.join(t, "id").select("tag", F.col("jump").alias("id"))).distinct())
        t = h.space.cut(t.join(t.select(F.col("id").alias("jump"), F.col("jump").alias("j2")), "jump").select("id", F.col("j2").alias("jump")))
    below = H.ancestors(h, points.where("top is not null").select("tag", "top", "at"))
    return below.unionByName(found).distinct().select(F.col("tag").alias("query_id"), "id")


def _stab(ranges: DataFrame, points: DataFrame, levels: int) -> DataFrame:
    """query_id, b: points (b, top, at) that lie in a range (query_id, top, lft, rgt), by dyadic blocks."""
    r = ranges.select("query_id", "top", F.explode(H._cover(F.col("lft"), F.col("rgt"))).alias("c")).select("query_id", "top", "c.level", "c.block")
    p = points.select("b", "top", "at", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level")).select("b", "top", "level", F.expr("shiftright(at, level)").alias("block"))
    return r.join(p, ["top", "level", "block"]).select("query_id", "b")


def _spread(ranges: DataFrame, atoms: DataFrame, bits: int = 10) -> DataFrame:
    r = ranges.withColumn("block", F.explode(F.sequence(F.shiftright("lft", bits), F.shiftright("rgt", bits))))
    return r.join(atoms.withColumn("block", F.shiftright("at", bits)), ["top", "block"]).where("at between lft and rgt").select("query_id", "id")


_MONEY = "decimal(38,6)"


def _running(h: H.Hierarchy, values: DataFrame, column: str) -> DataFrame:
    """top, id, lft, rgt, v, upto: the sum of values of a tree up to each position. It is taken in blocks of 1,024
    positions and over the blocks, so no tree is summed in one task. A missing value counts as 0."""
    zero = F.lit(0).cast(_MONEY)
    a = h.atoms.where("top is not null").select("id", "top", "lft", "rgt").join(values.select("id", F.col(column).cast(_MONEY).alias("v")), "id", "left")
    a = a.withColumn("v", F.coalesce("v", zero)).withColumn("block", F.shiftright("lft", 10))
    blocks = a.groupBy("top", "block").agg(F.sum("v").alias("s"))
    skip = blocks.select("top", "block", (F.sum("s").over(Window.partitionBy("top").orderBy("block")) - F.col("s")).cast(_MONEY).alias("skip"))
    inner = Window.partitionBy("top", "block").orderBy("lft")
    return h.space.cut(a.withColumn("here", F.sum("v").over(inner)).join(skip, ["top", "block"]).select("id", "top", "lft", "rgt", "v", (F.col("here") + F.col("skip")).cast(_MONEY).alias("upto")))


def subtree_sums(h: H.Hierarchy, values: DataFrame, column: str) -> DataFrame:
    """id, total: the sum over an atom and the atoms of its tree above it, from two positions of a running sum."""
    run = _running(h, values, column)
    end = run.select("top", F.col("lft").alias("rgt"), F.col("upto").alias("last"))
    return run.join(end, ["top", "rgt"]).select("id", (F.col("last") - F.col("upto") + F.col("v")).alias("total"))
