"""Parent-child links to full hierarchies: outlets, steps, descendants as ranges, and cycles.

Method: nested sets. Atoms with one downstream atom form a forest, whose trees end in outlets or in branch atoms (two or
more downstream atoms). Subtree sizes are summed upward and siblings get consecutive preorder ranges by prefix sums, so
an atom's descendants are the atoms whose position lies in its range and its ancestors those whose range holds it. Both
passes double their reach in each round (an atom knows its 2^k-th atom downstream), so rounds follow the logarithm of
the depth. Atoms that no round ties to a tree end lead into a cycle. The links from branch atoms to their several
downstream atoms are a far smaller graph over tree ends; shortest steps to outlets and strongly connected parts are
found there, and carried to the trees through the ranges.

Each round is a written table in the shared folder and holds only the atoms that are still open, so no join has null
keys and the rounds shrink. Joins are on unique keys on one side; where many atoms name one downstream atom, the other
side of that join has one row for it, and AQE splits the many. Sibling prefix sums are taken in chunks, so that no
atom's children are sorted in one task.

Defined results: ids that are null are no atoms; entries that are null or name no atom are ignored; repeated rows and
entries count once; an own entry is a cycle of one unless the atom is on a longer one; an atom that only drains to
itself is no outlet. Empty input gives empty results.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.storage import Workspace

_CHUNK_BITS = 12


@dataclass
class Hierarchy:
    """atoms: id, parent, n_down, top, depth, size, lft, rgt, end (outlet, branch, sink, null for atoms that lead into a
    cycle of atoms with one downstream atom). links: from_id, to_id of branch atoms. own: ids that list themselves."""

    atoms: DataFrame
    links: DataFrame
    own: DataFrame
    space: Workspace
    levels: int = 44  # dyadic levels that the largest tree needs


def edges_of(df: DataFrame, key: str = "id", array: str = "upstream_ids") -> DataFrame:
    """from_id (drains) to_id; distinct, between atoms that have a row."""
    nodes = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("from_id")).distinct()
    e = df.where(F.col(key).isNotNull()).select(F.explode(array).alias("from_id"), F.col(key).cast("long").alias("to_id"))
    return e.where("from_id is not null").distinct().join(nodes, "from_id", "left_semi")


def build(df: DataFrame, key: str = "id", array: str = "upstream_ids") -> Hierarchy:
    """Nested sets of the forest, and the links beside it."""
    space = Workspace(df.sparkSession, "hierarchy")
    nodes = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id")).distinct()
    edges = space.cut(edges_of(df, key, array))
    own = edges.where("from_id = to_id").select(F.col("from_id").alias("id"))
    down = edges.where("from_id <> to_id").groupBy(F.col("from_id").alias("id")).agg(F.count(F.lit(1)).alias("n_down"), F.min("to_id").alias("parent"))
    base = nodes.join(down, "id", "left").join(own.withColumn("is_own", F.lit(True)), "id", "left")
    n = F.coalesce("n_down", F.lit(0))
    base = space.cut(base.select("id", F.when(n == 1, F.col("parent")).alias("parent"), n.alias("n_down"), F.when(n > 1, "branch").when((n == 0) & F.col("is_own").isNull(), "outlet").when(n == 0, "sink").alias("end")))
    links = space.cut(edges.where("from_id <> to_id").join(base.where("n_down > 1").select(F.col("id").alias("from_id")), "from_id", "left_semi"))

    # upward: of an open atom, jump is the atom 2^k below it; its contributions go there. Once the tree's end is known it
    # is closed, is written once more and takes no further part
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    rows, is_open = F.count(F.lit(1)), F.count_if(F.col("jump").isNotNull())
    closed = [base.where("parent is null").select("id", F.col("id").alias("top"), zero.alias("depth"))]
    moved, n = space.counted(base.where("parent is not null").select("id", F.col("parent").alias("jump"), F.lit(None).cast("long").alias("top"), zero.alias("depth"), one.alias("size")), n=rows)
    gains, before, far_below, now = [], None, 1, n["n"]
    while now and now != before:
        live = moved.where("jump is not null")
        add = space.cut(live.groupBy(F.col("jump").alias("id")).agg(F.sum("size").alias("more")))
        gains.append(add)
        ends = _union(closed).select(F.col("id").alias("jump"), F.lit(None).cast("long").alias("j2"), F.col("top").alias("t2"), F.col("depth").alias("d2"))
        far = live.select(F.col("id").alias("jump"), F.col("jump").alias("j2"), F.lit(None).cast("long").alias("t2"), zero.alias("d2")).unionByName(ends)
        step = live.join(far, "jump").join(add, "id", "left")
        new, n = space.counted(step.select("id", F.col("j2").alias("jump"), F.col("t2").alias("top"), (F.lit(far_below).cast("long") + F.col("d2")).alias("depth"), (F.col("size") + F.coalesce("more", F.lit(0))).alias("size")), n=is_open)
        closed.append(new.where("jump is null").select("id", "top", "depth"))
        moved, before, now, far_below = new, now, n["n"], far_below * 2
    more = _union(gains).groupBy("id").agg(F.sum("more").alias("more")) if gains else None
    sized = _union(closed).join(base.select("id", "parent"), "id")
    sized = sized.join(more, "id", "left").withColumn("size", one + F.coalesce("more", F.lit(0))).drop("more") if gains else sized.withColumn("size", one)
    sized, n = space.counted(sized.select("id", "parent", "top", "depth", "size"), size=F.max("size"), depth=F.max("depth"))
    space.drop(*gains)

    # downward: siblings' offsets, then sums along the way to the tree's end; here too closed atoms are left alone
    t = space.cut(_offsets(sized))
    done = [t.where("jump is null").select("id", "at")]
    for _ in range(int(n["depth"] or 0).bit_length()):
        live = t.where("jump is not null")
        far = live.select(F.col("id").alias("jump"), F.col("jump").alias("j2"), F.col("at").alias("at2")).unionByName(_union(done).select(F.col("id").alias("jump"), F.lit(None).cast("long").alias("j2"), F.col("at").alias("at2")))
        t = space.cut(live.join(far, "jump").select("id", F.col("j2").alias("jump"), (F.col("at") + F.col("at2")).alias("at")))
        done.append(t.where("jump is null").select("id", "at"))
    placed = sized.select("id", "top", "depth", "size").join(_union(done).select("id", F.col("at").alias("lft")), "id")
    atoms = space.cut(base.select("id", "parent", "n_down", F.col("end").alias("own_end")).join(placed, "id", "left").join(base.where("end is not null").select(F.col("id").alias("top"), "end"), "top", "left").select("id", "parent", "n_down", "top", "depth", "size", "lft", (F.col("lft") + F.col("size") - 1).alias("rgt"), "end"))
    return Hierarchy(atoms, links, own, space, int(n["size"] or 1).bit_length())


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _offsets(sized: DataFrame) -> DataFrame:
    """id, jump (parent), at: 0 for a tree's end, else 1 + the sizes of the siblings with smaller ids. Two-level sums."""
    kids = sized.where("parent is not null").withColumn("chunk", F.shiftright("id", _CHUNK_BITS))
    sums = kids.groupBy("parent", "chunk").agg(F.sum("size").alias("s"))
    before = Window.partitionBy("parent").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("parent", "chunk", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("skip"))
    inner = Window.partitionBy("parent", "chunk").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    kids = kids.withColumn("here", F.coalesce(F.sum("size").over(inner), F.lit(0))).join(sums, ["parent", "chunk"])
    return kids.select("id", F.col("parent").alias("jump"), (F.col("here") + F.col("skip") + 1).alias("at")).unionByName(sized.where("parent is null").select("id", F.lit(None).cast("long").alias("jump"), F.lit(0).cast("long").alias("at")))


# ---- ranges ---------------------------------------------------------------------------------------------------------


def _cover(lo: Column, hi: Column) -> Column:
    """The dyadic blocks (level, block) that exactly tile [lo, hi]; at most two on each level."""

    def at(level: Column) -> Column:
        size = F.pow(F.lit(2), level).cast("long")
        first = F.ceil(lo / size).cast("long")
        last = F.floor((hi + 1) / size).cast("long") - 1
        inside = lambda i, s: (i * s >= lo) & ((i + 1) * s - 1 <= hi)
        ok = lambda i: inside(i, size) & ~inside(F.floor(i / 2).cast("long"), size * 2)
        return F.transform(F.filter(F.array_distinct(F.array(first, last)), ok), lambda i: F.struct(level.alias("level"), i.alias("block")))

    levels = F.sequence(F.lit(0), F.floor(F.log2(hi - lo + 1)).cast("int"))
    return F.flatten(F.transform(levels, at))


def ancestors(h: Hierarchy, points: DataFrame) -> DataFrame:
    """tag, id: of each point (tag, top, at: a position in a tree) all atoms on its way to the tree's end, itself included.

    The ranges that hold a position, by an equi-join on dyadic blocks: no range is compared with all positions.
    """
    a = h.atoms.where("top is not null").select("id", "top", "lft", "rgt")
    tops = points.select("top").distinct()
    a = a.join(tops, "top", "left_semi").select("id", "top", F.explode(_cover(F.col("lft"), F.col("rgt"))).alias("c")).select("id", "top", "c.level", "c.block")
    p = points.select("tag", "top", "at", F.explode(F.sequence(F.lit(0), F.lit(h.levels))).alias("level")).select("tag", "top", "level", F.expr("shiftright(at, level)").alias("block"))
    return p.join(a, ["top", "level", "block"]).select("tag", "id")


def descendants(h: Hierarchy, queries: DataFrame) -> DataFrame:
    """query_id, id: all atoms in the range of each queried atom (its tree above it), itself left out."""
    bits = 10
    q = queries.join(h.atoms, "id").where("top is not null").select(F.col("id").alias("query_id"), "top", "lft", "rgt")
    q = q.withColumn("block", F.explode(F.sequence(F.shiftright("lft", bits), F.shiftright("rgt", bits))))
    a = h.atoms.where("top is not null").select("id", "top", F.col("lft").alias("at"), F.shiftright("lft", bits).alias("block"))
    return q.join(a, ["top", "block"]).where("at > lft and at <= rgt").select("query_id", "id")


# ---- the graph over tree ends ---------------------------------------------------------------------------------------


def _contracted(h: Hierarchy) -> DataFrame:
    """b, to_id, top, end, w, at: each link of a branch atom with the tree end it leads to and the steps until there."""
    a = h.atoms.where("top is not null").select(F.col("id").alias("to_id"), "top", "end", (F.col("depth") + 1).alias("w"), F.col("lft").alias("at"))
    return h.links.select(F.col("from_id").alias("b"), "to_id").join(a, "to_id")


def _steps_of_branches(h: Hierarchy, contracted: DataFrame) -> DataFrame:
    """b, r, d: the fewest links from a branch atom to each outlet it reaches. Rounds follow the number of branch atoms on a
    way; in each only what became shorter is carried on."""
    links = h.space.cut(contracted.groupBy("b", "top", "end").agg(F.min("w").alias("w")))
    onward = links.where("end = 'branch'").select("b", "top", "w")
    fresh = F.count_if(F.col("fresh"))
    known, n = h.space.counted(links.where("end = 'outlet'").groupBy("b", F.col("top").alias("r")).agg(F.min("w").alias("d")).withColumn("fresh", F.lit(True)), n=fresh)
    while n["n"]:
        front = known.where("fresh").select(F.col("b").alias("top"), "r", "d")
        step = onward.join(front, "top").groupBy("b", "r").agg(F.min(F.col("w") + F.col("d")).alias("d1"))
        both = known.select("b", "r", F.col("d").alias("d0")).join(step, ["b", "r"], "full_outer")
        new, n = h.space.counted(both.select("b", "r", F.least("d0", "d1").alias("d"), F.coalesce(F.col("d0").isNull() | (F.col("d1") < F.col("d0")), F.lit(False)).alias("fresh")), n=fresh)
        h.space.drop(known)
        known = new
    return known.select("b", "r", "d")


def outlets(h: Hierarchy) -> DataFrame:
    """atom_id, root_id, steps: every outlet an atom reaches, with the fewest links."""
    known = _steps_of_branches(h, _contracted(h))
    a = h.atoms.select("id", "top", "depth", "end")
    direct = a.where("end = 'outlet'").select(F.col("id").alias("atom_id"), F.col("top").alias("root_id"), F.col("depth").alias("steps"))
    through = a.where("end = 'branch'").join(known.select(F.col("b").alias("top"), "r", "d"), "top").select(F.col("id").alias("atom_id"), F.col("r").alias("root_id"), (F.col("depth") + F.col("d")).alias("steps"))
    return direct.unionByName(through)


def paths(h: Hierarchy, queries: DataFrame) -> DataFrame:
    """atom_id, root_id, steps, path: for each queried atom and each outlet it reaches, the atoms on a shortest way, both
    included, from the atom down. Where ways are equally short, the one to the smaller next atom.

    Within a tree the way is the ancestors' ranges; at a branch atom the next one is looked up. Rounds follow the number of
    branch atoms on a way.
    """
    contracted = h.space.cut(_contracted(h))
    known = h.space.cut(_steps_of_branches(h, contracted))
    # the way on from a branch atom to an outlet: the tree entered, where, and what remains from there
    entry = contracted.select("b", "to_id", "top", "end", "w", "at")
    to_outlet = entry.where("end = 'outlet'").select("b", F.col("top").alias("r"), (F.col("w")).alias("d"), "to_id", "top", "at", (F.col("w") - 1).alias("depth"), "end")
    to_branch = entry.where("end = 'branch'").join(known.select(F.col("b").alias("top"), "r", F.col("d").alias("rest")), "top").select("b", "r", (F.col("w") + F.col("rest")).alias("d"), "to_id", "top", "at", (F.col("w") - 1).alias("depth"), "end")
    best = to_outlet.unionByName(to_branch).groupBy("b", "r").agg(F.min(F.struct("d", "to_id", "top", "at", "depth", "end")).alias("x"))
    onward = h.space.cut(best.select("b", "r", "x.top", "x.at", "x.depth", "x.end"))
    a = h.atoms.where("top is not null").join(queries.select("id").distinct(), "id").select(F.col("id").alias("q"), "top", F.col("lft").alias("at"), "depth", "end")
    start = a.where("end = 'outlet'").withColumn("r", F.col("top")).unionByName(a.where("end = 'branch'").join(known.select(F.col("b").alias("top"), "r"), "top"))
    front, n = h.space.counted(start.select("q", "r", "top", "at", "depth", "end", F.lit(0).cast("long").alias("gone")), n=F.count_if(F.col("end") == "branch"))
    legs = [front]
    while n["n"]:
        at_branch = front.where("end = 'branch'").select("q", "r", F.col("top").alias("b"), (F.col("gone") + F.col("depth") + 1).alias("gone"))
        front, n = h.space.counted(at_branch.join(onward, ["b", "r"]).select("q", "r", "top", "at", "depth", "end", "gone"), n=F.count_if(F.col("end") == "branch"))
        legs.append(front)
    points = h.space.cut(_union(legs))
    above = ancestors(h, points.select(F.struct("q", "r", (F.col("gone") + F.col("depth")).alias("end_step")).alias("tag"), "top", "at"))
    placed = above.join(h.atoms.select("id", F.col("depth").alias("left")), "id").select("tag.q", "tag.r", (F.col("tag.end_step") - F.col("left")).alias("step"), "id")
    way = placed.groupBy("q", "r").agg(F.sort_array(F.collect_list(F.struct("step", "id"))).alias("p"))
    return way.select(F.col("q").alias("atom_id"), F.col("r").alias("root_id"), (F.size("p") - 1).cast("long").alias("steps"), F.col("p.id").alias("path"))


def _ring_cycles(h: Hierarchy) -> DataFrame:
    """label, id: cycles of atoms with one downstream atom each, among those that no round tied to a tree."""
    t, n = h.space.counted(h.atoms.where("top is null").select("id", F.col("parent").alias("jump"), F.col("id").alias("least")), n=F.count(F.lit(1)))
    for _ in range(n["n"].bit_length()):
        far = t.select(F.col("id").alias("jump"), F.col("jump").alias("j2"), F.col("least").alias("l2"))
        t = h.space.cut(t.join(far, "jump").select("id", F.col("j2").alias("jump"), F.least("least", "l2").alias("least")))
    on = t.select(F.col("jump").alias("id")).distinct()  # after n steps or more every atom is on a cycle
    return t.join(on, "id", "left_semi").select(F.col("least").alias("label"), "id")


def _trim(h: Hierarchy, e: DataFrame) -> tuple[DataFrame, int]:
    """Edges (b, t) without those that start where none ends or end where none starts, again and again, and their number."""
    rows = F.count(F.lit(1))
    e, n = h.space.counted(e, n=rows)
    now, before = n["n"], None
    while now and now != before:
        ends = e.select(F.col("t").alias("b")).distinct()
        new, n = h.space.counted(e.join(ends, "b", "left_semi").join(e.select(F.col("b").alias("t")).distinct(), "t", "left_semi").select("b", "t"), n=rows)
        h.space.drop(e)
        e, before, now = new, now, n["n"]
    return e, now


def _components(h: Hierarchy, e: DataFrame) -> DataFrame | None:
    """label, b: strongly connected parts of the graph (b, t) that hold a cycle, by colouring forward and back."""
    found = None
    e, left = _trim(h, e.distinct())
    while left:
        nodes = e.select("b").union(e.select("t")).distinct()
        colour, n = h.space.counted(nodes.select("b", F.col("b").alias("c"), F.lit(True).alias("moved")), n=F.count_if(F.col("moved")))
        while n["n"]:  # the least atom that reaches each; only those whose colour changed hand it on
            inc = e.join(colour.where("moved"), "b").groupBy(F.col("t").alias("b")).agg(F.min("c").alias("c2"))
            new, n = h.space.counted(colour.join(inc, "b", "left").select("b", F.least("c", F.coalesce("c2", "c")).alias("c"), F.coalesce(F.col("c2") < F.col("c"), F.lit(False)).alias("moved")), n=F.count_if(F.col("moved")))
            h.space.drop(colour)
            colour = new
        same = h.space.cut(e.join(colour.select("b", "c"), "b").join(colour.select(F.col("b").alias("t"), F.col("c").alias("ct")), "t").where("c = ct").select("b", "t", "c"))
        reach, n = h.space.counted(colour.where("b = c").select("b", "c", F.lit(True).alias("fresh")), n=F.count_if(F.col("fresh")))
        while n["n"]:  # what reaches the colour's own atom without leaving the colour
            back = same.join(reach.where("fresh").select(F.col("b").alias("t"), "c"), ["t", "c"]).select("b", "c").distinct().withColumn("come", F.lit(True))
            both = reach.select("b", "c", F.lit(True).alias("old")).join(back, ["b", "c"], "full_outer")
            new, n = h.space.counted(both.select("b", "c", F.col("old").isNull().alias("fresh")), n=F.count_if(F.col("fresh")))
            h.space.drop(reach)
            reach = new
        reach = reach.select("b", "c")
        part = reach.select(F.col("c").alias("label"), "b")
        loops = same.join(reach, ["b", "c"], "left_semi").join(reach.select(F.col("b").alias("t"), "c"), ["t", "c"], "left_semi").select("c").distinct()
        part = h.space.cut(part.join(loops.select(F.col("c").alias("label")), "label", "left_semi"))
        found = part if found is None else found.unionByName(part)
        gone = reach.select("b")
        e, left = _trim(h, e.join(gone, "b", "left_anti").join(gone.select(F.col("b").alias("t")), "t", "left_anti"))
    return found


def cycles(h: Hierarchy) -> DataFrame:
    """atom_id, root_id, steps: atoms on cycles, with the least atom and the number of atoms of their connected part."""
    links = h.space.cut(_contracted(h).where("end = 'branch'").select("b", "to_id", F.col("top").alias("t"), "at"))
    members = _ring_cycles(h)
    parts = _components(h, links.select("b", "t"))
    if parts is not None:
        parts = h.space.cut(parts)
        inner = links.join(parts, "b").join(parts.select(F.col("b").alias("t"), F.col("label").alias("l2")), "t").where("label = l2")
        between = ancestors(h, inner.select(F.col("label").alias("tag"), F.col("t").alias("top"), "at"))
        members = members.unionByName(parts.select("label", F.col("b").alias("id"))).unionByName(between.select(F.col("tag").alias("label"), "id"))
    members = h.space.cut(members.distinct())
    sizes = members.groupBy("label").agg(F.min("id").alias("root_id"), F.count(F.lit(1)).alias("steps"))
    found = members.join(sizes, "label").select(F.col("id").alias("atom_id"), "root_id", "steps")
    alone = h.own.join(members, "id", "left_anti").select(F.col("id").alias("atom_id"), F.col("id").alias("root_id"), F.lit(1).cast("long").alias("steps"))
    return found.unionByName(alone)
