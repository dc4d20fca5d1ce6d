"""Schemas that drift between the files of a stream.

Method: each file has a fingerprint (its fields with their types); files follow one another in versions. A change of
version is an explicit migration step: rename, add, remove or retype of one field. Records are routed into one table
by chaining the renames of their stream, file by file, to one name per field, filling absent fields with null and
casting. Every field has a column, those without a cast as text.

A rename is looked for only among fields that left and fields that came in the same step, and is decided by the values
of the records that both files hold, joined by id (one value per file, field and id, the first by line).

Defined results: unreadable payloads and payloads that are no object do not count; field names are case-sensitive; a
type is the most frequent JSON type of the non-null values of the file (ties: first by name), else that of the
preceding file; a field whose type was never known is never retyped. A field is renamed to at most one new field and
a new field comes from at most one old (largest share of equal values, ties by name).
"""

from __future__ import annotations

from collections.abc import Collection

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.storage import Workspace

_NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"


def fields(df: DataFrame, stream: str = "stream_no", file: str = "file_no", line: str = "line_no", payload: str = "payload", key: str = "id") -> DataFrame:
    """stream, file, line, rec (the key as text), field, kind (null for a null value), text (of the value)."""
    v = F.try_parse_json(F.col(payload))
    parsed = df.select(F.col(stream).alias("stream"), F.col(file).alias("file"), F.col(line).alias("line"), v.alias("v"))
    parsed = parsed.where(F.expr("schema_of_variant(v) like 'OBJECT%'")).withColumn("rec", F.expr(f"try_variant_get(v, '$.{key}', 'string')"))
    flat = parsed.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("v").outer())).select("stream", "file", "line", "rec", F.col("key").alias("field"), "value")
    kind = F.expr("substring_index(substring_index(schema_of_variant(value), '<', 1), '(', 1)")
    kind = F.when(kind == "VOID", None).when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "ARRAY", "array").when(kind == "OBJECT", "object").otherwise("number")
    text = F.expr("case when schema_of_variant(value) = 'STRING' then variant_get(value, '$', 'string') else to_json(value) end")
    return flat.select("stream", "file", "line", "rec", "field", kind.alias("kind"), text.alias("text"))


def _comparable(text: Column, kind: Column) -> Column:
    """Numbers and lists of numbers, also those written as text, in one spelling; other values as they are, by kind."""
    bare = F.regexp_replace(F.trim(text), r"^\[\s*|\s*\]$", "")
    listed = F.rlike(bare, F.lit(rf"^{_NUMBER}(?:\s*[,;]\s*{_NUMBER})*$"))
    empty = (bare == "") & kind.isin("array", "string")
    norm = F.array_join(F.transform(F.split(bare, r"\s*[,;]\s*"), lambda x: x.try_cast("double").cast("string")), ",")
    return F.when(kind.isNull(), None).when(empty, "#").when(kind.isin("string", "number", "array") & listed, F.concat(F.lit("#"), norm)).otherwise(F.concat(F.substring(kind, 1, 1), text))


def fingerprints(flat: DataFrame, files: DataFrame) -> DataFrame:
    """stream, file, prev_file, version, field, kind: the schema of every file; kind carried on where all are null."""
    counts = flat.groupBy("stream", "file", "field", "kind").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("stream", "file", "field").agg(F.min(F.when(F.col("kind").isNotNull(), F.struct((-F.col("n")).alias("n"), "kind"))).alias("top"))
    own = best.select("stream", "file", "field", F.col("top.kind").alias("own_kind"))
    out = own.join(files, ["stream", "file"])
    by_field = Window.partitionBy("stream", "field").orderBy("version")
    out = out.withColumn("island", F.col("version") - F.row_number().over(by_field))
    carried = F.last("own_kind", ignorenulls=True).over(Window.partitionBy("stream", "field", "island").orderBy("version"))
    return out.select("stream", "file", "prev_file", "version", "field", carried.alias("kind"))


def versions(fp: DataFrame) -> DataFrame:
    """stream, file, version, prev_file, fingerprint, n_fields, changed: a number for the schema of every file, the same for
    files of the same fields and kinds, whatever their order; changed tells whether it differs from the preceding file's."""
    mark = F.bit_xor(F.xxhash64("field", F.coalesce("kind", F.lit("")))).alias("fingerprint")
    one = fp.groupBy("stream", "file", "version", "prev_file").agg(mark, F.count(F.lit(1)).alias("n_fields"))
    before = F.lag("fingerprint").over(Window.partitionBy("stream").orderBy("version"))
    return one.withColumn("changed", F.coalesce(before != F.col("fingerprint"), F.lit(False)))


def file_versions(df: DataFrame, stream: str = "stream_no", file: str = "file_no") -> DataFrame:
    """stream, file, version (1, 2, ... by file number), prev_file."""
    w = Window.partitionBy("stream").orderBy("file")
    return df.select(F.col(stream).alias("stream"), F.col(file).alias("file")).where("stream is not null and file is not null").distinct().select("stream", "file", F.row_number().over(w).alias("version"), F.lag("file").over(w).alias("prev_file"))


def migrations(flat: DataFrame, files: DataFrame) -> DataFrame:
    """stream, file, change_kind, field_name, old_name, old_kind, new_kind: every step between consecutive files."""
    space = Workspace(flat.sparkSession, "migrations")
    fp = space.cut(fingerprints(flat, files))
    now = fp.where("prev_file is not null").select("stream", "file", "field", F.col("kind").alias("new_kind"))
    before = fp.select("stream", F.col("file").alias("prev_file"), "field", F.col("kind").alias("old_kind")).join(files.where("prev_file is not null").select("stream", "file", "prev_file"), ["stream", "prev_file"]).select("stream", "file", "field", "old_kind", F.lit(True).alias("was"))
    both = now.withColumn("is", F.lit(True)).join(before, ["stream", "file", "field"], "full_outer").withColumn("change", F.when(F.col("was").isNull(), "new").when(F.col("is").isNull(), "gone").otherwise("kept"))
    both = space.cut(both)
    moved = both.where("change <> 'kept'").groupBy("stream", "file").agg(F.bool_or(F.col("change") == "new").alias("n"), F.bool_or(F.col("change") == "gone").alias("g")).where("n and g").select("stream", "file")
    step = both.where("change <> 'kept'").join(moved, ["stream", "file"], "left_semi").join(files.select("stream", "file", "prev_file"), ["stream", "file"])
    # values are compared only of fields that left or came; what a file has of them is told by few names
    came = step.where("change = 'new'").select("stream", "file", "field", "file", F.lit("new").alias("side")).toDF("stream", "file", "field", "to_file", "side")
    left = step.where("change = 'gone'").select("stream", F.col("prev_file").alias("file"), "field", F.col("file").alias("to_file"), F.lit("old").alias("side"))
    sides = space.cut(came.unionByName(left))
    kept = flat.where("kind is not null and rec is not null").join(sides, ["stream", "file", "field"])
    one = kept.groupBy("stream", "to_file", "side", "field", "rec").agg(F.min_by(F.struct("text", "kind"), "line").alias("x"))
    one = one.select("stream", F.col("to_file").alias("file"), "side", "field", "rec", _comparable(F.col("x.text"), F.col("x.kind")).alias("val"))
    new_vals = one.where("side = 'new'").select("stream", "file", "rec", F.col("field").alias("new_field"), F.col("val").alias("new_val"))
    old_vals = one.where("side = 'old'").select("stream", "file", "rec", F.col("field").alias("old_field"), F.col("val").alias("old_val"))
    pairs = new_vals.join(old_vals, ["stream", "file", "rec"]).groupBy("stream", "file", "old_field", "new_field").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("new_val") == F.col("old_val")).alias("same")).where("same * 2 > n")
    score = [F.desc(F.col("same") / F.col("n")), F.desc("same")]
    pairs = pairs.withColumn("rn_new", F.row_number().over(Window.partitionBy("stream", "file", "new_field").orderBy(*score, "old_field"))).withColumn("rn_old", F.row_number().over(Window.partitionBy("stream", "file", "old_field").orderBy(*score, "new_field")))
    renames = pairs.where("rn_new = 1 and rn_old = 1").select("stream", "file", "old_field", "new_field")
    b = both.alias("b")
    r1, r2 = renames.alias("r1"), renames.alias("r2")
    j = b.join(r1, (F.col("b.stream") == F.col("r1.stream")) & (F.col("b.file") == F.col("r1.file")) & (F.col("b.field") == F.col("r1.new_field")) & (F.col("b.change") == "new"), "left")
    j = j.join(r2, (F.col("b.stream") == F.col("r2.stream")) & (F.col("b.file") == F.col("r2.file")) & (F.col("b.field") == F.col("r2.old_field")) & (F.col("b.change") == "gone"), "left")
    j = j.select("b.stream", "b.file", "b.field", "b.change", "b.new_kind", "b.old_kind", F.col("r1.old_field").alias("came_from"), F.col("r2.new_field").alias("went_to"))
    o = before.select(F.col("stream").alias("os"), F.col("file").alias("of"), F.col("field").alias("ofield"), F.col("old_kind").alias("from_kind"))
    j = j.join(o, (F.col("stream") == F.col("os")) & (F.col("file") == F.col("of")) & (F.col("came_from") == F.col("ofield")), "left")
    old_kind = F.coalesce("old_kind", "from_kind")
    steps = F.array(
        F.when(F.col("came_from").isNotNull(), "renamed"),
        F.when((F.col("change") == "new") & F.col("came_from").isNull(), "added"),
        F.when((F.col("change") == "gone") & F.col("went_to").isNull(), "removed"),
        F.when((F.col("new_kind") != old_kind), "retyped"),
    )
    return j.select("stream", "file", F.explode(F.array_compact(steps)).alias("change_kind"), F.col("field").alias("field_name"), F.coalesce("came_from", "field").alias("old_name"), old_kind.alias("old_kind"), "new_kind")


# ---- one table ------------------------------------------------------------------------------------------------------


def canonical_names(steps: DataFrame, flat: DataFrame, apart: Collection[str] = ()) -> dict[str, str]:
    """Name to canonical name: names linked by renames are one field; it is called by the name most files use. Names in
    apart are fields of their own: a rename that would make two of them one does not link them.

    Only field names come to the driver, never records.
    """
    links = [(r.old_name, r.field_name) for r in steps.where("change_kind = 'renamed'").select("old_name", "field_name").distinct().collect()]
    uses = {r.field: r.n for r in flat.groupBy("field").agg(F.countDistinct("stream", "file").alias("n")).collect()}
    parent = {f: f for f in uses}

    def top(x: str) -> str:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    own = {f: f for f in apart}  # of a group, its name in apart
    for a, b in sorted(links):
        a, b = top(a), top(b)
        if a != b and not (a in own and b in own):
            keep, lose = (a, b) if (uses.get(a, 0), b) >= (uses.get(b, 0), a) else (b, a)
            parent[lose] = keep
            if lose in own:
                own[keep] = own[lose]
    return {f: top(f) for f in uses}


def placements(steps: DataFrame, flat: DataFrame, names: dict[str, str]) -> DataFrame:
    """stream, file, field, column: where each field of each file belongs, its renames followed from file to file.

    A field keeps the column of the name it began with in its stream. Where two fields of a file claim one column, the
    one that is longer in the stream has it (ties: the one of that name, then first by name), the other one's column is
    also_ and its name.
    """
    there = flat.where("stream is not null and file is not null").select("stream", "file", "field").distinct()
    moved = steps.where("change_kind = 'renamed'").select("stream", "file", F.col("field_name").alias("field"), F.col("old_name").alias("old"))
    kinds = dict(there.dtypes)

    def follow(part: pd.DataFrame) -> pd.DataFrame:
        live: dict[str, tuple] = {}  # field: (number of the file it began in, name it began with)
        rows = []
        for k, (file, now) in enumerate(part.groupby("file", sort=True)):
            before, live, taken = live, {}, set()
            for field, old in zip(now["field"], now["old"]):
                live[field] = before.get(old) or before.get(field) or (k, field)
            for field, (_, first) in sorted(live.items(), key=lambda x: (x[1][0], names.get(x[1][1]) != x[0], x[0])):
                column = names.get(first, first)
                column = f"also_{field}" if column in taken else column
                taken.add(column)
                rows.append((part["stream"].iloc[0], file, field, column))
        return pd.DataFrame(rows, columns=["stream", "file", "field", "column"])

    return there.join(moved, ["stream", "file", "field"], "left").groupBy("stream").applyInPandas(follow, f"stream {kinds['stream']}, file {kinds['file']}, field string, column string")


#: How a field is cast: to a number, a whole number, a flag, a list of numbers or whole numbers, or left as text.
CASTS = ("double", "bigint", "boolean", "array<double>", "array<bigint>", "string")


def _cast(value: str, to: str) -> str:
    """SQL that casts a variant to one of CASTS; null where it can't be read so. Objects give their val or ids."""
    inner = f"coalesce(try_variant_get({value}, '$.val', 'variant'), try_variant_get({value}, '$.ids', 'variant'), {value})"
    text = f"try_variant_get({inner}, '$', 'string')"
    if to == "boolean":
        return f"case when lower({text}) in ('true', 'yes', '1') then true when lower({text}) in ('false', 'no', '0') then false end"
    if to in ("double", "bigint"):
        return f"try_cast({text} as {to})"
    if to.startswith("array"):
        item = to[6:-1]
        listed = f"try_variant_get({inner}, '$', 'array<{item}>')"
        split = f"transform(split(regexp_replace(trim({text}), '^\\\\[|\\\\]$', ''), ' *[,;] *'), x -> try_cast(x as {item}))"
        return f"coalesce({listed}, case when trim({text}) = '' then array() when not exists({split}, x -> x is null) then {split} end)"
    return f"coalesce({text}, to_json({value}))"


def one_table(df: DataFrame, names: dict[str, str], casts: dict[str, str], stream: str = "stream_no", file: str = "file_no", line: str = "line_no", payload: str = "payload", placed: DataFrame | None = None) -> DataFrame:
    """stream, file, line, one column per entry of casts and per other canonical name (as text), n_lost: every readable
    record. An entry of casts stands for all names of its field, whatever the field is called.

    placed (see placements) tells the column of each field of a file; records of files it doesn't name go by names, and
    one that has two names of one field then gives the first non-null in order of name. Absent fields are null. n_lost
    counts the non-null values of a record that no column has: those that can't be cast, and those without a place.
    """
    columns: dict[str, tuple[str, str]] = {}
    for field, to in casts.items():
        if names.get(field, field) in columns:
            raise ValueError(f"{field} and {columns[names[field]][0]} are one field")
        columns[names.get(field, field)] = (field, to)
    rest = set(names.values())
    p = df.select(F.col(stream).alias("stream"), F.col(file).alias("file"), F.col(line).alias("line"), F.col(payload).alias("payload"))
    if placed is None:
        p = p.withColumn("at", F.lit(None).cast("map<string,string>"))
    else:
        rest |= {r[0] for r in placed.select("column").distinct().collect()}  # names only
        p = p.join(placed.groupBy("stream", "file").agg(F.map_from_entries(F.collect_list(F.struct("column", "field"))).alias("at")), ["stream", "file"], "left")
    taken = {"stream", "file", "line", "n_lost", *(f.lower() for f in casts)}
    for column in sorted(rest - set(columns)):
        out = column
        while out.lower() in taken:
            out += "_"
        taken.add(out.lower())
        columns[column] = (out, "string")
    p = p.select("stream", "file", "line", "at", F.try_parse_json("payload").alias("v")).where(F.expr("schema_of_variant(v) like 'OBJECT%'"))
    p = p.select("stream", "file", "line", "at", F.expr("map_filter(try_variant_get(v, '$', 'map<string,variant>'), (k, x) -> not is_variant_null(x))").alias("m"))
    mine = {c: sorted(n for n in names if names[n] == c) or [c] for c in columns}
    get = lambda name: F.try_element_at("m", name)
    p = p.select("stream", "file", "line", F.size("m").alias("n_values"), *[F.when(F.col("at").isNull(), F.coalesce(*[get(F.lit(n)) for n in mine[c]])).otherwise(get(F.try_element_at("at", F.lit(c)))).alias(f"raw_{k}") for k, c in enumerate(columns)])
    p = p.select("stream", "file", "line", "n_values", *[F.expr(_cast(f"raw_{k}", to)).alias(f"val_{k}") for k, (_, to) in enumerate(columns.values())])
    n_placed = F.aggregate(F.array(*[F.col(f"val_{k}").isNotNull().cast("int") for k in range(len(columns))]), F.lit(0), lambda a, x: a + x)
    return p.select("stream", "file", "line", *[F.col(f"val_{k}").alias(out) for k, (out, _) in enumerate(columns.values())], (F.col("n_values") - n_placed).alias("n_lost"))
