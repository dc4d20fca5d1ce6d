"""Column profiles by feed and load: nulls, distinct values, range, invalid values, repeats and shifts.

Method: footers first, chunk by chunk (a chunk is one column of one row group).

- By column (column_profile): nulls and extrema come from the footers, distinct values from the dictionaries of chunks
  that are dictionary-encoded throughout. Only a chunk that lacks one of them is read, and of its file nothing else.
- By load (load_profile, full_profile): medians and shares of single values need counts, which footers don't have. A
  chunk of one load that is wholly null, or holds one value by statistics and by a one-entry dictionary (so that no NaN
  hides behind the statistics), is answered from its footer. A file that has such chunks and others is read chunk by
  chunk, without the settled ones; a file without any is left to Spark's reader, with the profiled columns only.
- A footer that can't be read (a store that pyarrow lacks, a broken file) settles nothing: by load its file, by column
  its table is left to Spark's reader, which gives the values or fails. chunk_statistics lists the file with its error.

The scan never sorts or collects a load: pass 1 counts rows by load and logarithmic bucket of the value, pass 2 counts
exact values only in the buckets that hold a median or may hold a value of a large share. Both are map-side combined,
and a load of any size shuffles at most (buckets per load) x (tasks) rows.

Defined results: null counts as null; NaN is non-null and invalid; infinities and negatives are invalid; -0.0 equals 0.
Rows whose feed or load_no is null form groups of their own that are never compared with a preceding load. Empty
tables give no rows. Extra columns are ignored; the names used inside are private to the operator.
"""

from __future__ import annotations

import math
import struct
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillstone.storage import Workspace

GROUP = ["src_table", "column_name", "feed", "load_no"]
#: Buckets to an octave of values; a float32 bucket then holds at most 2**23 / 64 distinct values.
BUCKETS_PER_OCTAVE = 64
_NULL, _INVALID, _ZERO = -2_000_000, -1_999_999, -1_999_998


# ---- footers -------------------------------------------------------------------------------------------------------


def _varint(b: bytes, i: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        out |= (b[i] & 127) << shift
        i += 1
        if b[i - 1] < 128:
            return out, i
        shift += 7


def _struct(b: bytes, i: int) -> tuple[dict, int]:
    """A thrift compact struct as {field id: value}; nested structs too. Enough for page headers."""
    out: dict = {}
    fid = 0
    while True:
        head = b[i]
        i += 1
        kind = head & 15
        if kind == 0:
            return out, i
        if head >> 4:
            fid += head >> 4
        else:
            z, i = _varint(b, i)
            fid = (z >> 1) ^ -(z & 1)
        if kind in (1, 2):
            out[fid] = kind == 1
        elif kind == 3:
            out[fid] = b[i]
            i += 1
        elif kind in (4, 5, 6):
            z, i = _varint(b, i)
            out[fid] = (z >> 1) ^ -(z & 1)
        elif kind == 7:
            out[fid] = b[i : i + 8]
            i += 8
        elif kind == 8:
            n, i = _varint(b, i)
            out[fid] = b[i : i + n]
            i += n
        elif kind == 12:
            out[fid], i = _struct(b, i)
        else:
            raise ValueError(f"page header with thrift kind {kind}")


def chunk_dictionary(handle, column) -> list[float] | None:
    """The dictionary of a float column chunk, or None where a data page is not dictionary-encoded (or can't be read).

    Walks the chunk's page headers and decodes the dictionary page alone; data pages are skipped, not decoded.
    """
    import pyarrow as pa

    form = {"FLOAT": ("f", 4), "DOUBLE": ("d", 8), "INT32": ("i", 4), "INT64": ("q", 8)}.get(column.physical_type)
    if not column.has_dictionary_page or form is None:
        return None
    handle.seek(column.dictionary_page_offset or column.data_page_offset)
    raw = handle.read(column.total_compressed_size)
    i, values, got = 0, None, 0
    try:
        while i < len(raw) and got < column.num_values:
            head, i = _struct(raw, i)
            body = raw[i : i + head[3]]
            i += head[3]
            if head[1] == 2:
                if column.compression != "UNCOMPRESSED":
                    body = pa.Codec(column.compression.lower()).decompress(body, head[2]).to_pybytes()
                n = head[7][1]
                values = list(struct.unpack(f"<{n}{form[0]}", body[: n * form[1]]))
            elif head[1] in (0, 3):
                inner = head[5] if head[1] == 0 else head[8]
                if inner[2 if head[1] == 0 else 4] not in (2, 8):
                    return None
                got += inner[1]
    except (IndexError, KeyError, ValueError, struct.error, pa.ArrowException):
        return None
    return values


def _file_chunks(uri: str, columns: list[str], group: list[str], dictionaries: str) -> list[tuple]:
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    rows = []
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as handle:
        meta = pq.ParquetFile(handle).metadata
        for g in range(meta.num_row_groups):
            rg = meta.row_group(g)
            by = {rg.column(k).path_in_schema: rg.column(k) for k in range(rg.num_columns)}
            keys = []
            for k in group:
                s = by[k].statistics if k in by else None
                one = s is not None and s.has_min_max and s.null_count == 0 and s.min == s.max
                keys.append(s.min if one else None)
            for c in columns:
                if c not in by:  # read as null
                    rows.append((uri, g, c, *keys, rg.num_rows, rg.num_rows, None, None, None, None, 0, None))
                    continue
                s = by[c].statistics
                nulls = s.null_count if s is not None and s.has_null_count else None
                low, high = (float(s.min), float(s.max)) if s is not None and s.has_min_max else (None, None)
                wanted = dictionaries == "all" or dictionaries == "one load" and nulls != rg.num_rows and all(k is not None for k in keys)
                words = chunk_dictionary(handle, by[c]) if wanted else None
                nan = None if words is None else any(isinstance(x, float) and math.isnan(x) for x in words)
                listed = [float(x) for x in words if x == x] if words is not None and dictionaries == "all" else None
                rows.append((uri, g, c, *keys, rg.num_rows, nulls, low, high, None if words is None else len(words), nan, by[c].total_compressed_size, listed))
    return rows


def _read_footers(columns: list[str], group: list[str], dictionaries: str):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for uri in batch["path"]:
                try:
                    rows += [(*r, None) for r in _file_chunks(uri, columns, group, dictionaries)]
                except (OSError, ValueError, pa.ArrowException) as e:
                    rows += [(uri, None, c, *[None] * (len(group) + 8), f"{type(e).__name__}: {e}") for c in columns]
            yield pd.DataFrame(rows, columns=["path", "row_group", "column_name", *group, "n_rows", "n_null", "min_value", "max_value", "n_dictionary", "has_nan", "n_bytes", "dictionary", "error"]).astype({"row_group": "Int32", "n_rows": "Int64", "n_null": "Int64", "n_dictionary": "Int64", "has_nan": "boolean", "n_bytes": "Int64", **{g: "Int64" for g in group}})

    return run


def chunk_statistics(df: DataFrame, columns: list[str], group: tuple[str, ...] = ("feed", "load_no"), dictionaries: str = "one load") -> DataFrame:
    """One row per column chunk of a parquet table, from footers and dictionary pages only.

    A group column is given where the row group holds one value of it, else null. n_dictionary and has_nan are given
    for chunks that are dictionary-encoded throughout: then n_dictionary is the exact number of distinct non-null
    values. dictionaries: those of chunks of "one load", "all" (then dictionary holds the values but NaN), or "none". n_bytes is
    what reading the chunk would take. A file whose footer can't be read has a row for each column, with nothing but its
    path and error.
    """
    spark = df.sparkSession
    files = df.inputFiles()
    keys = "".join(f"{g} long, " for g in group)
    schema = f"path string, row_group int, column_name string, {keys}n_rows long, n_null long, min_value double, max_value double, n_dictionary long, has_nan boolean, n_bytes long, dictionary array<double>, error string"
    listed = spark.createDataFrame(pd.DataFrame({"path": files}, dtype="str"), "path string").repartition(max(1, min(len(files), 2000)))
    return listed.mapInPandas(_read_footers(columns, list(group), dictionaries), schema)


def _settled() -> Column:
    """The chunk needs no scan: one load, and wholly null or of one known value that is not NaN."""
    one_load = F.col("feed").isNotNull() & F.col("load_no").isNotNull()
    constant = (F.col("min_value") == F.col("max_value")) & (F.col("n_dictionary") == 1) & ~F.col("has_nan")
    return F.coalesce(one_load & ((F.col("n_null") == F.col("n_rows")) | constant), F.lit(False))


def bucket(value: Column) -> Column:
    """A number that grows with the value, the same for close values; of its own for null, invalid and zero."""
    good = ~F.isnan(value) & (value >= 0) & (value < float("inf"))
    return (
        F.when(value.isNull(), _NULL)
        .when(~good, _INVALID)
        .when(value == 0, _ZERO)
        .otherwise(F.floor(F.log2(value) * BUCKETS_PER_OCTAVE).cast("int"))
    )


def _pairs(columns: list[str]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns])).alias("p")


def _long(df: DataFrame, src: str, columns: list[str]) -> DataFrame:
    return df.select("feed", "load_no", _pairs(columns)).select(F.lit(src).alias("src_table"), "p.column_name", F.col("feed").cast("int").alias("feed"), F.col("load_no").cast("int").alias("load_no"), "p.v")


def _read_chunks(group: list[str]):
    def run(batches):
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        for batch in batches:
            for uri, g, c in zip(*(batch[k].to_pylist() for k in ("path", "row_group", "column_name"))):
                fs, path = pafs.FileSystem.from_uri(uri)
                with fs.open_input_file(path) as handle:
                    f = pq.ParquetFile(handle)
                    there = [k for k in (*group, c) if k in f.schema_arrow.names]
                    t = f.read_row_group(g, columns=there)
                take = lambda k, to: t[k].cast(to) if k in there else pa.nulls(t.num_rows, to)  # noqa: E731, B023
                out = pa.table([pa.array([c] * t.num_rows, pa.string()), *(take(k, pa.int64()) for k in group), take(c, pa.float64())], ["column_name", *group, "v"])
                yield from out.to_batches(max_chunksize=65_536)

    return run


def read_chunks(chunks: DataFrame, group: tuple[str, ...] = ("feed", "load_no")) -> DataFrame:
    """column_name, group columns, v: the values of the listed chunks (path, row_group, column_name), and nothing else of
    their files but the group columns. A task has few chunks, each as large as one column of a row group."""
    n = chunks.count()
    keys = "".join(f"{g} long, " for g in group)
    return chunks.select("path", "row_group", "column_name").repartition(max(1, min(n, 2000))).mapInArrow(_read_chunks(list(group)), f"column_name string, {keys}v double")


def chunk_plan(df: DataFrame, columns: list[str]) -> DataFrame:
    """chunk_statistics, and how a profile by load gets each chunk's values: `footer`, `chunk` (read by itself), `file`
    (with the whole file, no chunk of which is settled)."""
    c = chunk_statistics(df, columns).withColumn("settled", _settled())
    some = F.max(F.col("settled").cast("int")).over(Window.partitionBy("path"))
    return c.withColumn("source", F.when(F.col("settled"), "footer").when(some == 1, "chunk").otherwise("file")).drop("settled", "dictionary")


def _parts(spark: SparkSession, tables: dict[str, tuple[DataFrame, list[str]]]) -> tuple[DataFrame, DataFrame | None]:
    """Values to scan in long form, and (group, value, count) rows that the footers settle."""
    scans, known = [], []
    for src, (df, columns) in tables.items():
        files = df.inputFiles()
        by_chunk: set[str] = set()
        if files:
            chunks = Workspace(spark, "footers").cut(chunk_plan(df, columns))
            by_chunk = {r.path for r in chunks.where("source <> 'file'").select("path").distinct().collect()}  # file names only, like the list they come from
        if by_chunk:
            df = spark.read.schema(df.schema).parquet(*[f for f in files if f not in by_chunk]) if len(by_chunk) < len(files) else spark.createDataFrame([], df.schema)
            rest = chunks.where("source = 'chunk'")
            if not rest.isEmpty():
                scans.append(read_chunks(rest).select(F.lit(src).alias("src_table"), "column_name", F.col("feed").cast("int").alias("feed"), F.col("load_no").cast("int").alias("load_no"), "v"))
            keyed = chunks.where("source = 'footer'").select(F.lit(src).alias("src_table"), "column_name", F.col("feed").cast("int").alias("feed"), F.col("load_no").cast("int").alias("load_no"), "n_rows", "n_null", "min_value")
            known.append(keyed.select(*GROUP, F.lit(None).cast("double").alias("v"), F.col("n_null").alias("n")).unionByName(keyed.select(*GROUP, F.col("min_value").alias("v"), (F.col("n_rows") - F.col("n_null")).alias("n"))).where("n > 0"))
        scans.append(_long(df, src, columns))
    union = lambda xs: xs[0] if len(xs) == 1 else xs[0].unionByName(union(xs[1:]))
    return union(scans), union(known) if known else None


def column_profile(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """src_table, column_name, n_rows, n_null, n_distinct, min_value, max_value of whole columns: from footers and
    dictionaries, and from the values of those chunks that have no null count, no extrema or no whole dictionary. A table
    with a footer that can't be read is scanned instead.

    NaN is one distinct value and has no part in the range; -0.0 equals 0. Tables without rows give none.
    """
    spark = next(iter(tables.values()))[0].sparkSession
    out = []
    for src, (df, columns) in tables.items():
        if not df.inputFiles():
            continue
        chunks, seen = Workspace(spark, "footers").counted(chunk_statistics(df, columns, (), "all"), failed=F.count("error"))
        enough = F.coalesce((F.col("n_null") == F.col("n_rows")) | (F.col("n_null").isNotNull() & F.col("n_dictionary").isNotNull() & (F.col("min_value").isNotNull() | F.col("has_nan"))), F.lit(False))
        told = chunks.where(F.lit(not seen["failed"])).withColumn("enough", enough)
        value = lambda c: (F.col(c) + F.lit(0.0)).alias("v")
        candidates = told.where("enough").select("column_name", F.explode(F.concat("dictionary", F.when(F.col("has_nan"), F.array(F.lit(math.nan))).otherwise(F.array().cast("array<double>")))).alias("x")).select("column_name", value("x"), F.lit(0).cast("long").alias("n"))
        counts = told.where("enough").groupBy("column_name").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.min("min_value").alias("lo"), F.max("max_value").alias("hi"))
        values = df.select(_pairs(columns)).select("p.*") if seen["failed"] else read_chunks(told.where(~F.col("enough")), ())
        read = values.select("column_name", value("v"), F.lit(1).cast("long").alias("n"))
        by_value = candidates.unionByName(read).groupBy("column_name", "v").agg(F.sum("n").alias("n"))
        real = F.when(~F.isnan("v"), F.col("v"))
        scanned = by_value.groupBy("column_name").agg(F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("n_null"), F.count("v").alias("n_distinct"), F.min(real).alias("lo"), F.max(real).alias("hi"))
        both = counts.withColumn("n_distinct", F.lit(0).cast("long")).unionByName(scanned)
        total = both.groupBy("column_name").agg(*[F.sum(c).alias(c) for c in ("n_rows", "n_null", "n_distinct")], (F.min("lo") + F.lit(0.0)).alias("min_value"), (F.max("hi") + F.lit(0.0)).alias("max_value"))
        out.append(total.where("n_rows > 0").select(F.lit(src).alias("src_table"), "column_name", "n_rows", "n_null", "n_distinct", "min_value", "max_value"))
    if not out:
        return spark.createDataFrame([], "src_table string, column_name string, n_rows long, n_null long, n_distinct long, min_value double, max_value double")
    return reduce(DataFrame.unionByName, out)


def load_profile(spark: SparkSession, tables: dict[str, tuple[DataFrame, list[str]]], heavy_share: float = 0.2) -> DataFrame:
    """One row per table, column, feed and load: n_rows, n_null, n_invalid, n_valid, median, top_count.

    tables: name to (parquet DataFrame with feed and load_no, columns to profile). median is the exact median of the
    valid values (the mean of the middle two), top_count the number of rows of the most frequent valid value where
    that has more than heavy_share of the valid ones, else null.
    """
    return _load_profile(spark, *_parts(spark, tables), heavy_share)


def _load_profile(spark: SparkSession, values: DataFrame, known: DataFrame | None, heavy_share: float) -> DataFrame:
    b = bucket(F.col("v")).alias("b")
    counts = values.groupBy(*GROUP, b).agg(F.count(F.lit(1)).alias("n"))
    if known is not None:
        counts = counts.unionByName(known.groupBy(*GROUP, b).agg(F.sum("n").alias("n"))).groupBy(*GROUP, "b").agg(F.sum("n").alias("n"))
    counts = Workspace(spark, "profile").cut(counts)  # a few thousand rows to a load at most; read several times below
    whole = Window.partitionBy(*GROUP)
    upto = whole.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    is_valid = F.col("b") >= _ZERO
    marked = counts.select(
        *GROUP, "b", "n",
        F.sum(F.when(is_valid, F.col("n")).otherwise(0)).over(whole).alias("n_valid"),
        F.sum(F.when(is_valid, F.col("n")).otherwise(0)).over(upto).alias("upto"),
        F.sum("n").over(whole).alias("n_rows"),
        F.sum(F.when(F.col("b") == _NULL, F.col("n")).otherwise(0)).over(whole).alias("n_null"),
    )
    # ranks of the middle valid values, counted from 1
    lo, hi = F.floor((F.col("n_valid") + 1) / 2), F.floor(F.col("n_valid") / 2) + 1
    holds = is_valid & (((F.col("upto") >= lo) & (F.col("upto") - F.col("n") < lo)) | ((F.col("upto") >= hi) & (F.col("upto") - F.col("n") < hi)))
    heavy = is_valid & (F.col("n") > F.col("n_valid") * heavy_share)
    groups = marked.groupBy(*GROUP).agg(F.first("n_rows").alias("n_rows"), F.first("n_null").alias("n_null"), F.first("n_valid").alias("n_valid"))
    wanted = marked.where(holds | heavy).select(*GROUP, "b", (F.col("upto") - F.col("n")).alias("before"), "n_valid")

    # pass 2: exact values in the wanted buckets; at most a handful of buckets to a load
    keyed = values.withColumn("b", b)
    if known is not None:
        keyed = keyed.withColumn("n", F.lit(1).cast("long")).unionByName(known.withColumn("b", b))
    else:
        keyed = keyed.withColumn("n", F.lit(1).cast("long"))
    per_group = wanted.groupBy(*GROUP).agg(F.collect_set("b").alias("bs"))
    inner = keyed.where(F.col("b") >= _ZERO).alias("x").join(per_group.alias("w"), _same("x", "w") & F.expr("array_contains(w.bs, x.b)"), "left_semi")
    exact = inner.groupBy(*GROUP, "b", "v").agg(F.sum("n").alias("n"))
    w = wanted.alias("w")
    ranked = exact.alias("x").join(w, _same("x", "w") & (F.col("x.b") == F.col("w.b"))).select(*[F.col(f"x.{g}") for g in GROUP], "x.v", "x.n", "w.n_valid", (F.col("w.before") + F.sum("x.n").over(Window.partitionBy(*[F.col(f"x.{g}") for g in GROUP], "x.b").orderBy("x.v"))).alias("upto"))
    at = lambda rank: F.max(F.when((F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank), F.col("v")))
    found = ranked.groupBy(*GROUP).agg(((at(lo) + at(hi)) / 2).alias("median"), F.max(F.when(F.col("n") > F.col("n_valid") * heavy_share, F.col("n"))).alias("top_count"))
    g = groups.alias("g")
    return g.join(found.alias("f"), _same("g", "f"), "left").select(*[F.col(f"g.{c}") for c in GROUP], "g.n_rows", "g.n_null", (F.col("g.n_rows") - F.col("g.n_null") - F.col("g.n_valid")).alias("n_invalid"), "g.n_valid", "f.median", "f.top_count")


def _same(a: str, b: str) -> Column:
    out = F.lit(True)
    for g in GROUP:
        out = out & F.col(f"{a}.{g}").eqNullSafe(F.col(f"{b}.{g}"))
    return out


def with_prior(profile: DataFrame) -> DataFrame:
    """The profile and prior, the median of the preceding load of the feed; null where feed or load_no is null."""
    before = Window.partitionBy("src_table", "column_name", "feed").orderBy("load_no")
    comparable = F.col("feed").isNotNull() & F.col("load_no").isNotNull() & F.lag("load_no").over(before).isNotNull()
    return profile.withColumn("prior", F.when(comparable, F.lag("median").over(before)))


def load_issues(profile: DataFrame, null_share: float = 0.2, invalid_share: float = 0.05, repeat_share: float = 0.2, shift_factor: float = 3.0) -> DataFrame:
    """src_table, column_name, feed, load_no, issue: nulls, invalid, repeats, shift (see load_profile)."""
    p = with_prior(profile)
    big, small = F.greatest("median", "prior"), F.least("median", "prior")
    both = F.col("median").isNotNull() & F.col("prior").isNotNull()
    issues = F.array(
        F.when(F.col("n_null") > F.col("n_rows") * null_share, "nulls"),
        F.when(F.col("n_invalid") > (F.col("n_rows") - F.col("n_null")) * invalid_share, "invalid"),
        F.when(F.col("top_count") > F.col("n_valid") * repeat_share, "repeats"),
        F.when(both & (big > 0) & (big >= small * shift_factor), "shift"),
    )
    return p.select(*GROUP, F.explode(F.array_compact(issues)).alias("issue"))


def full_profile(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """One row per table, column, feed and load with exact distinct values and range as well (footers first, then one
    shuffle by value), the median (see load_profile), prior_median of the preceding load and change, their quotient
    (null where there is no preceding median or it is 0)."""
    spark = next(iter(tables.values()))[0].sparkSession
    values, known = _parts(spark, tables)
    v = F.col("v")
    by_value = values.groupBy(*GROUP, "v").agg(F.count(F.lit(1)).alias("n"))
    if known is not None:
        by_value = by_value.unionByName(known.select(*GROUP, "v", "n")).groupBy(*GROUP, "v").agg(F.sum("n").alias("n"))
    good = v.isNotNull() & ~F.isnan(v) & (v >= 0) & (v < float("inf"))
    exact = by_value.groupBy(*GROUP).agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(v.isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.coalesce(F.sum(F.when(v.isNotNull() & ~good, F.col("n"))), F.lit(0)).alias("n_invalid"),
        F.count("v").alias("n_distinct"),
        F.min(F.when(good, v)).alias("min_valid"),
        F.max(F.when(good, v)).alias("max_valid"),
        F.coalesce(F.max(F.when(good, F.col("n"))), F.lit(0)).alias("top_count"),
    )
    medians = with_prior(_load_profile(spark, values, known, 0.2)).select(*GROUP, "median", F.col("prior").alias("prior_median"), F.try_divide("median", "prior").alias("change"))
    return exact.alias("e").join(medians.alias("m"), _same("e", "m"), "left").select("e.*", "m.median", "m.prior_median", "m.change")
