import math
import statistics

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from rillstone.operators import profile


def write(tmp_path, rows, name="t", **kw):
    t = pa.table({"feed": pa.array([r[0] for r in rows], pa.int32()), "load_no": pa.array([r[1] for r in rows], pa.int32()), "v": pa.array([r[2] for r in rows], pa.float32()), "n": ["x"] * len(rows), "b": [1] * len(rows)})
    (tmp_path / name).mkdir(exist_ok=True)
    pq.write_table(t, tmp_path / name / f"{kw.pop('file', 'a')}.parquet", **kw)
    return str(tmp_path / name)


def issues(spark, path):
    df = spark.read.parquet(path)
    return {(r.feed, r.load_no, r.issue) for r in profile.load_issues(profile.load_profile(spark, {"t": (df, ["v"])})).collect()}


def test_issues_and_exact_median(spark, tmp_path):
    rows = [(1, 1, float(i)) for i in range(1, 41)]
    rows += [(1, 3, 3.0 * i) for i in range(1, 41)]  # three times the load before, though number 2 is missing
    rows += [(1, 4, None)] * 9 + [(1, 4, 70.0 + i) for i in range(31)]
    rows += [(2, 1, 7.0)] * 30 + [(2, 1, float(i)) for i in range(60)]
    rows += [(2, 2, math.nan), (2, 2, math.inf), (2, 2, -1.0)] + [(2, 2, 20.0 + i) for i in range(40)]
    rows += [(3, 1, None)] * 3 + [(3, 2, 5.0), (3, 3, 0.0), (3, 3, -0.0)]
    rows += [(None, 1, 1.0), (None, 2, 100.0)]
    found = issues(spark, write(tmp_path, rows))
    assert (1, 3, "shift") in found and (1, 4, "nulls") in found and (2, 1, "repeats") in found and (2, 2, "invalid") in found
    assert (3, 1, "nulls") in found and (3, 2, "shift") not in found and (3, 3, "shift") in found
    assert not any(f is None and i == "shift" for f, _, i in found)
    p = {(r.feed, r.load_no): r for r in profile.load_profile(spark, {"t": (spark.read.parquet(str(tmp_path / "t")), ["v"])}).collect()}
    for key in ((1, 1), (1, 3), (2, 1)):
        vals = [v for f, n, v in rows if (f, n) == key]
        assert p[key].median == statistics.median(vals)
    assert p[2, 2].n_invalid == 3 and p[2, 2].n_null == 0


def test_settled_files_need_no_scan(spark, tmp_path):
    path = write(tmp_path, [(1, 1, None)] * 50, file="nulls")
    write(tmp_path, [(1, 2, 4.0)] * 50, file="same")
    write(tmp_path, [(1, 3, 4.0), (1, 3, math.nan)] * 25, file="hidden")
    chunks = {r.load_no: r for r in profile.chunk_statistics(spark.read.parquet(path), ["v"]).collect()}
    assert chunks[1].n_null == 50 and chunks[2].n_dictionary == 1 and not chunks[2].has_nan and chunks[3].has_nan
    df = spark.read.parquet(path)
    values, known = profile._parts(spark, {"t": (df, ["v"])})
    assert {r.load_no for r in values.select("load_no").distinct().collect()} == {3}
    assert {(r.load_no, r.n) for r in known.collect()} == {(1, 50), (2, 50)}
    assert issues(spark, path) == {(1, 1, "nulls"), (1, 2, "repeats"), (1, 3, "invalid"), (1, 3, "repeats")}


def test_only_unsettled_row_groups_are_read(spark, tmp_path):
    rows = [(1, 1, None)] * 40 + [(1, 2, 4.0)] * 40 + [(1, 3, float(i)) for i in range(40)] + [(1, k % 2, 5.0) for k in range(40)]
    path = write(tmp_path, rows, row_group_size=40)
    df = spark.read.parquet(path)
    plan = {r.row_group: (r.source, r.n_bytes) for r in profile.chunk_plan(df, ["v"]).collect()}
    assert [plan[g][0] for g in range(4)] == ["footer", "footer", "chunk", "chunk"] and all(b > 0 for _, b in plan.values())
    values, known = profile._parts(spark, {"t": (df, ["v"])})
    assert sorted((r.load_no, r.v) for r in values.collect()) == sorted((b, v) for _, b, v in rows[80:])
    assert {(r.load_no, r.n) for r in known.collect()} == {(1, 40), (2, 40)}
    p = {r.load_no: r for r in profile.load_profile(spark, {"t": (df, ["v"])}).collect()}
    assert (p[1].n_rows, p[1].n_null, p[1].median) == (60, 40, 5.0) and p[2].median == 4.0 and p[3].median == 19.5 and p[0].n_rows == 20


def test_columns_from_footers_and_dictionaries(spark, tmp_path):
    rows = [(1, 1, float(i % 7)) for i in range(100)] + [(1, 2, math.nan), (1, 2, -0.0), (1, 2, None)]
    path = write(tmp_path, rows, row_group_size=30)
    write(tmp_path, [(1, 1, 90.0 + i) for i in range(50)] + [(1, 1, None)], file="plain", use_dictionary=False)
    write(tmp_path, [(1, 1, None)] * 5, file="none")
    got = profile.column_profile({"t": (spark.read.parquet(path), ["v"])}).first()
    assert (got.n_rows, got.n_null, got.n_distinct, got.min_value, got.max_value) == (159, 7, 58, 0.0, 139.0)
    empty = write(tmp_path, [], name="empty")
    assert profile.column_profile({"t": (spark.read.parquet(empty), ["v"])}).count() == 0


def test_full_profile_has_median_and_change_and_reads_footers(spark, tmp_path):
    path = write(tmp_path, [(1, 1, None)] * 50 + [(1, 2, 0.0)] * 3, file="start")
    write(tmp_path, [(1, 3, 4.0)] * 50, file="same")
    write(tmp_path, [(1, 5, 6.0), (1, 5, 10.0), (1, 5, math.nan), (None, 7, 1.0), (1, 6, -1.0)], file="mixed")
    df = spark.read.parquet(path)
    p = {(r.feed, r.load_no): r for r in profile.full_profile({"t": (df, ["v"])}).collect()}
    assert {k: (r.median, r.prior_median, r.change) for k, r in p.items()} == {(1, 1): (None, None, None), (1, 2): (0.0, None, None), (1, 3): (4.0, 0.0, None), (1, 5): (8.0, 4.0, 2.0), (1, 6): (None, 8.0, None), (None, 7): (1.0, None, None)}
    assert (p[1, 3].n_rows, p[1, 3].n_distinct, p[1, 3].top_count) == (50, 1, 50) and (p[1, 5].n_rows, p[1, 5].n_invalid, p[1, 5].n_distinct, p[1, 5].max_valid) == (3, 1, 3, 10.0)
    scanned = {f.rpartition("/")[2] for f in profile.full_profile({"t": (df, ["v"])}).inputFiles()}
    assert {"start.parquet", "mixed.parquet"} <= scanned and "same.parquet" not in scanned


def test_dictionary_gives_distinct_values(spark, tmp_path):
    path = write(tmp_path, [(1, 1, float(i % 7)) for i in range(100)])
    assert profile.chunk_statistics(spark.read.parquet(path), ["v"]).first().n_dictionary == 7
    plain = write(tmp_path, [(1, 1, 1.0)], name="p", use_dictionary=False)
    assert profile.chunk_statistics(spark.read.parquet(plain), ["v"]).first().n_dictionary is None


def test_unread_footers_lose_no_rows(spark, tmp_path):
    path = write(tmp_path, [(1, 1, float(i % 7)) for i in range(100)] + [(1, 2, math.nan), (1, 2, -0.0), (1, 2, None)])
    write(tmp_path, [(1, 3, 90.0)] * 50, file="same")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.default.link./unread", f"file://{path}")
    there, unread = spark.read.parquet(path), spark.read.parquet("viewfs:///unread")  # a store that Spark reads and pyarrow does not
    (told,) = profile.column_profile({"t": (unread, ["v"])}).collect()
    assert tuple(told) == ("t", "v", 153, 1, 9, 0.0, 90.0) == tuple(profile.column_profile({"t": (there, ["v"])}).first())
    assert sorted(map(str, profile.full_profile({"t": (unread, ["v"])}).collect())) == sorted(map(str, profile.full_profile({"t": (there, ["v"])}).collect()))
    assert {(r.path, r.row_group, r.n_rows, r.source) for r in profile.chunk_plan(unread, ["v"]).collect()} == {(f, None, None, "file") for f in unread.inputFiles()}
    assert all(profile.chunk_plan(df, ["v"]).where("error is not null").count() == n for df, n in ((unread, 2), (there, 0)))


def test_one_unread_footer_among_others(spark, tmp_path):
    (tmp_path / "s").mkdir()
    for file, values in (("a", ["1", "2", None]), ("b", ["1.5D", "7"])):  # Spark reads 1.5D as a number, Python does not
        pq.write_table(pa.table({"feed": [1] * len(values), "load_no": [1] * len(values), "v": values}), tmp_path / "s" / f"{file}.parquet")
    df = spark.read.parquet(str(tmp_path / "s"))
    assert [r.error is None for r in profile.chunk_statistics(df, ["v"]).orderBy("path").collect()] == [True, False]
    assert tuple(profile.column_profile({"t": (df, ["v"])}).first()) == ("t", "v", 5, 1, 4, 1.0, 7.0)


def test_broken_files_fail(spark, tmp_path):
    path = write(tmp_path, [(1, 1, 4.0)] * 50)
    (tmp_path / "t" / "b.parquet").write_bytes(b"PAR1 no table PAR1")
    df = spark.read.schema("feed int, load_no int, v float").parquet(path)
    assert [r.n_rows for r in profile.chunk_plan(df, ["v"]).orderBy("path").collect()] == [50, None]
    for run in (lambda: profile.column_profile({"t": (df, ["v"])}), lambda: profile.load_profile(spark, {"t": (df, ["v"])}), lambda: profile.full_profile({"t": (df, ["v"])})):
        with pytest.raises(Exception, match="FAILED_READ_FILE"):
            run().collect()


def test_empty(spark, tmp_path):
    assert issues(spark, write(tmp_path, [])) == set()
