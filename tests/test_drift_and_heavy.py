from rillstone.operators import heavy_keys
from rillstone.operators import schema_drift as S


def rows():
    f1 = ['{"id":1,"a":1.5,"l":[1,2],"x":"u","gone":1}', '{"id":2,"a":2.5,"l":[3],"x":null,"gone":2}', '{"id":2,"a":2.5,"l":[3],"x":null,"gone":2}', '{"id":3,"a":', "[1]", None, ""]
    f2 = ['{"id":1,"A":"1.50","m":"1,2","x":null}', '{"id":2,"A":"2.5","m":"3","x":null}', '{"id":4,"A":"n/a","m":"","x":null,"new":true}']
    f3 = ['{"id":1,"A":1.5,"m":"1,2","x":3}', '{"id":2,"A":2.5,"m":"3","x":4}']
    out = []
    for no, f in enumerate((f1, f2, f3)):
        out += [(7, "graph", 70 + no, k, p, "clash") for k, p in enumerate(f)]
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "stream_no long, artifact string, file_no long, line_no int, payload string, field string")


def test_changes(spark):
    df = frame(spark, rows())
    flat, files = S.fields(df), S.file_versions(df)
    got = {(r.file, r.field_name, r.change_kind) for r in S.migrations(flat, files).collect()}
    assert got == {(71, "A", "renamed"), (71, "A", "retyped"), (71, "m", "renamed"), (71, "m", "retyped"), (71, "gone", "removed"), (71, "new", "added"), (72, "A", "retyped"), (72, "new", "removed"), (72, "x", "retyped")}


def test_one_table(spark):
    df = frame(spark, rows())
    flat = S.fields(df)
    names = S.canonical_names(S.migrations(flat, S.file_versions(df)), flat)
    assert names["a"] == names["A"] and names["l"] == names["m"]
    t = S.one_table(df, names, {"id": "bigint", names["a"]: "double", names["l"]: "array<bigint>"}).collect()
    assert len(t) == 8 and {(r.id, r[names["a"]], tuple(r[names["l"]])) for r in t} == {(1, 1.5, (1, 2)), (2, 2.5, (3,)), (4, None, ())}
    assert sum(r.n_lost for r in t) == 1


def test_one_table_keeps_every_value(spark):
    """A cast's field under another canonical name, fields without a cast, a name that comes back as another field."""
    files = {
        (1, 10): ['{"id":1,"remark":"u","n":1}', '{"id":2,"remark":"w","n":2}'],
        (1, 11): ['{"id":1,"note":"u","n":1}', '{"id":2,"note":"w","n":2,"odd name.x":{"k":1}}'],
        (1, 12): ['{"id":1,"note":"u","n":1,"remark":"new"}', '{"id":2,"note":"w","n":"?"}'],
        (2, 20): ['{"id":5,"note":"z","file":"f","N":7}'],
        (2, 21): ['{"id":5,"note":"z","file":null}'],
    }
    df = frame(spark, [(s, "graph", f, k, p, "clash") for (s, f), ps in files.items() for k, p in enumerate(ps)])
    flat = S.fields(df)
    steps = S.migrations(flat, S.file_versions(df))
    casts = {"id": "bigint", "remark": "string", "n": "bigint"}
    names = S.canonical_names(steps, flat, casts)
    assert names["remark"] == names["note"] == "note"
    t = S.one_table(df, names, casts, placed=S.placements(steps, flat, names))
    got = {(r.file, r.line): r.asDict() for r in t.collect()}
    assert {k: r["remark"] for k, r in got.items()} == {(10, 0): "u", (10, 1): "w", (11, 0): "u", (11, 1): "w", (12, 0): "u", (12, 1): "w", (20, 0): "z", (21, 0): "z"}
    assert got[12, 0]["also_remark"] == "new" and got[20, 0]["file_"] == "f" and got[20, 0]["N_"] == "7" and got[11, 1]["odd name.x"] == '{"k":1}'
    assert {k: r["n_lost"] for k, r in got.items() if r["n_lost"]} == {(12, 1): 1}
    # without placements the second name of a field has no place, and counts
    by_name = {(r.file, r.line): r for r in S.one_table(df, names, casts).collect()}
    assert by_name[12, 0].remark == "u" and by_name[12, 0].n_lost == 1 and by_name[12, 1].n_lost == 1


def test_casts_stay_apart(spark):
    df = frame(spark, [(1, "graph", 10, 0, '{"id":1,"a":7}', "c"), (1, "graph", 11, 0, '{"id":1,"b":7}', "c")])
    flat = S.fields(df)
    steps = S.migrations(flat, S.file_versions(df))
    assert S.canonical_names(steps, flat)["a"] == S.canonical_names(steps, flat)["b"]
    names = S.canonical_names(steps, flat, ("a", "b"))
    assert names == {"id": "id", "a": "a", "b": "b"}
    r = S.one_table(df, names, {"a": "bigint", "b": "bigint"}, placed=S.placements(steps, flat, names)).orderBy("file").collect()
    assert [(x.a, x.b, x.n_lost) for x in r] == [(7, None, 0), (7, None, 0)]


def test_empty_drift(spark):
    df = frame(spark, rows()).limit(0)
    assert S.migrations(S.fields(df), S.file_versions(df)).count() == 0


def test_heavy(spark):
    df = spark.createDataFrame([(1, [5, 5, None, 0])] * 50 + [(2, [6])] * 49 + [(3, None), (None, [7])], "id long, u array<long>")
    assert {r.key for r in heavy_keys.heavy(df, "id", 0.02).collect()} == {1, 2}
    s = {r.key: r for r in heavy_keys.key_summary(df, "id", "u").collect()}
    assert (s[1].n_rows, s[1].n_entries, s[1].n_distinct, s[1].min_member) == (50, 100, 1, 5)
    assert s[3].n_entries == 0 and s[3].min_member is None and s[None].n_distinct == 1
    assert heavy_keys.heavy(df.limit(0), "id", 0.02).count() == 0 and heavy_keys.key_summary(df.limit(0), "id", "u").count() == 0
