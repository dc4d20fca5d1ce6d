import random
from datetime import datetime, timedelta

import pytest

from rillstone.operators import references


@pytest.mark.parametrize("hot", [references.HOT, 15])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(references, "HOT", hot)
    rng = random.Random(3)
    t0 = datetime(2023, 1, 1)
    when = lambda: t0 + timedelta(hours=rng.randrange(4000)) if rng.random() > 0.05 else None
    loads = [(rng.choice([None, *range(1000, 1400, 1), 5, -7]), when()) for _ in range(500)]
    gone = [(rng.randrange(1000, 1500), when()) for _ in range(60)]
    refs = [("a", rng.randrange(50), rng.choice([None, 0, -7, 1023, 1024, 10**12, *range(990, 1510)]), when()) for _ in range(3000)]
    refs += [("b", 1, 1023, t0)] * 2000  # one key with most rows
    first = lambda rows: {k: min((w for x, w in rows if x == k and w), default=None) for k, _ in rows if k is not None}
    l, w = first(loads), first(gone)
    want = set()
    for f, rec, k, at in refs:
        if k in (None, 0):
            continue
        kind = "deleted" if w.get(k) and at and w[k] <= at else "missing" if k not in l and k not in w else "late" if l.get(k) and at and l[k] > at else None
        if kind:
            want.add((f, at.strftime("%Y-%m") if at else None, rec, k, kind))
    runs = references.parent_runs(spark.createDataFrame(loads, "key long, at timestamp"), spark.createDataFrame(gone, "key long, at timestamp"))
    found = references.orphans(spark.createDataFrame(refs, "ref_field string, record_id long, ref_id long, at timestamp"), runs)
    got = [(r.ref_field, r.loaded_month, r.record_id, r.ref_id, r.kind) for r in found.collect()]
    assert set(got) == want and len(got) == len(want)


def test_empty(spark):
    none = spark.createDataFrame([], "key long, at timestamp")
    refs = spark.createDataFrame([("a", 1, 5, None)], "ref_field string, record_id long, ref_id long, at timestamp")
    assert [r.kind for r in references.orphans(refs, references.parent_runs(none, none)).collect()] == ["missing"]
    assert references.orphans(refs.limit(0), references.parent_runs(none, none)).count() == 0
