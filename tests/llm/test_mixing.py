import random

from rillstone.llm import mixing


def test_shares_and_caps(spark):
    rng = random.Random(2)
    docs = [(i, rng.choice("aaaaaabbc"), "speech " * rng.randrange(1, 60)) for i in range(600)] + [(1000, None, "x"), (1001, "a", None), (1002, "a", ""), (None, "b", "word " * 9), (3, "a", "again")]
    df = spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id long, source string, text string, want double")
    targets = spark.createDataFrame([("m", "a", 0.2, 3), ("m", "b", 0.5, 4), ("m", "c", 0.3, 3), ("n", "a", 0.5, 1), ("n", "z", 0.5, 9), ("o", "c", 1.0, None), ("o", "a", None, 2), (None, "a", 1.0, 1), ("p", "b", 0.6, 2), ("p", "b", 0.6, 2), ("p", "c", 0.4, 0)], "mix_name string, source string, target_share double, max_repeats int")
    copies, shares = mixing.mix(df, targets)
    s = {(r.mix_name, r.source): r for r in shares.collect()}
    caps = {("m", "a"): 3, ("m", "b"): 4, ("m", "c"): 3, ("n", "a"): 1, ("o", "c"): 1, ("p", "b"): 2}
    for src, share in (("a", 0.2), ("b", 0.5), ("c", 0.3)):
        assert abs(s["m", src].actual_share - share) < 0.002
    assert s["n", "a"].actual_share == 1.0 and s["n", "z"].n_tokens == 0 and s["o", "a"].n_tokens == 0 and s["p", "c"].n_tokens == 0
    for r in copies.collect():
        assert 1 <= r.copies <= caps[r.mix_name, r.source]
    assert len(s) == 9 and not any(m is None for m, _ in s)


def test_newton_meets_the_constraint(spark):
    sizes = spark.createDataFrame([("a", 1 + (i * i) % 97) for i in range(400)] + [("b", 1 + i % 7) for i in range(50)], "source string, n_tokens long")
    t = spark.createDataFrame([("m", "a", 0.9, 2), ("m", "b", 0.1, 20)], "mix_name string, source string, target_share double, max_repeats int")
    rows = {r["source"]: r for r in mixing.solve(sizes, t)}
    import math

    for src in "ab":
        r = rows[src]
        q = min(1.0, r["r"] / 2)
        got = sum(x.n_tokens * r["r"] / (1 + (r["r"] - q) / q * math.exp(-r["multiplier"] * x.n_tokens / r["mean"])) for x in sizes.where(f"source = '{src}'").collect())
        assert abs(got - r["want"]) <= 1e-5 * r["want"]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    t = spark.createDataFrame([("m", "a", 1.0, 2)], "mix_name string, source string, target_share double, max_repeats int")
    copies, shares = mixing.mix(df, t)
    assert copies.count() == 0 and [r.actual_share for r in shares.collect()] == [0.0]
