"""Mixing sources to target weights.

Method: entropy balancing. A document's rate stays as close as possible, in relative entropy with a cap, to once per
document, under the constraint that each source of a mix gives its share of the tokens. The dual is convex with one
multiplier per mix and source; its solution tilts rates exponentially by length, bounded by the cap:
rate = R / (1 + (R - q) / q * exp(-multiplier * tokens / mean tokens)). Newton steps (kept within a shrinking bracket)
need two sums per mix and source; each step is one aggregate over the lengths' histogram, which stays distributed.

The total of a mix is as large as its documents, or as the most limited source allows at its cap. Rates are rounded to
copies: the whole part always, and one more for documents in order of (hash / fraction) until the source's tokens are
met to within one document; the place to stop is found from a histogram, so no source is sorted in one task. A few
single copies then close what gap is left.

Defined results: null and empty texts take no part; documents without source neither; a source without documents
contributes 0 and the others keep their proportions; null or negative shares count as 0, null repeats as 1, repeats
below 1 exclude the source; repeated target rows count once (largest share). Repeated documents are documents.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.tokens import VOCABULARY, with_sizes
from rillstone.storage import Workspace

STEPS, TOLERANCE = 60, 1e-7
#: Rows of mixes and sources that are sent to every task; with more, Spark decides by their size.
SENT = 100_000
#: Single copies that may be added or taken per mix and source to close the last gap.
CLOSING = 4
_BUCKETS = 1 << 16


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SENT else df


def _targets(targets: DataFrame) -> DataFrame:
    share = F.greatest(F.coalesce(F.col("target_share").cast("double"), F.lit(0.0)), F.lit(0.0))
    t = targets.where("mix_name is not null and source is not null").select("mix_name", "source", share.alias("share"), F.coalesce(F.col("max_repeats").cast("int"), F.lit(1)).alias("r"))
    return t.groupBy("mix_name", "source").agg(F.max("share").alias("share"), F.max("r").alias("r"))


def _rate(multiplier, mean, r, tokens):
    q = F.least(F.lit(1.0), r / 2)
    return r / (1 + (r - q) / q * F.exp(F.least(F.lit(700.0), -multiplier * tokens / mean)))


def solve(sizes: DataFrame, targets: DataFrame) -> list[dict]:
    """Per mix and source: share, r, have (tokens at hand), want (tokens), mean, multiplier (None where nothing is taken, inf where all at the cap), converged.

    sizes: source, n_tokens. The targets' rows, which are configuration, come to the driver; documents never do.
    """
    space = Workspace(sizes.sparkSession, "mixing")
    histogram = space.cut(sizes.where("source is not null").groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("n")))
    have = histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("n_tokens")).alias("have"), F.sum("n").alias("docs"))
    rows = [r.asDict() for r in _targets(targets).join(have, "source", "left").collect()]
    by_mix: dict = {}
    for r in rows:
        r["have"], r["docs"] = r["have"] or 0, r["docs"] or 0
        by_mix.setdefault(r["mix_name"], []).append(r)
    for mine in by_mix.values():
        live = [r for r in mine if r["have"] and r["share"] > 0 and r["r"] >= 1]
        part = sum(r["share"] for r in live)
        total = min([sum(r["have"] for r in live) / part if part else 0, *(r["r"] * r["have"] / r["share"] for r in live)])
        for r in mine:
            r["want"] = r["share"] * total if r in live else 0.0
            r["mean"] = r["have"] / r["docs"] if r["docs"] else 1.0
            r["multiplier"] = None if r not in live else math.inf if r["want"] >= r["r"] * r["have"] * (1 - 1e-12) else 0.0
    todo = [r for r in rows if r["multiplier"] == 0.0]
    for r in rows:
        r["converged"] = r not in todo
    for r in todo:
        r["lo"], r["hi"] = -math.inf, math.inf
    spark = sizes.sparkSession
    for _ in range(STEPS):
        if not todo:
            break
        now = spark.createDataFrame([(r["mix_name"], r["source"], float(r["r"]), r["mean"], r["multiplier"]) for r in todo], "mix_name string, source string, r double, mean double, m double")
        j = histogram.join(_small(now, len(todo)), "source")  # one row per mix and source
        w = _rate(F.col("m"), F.col("mean"), F.col("r"), F.col("n_tokens"))
        t = F.col("n") * F.col("n_tokens")
        sums = {(x.mix_name, x.source): x for x in j.groupBy("mix_name", "source").agg(F.sum(t * w).alias("f"), F.sum(t * F.col("n_tokens") / F.col("mean") * w * (1 - w / F.col("r"))).alias("g")).collect()}
        left = []
        for r in todo:
            x = sums[r["mix_name"], r["source"]]
            gap = x.f - r["want"]
            if abs(gap) <= TOLERANCE * r["want"]:
                r["converged"] = True
                continue
            if gap > 0:
                r["hi"] = r["multiplier"]
            else:
                r["lo"] = r["multiplier"]
            step = r["multiplier"] - gap / x.g if x.g > 0 else math.nan
            if not (r["lo"] < step < r["hi"]) or math.isnan(step):
                lo = r["lo"] if r["lo"] > -math.inf else min(-1.0, 2 * r["hi"] - 1)
                hi = r["hi"] if r["hi"] < math.inf else max(1.0, 2 * r["lo"] + 1)
                step = (lo + hi) / 2
            r["multiplier"] = step
            left.append(r)
        todo = left
    if todo:
        warnings.warn(f"{len(todo)} multipliers have not converged in {STEPS} steps; shares of their mixes may be off", stacklevel=2)
    return rows


def _close(rounded: DataFrame) -> list[tuple]:
    """(mix_name, item, step): single copies added or taken so that each source meets its tokens more closely.

    In each round one document per mix and source, the one whose size is nearest to the gap: a few rows of the targets'
    number, however many documents there are.
    """
    by = ["mix_name", "source"]
    gaps = {(r.mix_name, r.source): r.gap for r in rounded.groupBy(*by).agg((F.first("want") - F.sum(F.col("copies") * F.col("n_tokens"))).alias("gap")).collect()}
    moves: dict = {}
    for _ in range(CLOSING):
        open_ = [(m, s, float(g)) for (m, s), g in gaps.items() if abs(g) >= 1]
        if not open_:
            break
        now = rounded.sparkSession.createDataFrame(open_, "mix_name string, source string, gap double")
        used = [item for _, item in moves] or [-1]
        j = rounded.join(_small(now, len(open_)), by).where(~F.col("item").isin(used))
        left = F.abs(F.abs("gap") - F.col("n_tokens"))
        fits = F.when(F.col("gap") > 0, F.col("copies") < F.col("r")).otherwise(F.col("copies") > 0)
        best = j.where(fits & (left < F.abs("gap"))).groupBy(*by).agg(F.min(F.struct(left.alias("left"), "item", "n_tokens")).alias("x")).collect()
        if not best:
            break
        for r in best:
            step = 1 if gaps[r.mix_name, r.source] > 0 else -1
            moves[r.mix_name, r.x["item"]] = step
            gaps[r.mix_name, r.source] -= step * r.x["n_tokens"]
    return [(m, item, step) for (m, item), step in moves.items()]


def mix(docs: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(copies, shares). copies: mix_name, source, key, n_tokens, copies (1 or more). shares: mix_name, source,
    target_share, actual_share, n_tokens (with copies), n_docs, n_copies, most_copies, tokens_at_hand, converged (the
    multiplier was found, or none is needed)."""
    spark = docs.sparkSession
    space = Workspace(spark, "mix")
    sized = space.cut(with_sizes(docs.select(key, "source", text), [key, "source"], text, vocabulary).where("n_tokens > 0"))
    rows = solve(sized, targets)
    plan = spark.createDataFrame([(r["mix_name"], r["source"], r["share"], float(r["r"]), r["mean"], r["multiplier"], float(r["want"]), int(r["have"]), r["converged"]) for r in rows], "mix_name string, source string, share double, r double, mean double, m double, want double, have long, converged boolean")
    taken = plan.where("m is not null and want > 0")
    j = sized.join(_small(taken.select("mix_name", "source", "r", "mean", "m", "want"), len(rows)), "source")
    w = F.when(F.col("m") == math.inf, F.col("r")).otherwise(_rate(F.col("m"), F.col("mean"), F.col("r"), F.col("n_tokens")))
    j = j.withColumn("w", w).withColumn("base", F.floor("w").cast("int")).withColumn("frac", F.col("w") - F.col("base"))
    u = (F.pmod(F.xxhash64("item", "mix_name"), F.lit(1 << 40)) + 1) / float(1 << 40)
    prior = F.when(F.col("frac") > 0, u / F.col("frac"))
    j = j.withColumn("p", prior / (1 + prior)).withColumn("b", F.floor(F.col("p") * _BUCKETS).cast("int"))
    by = ["mix_name", "source"]
    # where to stop: tokens by bucket of the priority
    buckets = space.cut(j.groupBy(*by, "b").agg(F.sum(F.col("base") * F.col("n_tokens")).alias("sure"), F.sum(F.when(F.col("b").isNotNull(), F.col("n_tokens"))).alias("t"), F.first("want").alias("want")))
    upto = Window.partitionBy(*by).orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    room = F.col("want") - F.sum("sure").over(Window.partitionBy(*by))
    run = buckets.withColumn("room", room).withColumn("sum", F.sum(F.coalesce("t", F.lit(0))).over(upto)).where("b is not null")
    edge = run.where("sum > room").groupBy(*by).agg(F.min("b").alias("edge"), F.min_by(F.col("room") - (F.col("sum") - F.col("t")), "b").alias("room"))
    j = j.join(_small(edge, len(rows)), by, "left")  # one row per mix and source
    at_edge = j.where("b = edge").withColumn("sum", F.sum("n_tokens").over(Window.partitionBy(*by).orderBy("p", "item"))).where("sum - n_tokens / 2 <= room").select("mix_name", "item", F.lit(1).alias("one"))
    more = F.when(F.col("b").isNull(), 0).when(F.col("edge").isNull() | (F.col("b") < F.col("edge")), 1).otherwise(F.coalesce("one", F.lit(0)))
    rounded = space.cut(j.join(at_edge, ["mix_name", "item"], "left").select("mix_name", "source", "item", key, "n_tokens", "r", "want", (F.col("base") + more).alias("copies")))
    moves = _close(rounded)
    m = spark.createDataFrame(moves, "mix_name string, item long, step int")
    copies = rounded.join(_small(m, len(moves)), ["mix_name", "item"], "left").withColumn("copies", F.col("copies") + F.coalesce("step", F.lit(0))).where("copies > 0")
    copies = space.cut(copies.select("mix_name", "source", key, "n_tokens", "copies"))
    got = copies.groupBy(*by).agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("n_tokens"), F.count(F.lit(1)).alias("n_docs"), F.sum("copies").alias("n_copies"), F.max("copies").alias("most_copies"))
    shares = plan.select(*by, F.col("share").alias("target_share"), F.col("have").alias("tokens_at_hand"), "converged").join(got, by, "left")
    tokens = F.coalesce("n_tokens", F.lit(0))
    total = F.sum(tokens).over(Window.partitionBy("mix_name"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    shares = shares.select(*by, "target_share", F.when(total > 0, tokens / total).otherwise(0.0).alias("actual_share"), zero("n_tokens"), zero("n_docs"), zero("n_copies"), zero("most_copies"), "tokens_at_hand", "converged")
    return copies, shares
