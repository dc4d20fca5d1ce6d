"""Queries p7 to p9 over a directory of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillstone.llm import abuse, mixing, packing
from rillstone.sources.tables import table
from rillstone.storage import Workspace

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(f=None, sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add(f) if f else add


@query
def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents", "doc_id", "text"))


@query
def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.report(packing.pack(table(spark, d, "documents", "doc_id", "text")))


@query(sql="select count(*) filter (trim(text) <> '') n_docs, 0::bigint n_over_capacity, 0::bigint n_gaps, 0::bigint n_cut_needlessly, 0::bigint n_misstated from documents where text is not null")
def p7_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What every packing must keep: each document with text is placed, its pieces follow one another from token 0, only
    documents longer than a container are cut, no container holds more than it can, and its stated fill is right."""
    docs = table(spark, d, "documents", "doc_id", "text")
    packed = Workspace(spark, "packed").cut(packing.pack(docs))
    per = packed.groupBy("container").agg(F.sum("n_tokens").alias("t"), F.max("container_tokens").alias("said"))
    doc = packed.groupBy("doc_id").agg(F.sum("n_tokens").alias("t"), F.max(F.col("start_token") + F.col("n_tokens")).alias("end"), F.min("start_token").alias("start"), F.count(F.lit(1)).alias("pieces"))
    cap = packing.CAPACITY
    a = per.agg(F.count_if(F.col("t") > cap).alias("n_over_capacity"), F.count_if(F.col("t") != F.col("said")).alias("n_misstated"))
    with_text = docs.where(F.trim("text") != "").select("doc_id").join(doc, "doc_id", "left")
    b = with_text.agg(F.count("t").alias("n_docs"), F.count_if(F.coalesce((F.col("start") != 0) | (F.col("end") != F.col("t")), F.lit(True))).alias("n_gaps"), F.count_if(F.col("pieces") > F.ceil(F.col("t") / cap)).alias("n_cut_needlessly"))
    return b.join(a)  # two rows of one


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return mixing.mix(table(spark, d, "documents", "doc_id", "source", "text"), table(spark, d, "mix_targets"))


@query
def p8_copies(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[0]


@query
def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[1]


@query(
    sql="""with t as (select mix_name, source, max(greatest(target_share, 0)) s, max(coalesce(max_repeats, 1)) r from mix_targets where mix_name is not null and source is not null group by all),
h as (select distinct source from documents where trim(text) <> '')
select mix_name, count(*) filter (s > 0 and r >= 1 and source in (from h)) n_sources, true as shares_met, 0::bigint n_over_cap, true as all_converged from t group by 1"""
)
def p8_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What every mix must keep: no document above its cap, and each source that has documents within 0.001 of its share
    among those that have, or one short document where that is more."""
    copies, shares = _mix(spark, d)
    cap = table(spark, d, "mix_targets").groupBy("mix_name", "source").agg(F.max(F.coalesce("max_repeats", F.lit(1))).alias("r"))
    over = copies.join(cap, ["mix_name", "source"]).groupBy("mix_name").agg(F.count_if(F.col("copies") > F.col("r")).alias("n_over_cap"))
    live = shares.where("tokens_at_hand > 0 and target_share > 0").join(cap.where("r >= 1"), ["mix_name", "source"])
    w = Window.partitionBy("mix_name")
    live = live.withColumn("due", F.col("target_share") / F.sum("target_share").over(w)).withColumn("all", F.sum("n_tokens").over(w))
    met = live.groupBy("mix_name").agg(F.count(F.lit(1)).alias("n_sources"), F.bool_and(F.abs(F.col("actual_share") - F.col("due")) <= F.greatest(F.lit(1e-3), 40 / F.col("all"))).alias("shares_met"), F.bool_and("converged").alias("all_converged"))
    names = shares.select("mix_name").distinct()
    return names.join(met, "mix_name", "left").join(over, "mix_name", "left").select("mix_name", F.coalesce("n_sources", F.lit(0)).alias("n_sources"), F.coalesce("shares_met", F.lit(True)).alias("shares_met"), F.coalesce("n_over_cap", F.lit(0)).alias("n_over_cap"), F.coalesce("all_converged", F.lit(True)).alias("all_converged"))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "source", "text")
    model = abuse.fit(abuse.labelled_texts(docs, table(spark, d, "content_labels", "doc_id", "verdict")))
    return abuse.score(docs, model, ["doc_id", "source"])


@query
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return abuse.kinds(_scored(spark, d))


@query
def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d)


@query
def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    return abuse.rates(_scored(spark, d))


@query(sql="select source, count(*) n_docs, count(distinct doc_id) n_scored, 0::bigint n_outside, 0::bigint n_empty_flagged from documents group by 1")
def p9_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What every scoring must keep: each document once, scores from 0 to 1, none above the cut for empty texts."""
    scored = _scored(spark, d).join(table(spark, d, "documents", "doc_id", F.coalesce(F.length(F.trim("text")), F.lit(0)).alias("size")), "doc_id")
    odd = lambda k: ~F.coalesce(F.col(k).between(0, 1), F.lit(False))
    flagged = F.greatest(*abuse.KINDS[1:]) > abuse.THRESHOLD
    return scored.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.countDistinct("doc_id").alias("n_scored"), F.count_if(odd("abuse") | odd("hate") | odd("sexual")).alias("n_outside"), F.count_if((F.col("size") == 0) & flagged).alias("n_empty_flagged"))
