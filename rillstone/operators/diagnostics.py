"""Building, capping, counting and printing diagnostics."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillstone.sources.schemas import DIAGNOSTIC

#: Findings of one check that are listed one by one; the rest is one summary row.
CAP, NULL_CAP = 100, 10


Place = Column | str | None


def place(row: Place) -> Column:
    return (F.lit(None) if row is None else F.col(row) if isinstance(row, str) else row).cast("long")


def none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DIAGNOSTIC)


def literal(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """rows: (check_id, severity, category, artifact, message)."""
    return spark.createDataFrame([(a, b, c, d, None, 0, m) for a, b, c, d, m in rows], DIAGNOSTIC)


def where(df: DataFrame, bad: Column, check_id: str, category: str, artifact: str, message: Column, row: Place = None, severity: str = "ERROR") -> DataFrame:
    """One diagnostic for each row of df for which bad is true."""
    return each(df, [(bad, check_id, message, category)], artifact, row, severity)


#: A row-local rule: where it is broken, its id, the message, and its category.
Rule = tuple[Column, str, Column, str]


def each(df: DataFrame, rules: list[Rule], artifact: str, row: Place = None, severity: str = "ERROR") -> DataFrame:
    """Any number of row-local rules in one pass over df."""
    found = F.array_compact(F.array(*[F.when(bad, F.struct(F.lit(cid).alias("check_id"), F.lit(category).alias("category"), F.lit(k).alias("sub"), msg.alias("message"))) for k, (bad, cid, msg, category) in enumerate(rules)]))
    r = place(row).alias("row")
    return df.select(r, F.explode(found).alias("d")).select("d.check_id", F.lit(severity).alias("severity"), "d.category", F.lit(artifact).alias("artifact"), "row", "d.sub", "d.message")


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def cap(d: DataFrame, most: int = CAP, nulls: int = NULL_CAP) -> DataFrame:
    """The first findings of each check by row, `nulls` of the null checks and `most` of others, then one row that counts
    the rest. Reads d twice, once for the counts: cut it before if it is costly."""
    limit = F.when(F.col("check_id").contains(".null_"), nulls).otherwise(most)
    by = Window.partitionBy("check_id", "artifact").orderBy(F.col("row").asc_nulls_last(), "sub", "message")
    first = d.withColumn("rn", F.row_number().over(by)).where((F.col("rn") <= max(most, nulls)) & (F.col("rn") <= limit)).drop("rn")
    keys = ["check_id", "severity", "category", "artifact"]
    rest = d.groupBy(*keys).count().where(F.col("count") > limit).select(*keys, F.lit(None).cast("long").alias("row"), F.lit(2**31 - 1).alias("sub"), F.format_string("... and %d more", F.col("count") - limit).alias("message"))
    return first.unionByName(rest)


def strict(d: DataFrame) -> DataFrame:
    """Warnings become errors."""
    return d.withColumn("severity", F.when(F.col("severity") == "WARN", "ERROR").otherwise(F.col("severity")))


def counts(d: DataFrame, *by: str) -> DataFrame:
    """errors, warnings, infos, valid: one row, also without findings; or one for each value of by."""
    n = lambda s, c: F.count_if(F.col("severity") == s).alias(c)
    return d.groupBy(*by).agg(n("ERROR", "errors"), n("WARN", "warnings"), n("INFO", "infos")).withColumn("valid", F.col("errors") == 0)


#: Categories in the order of a report.
PHASES = ("FilePresence", "Manifest", "Schema", "IdConstraint", "Geometry", "ReferentialIntegrity", "GraphInvariant", "ValueConsistency", "Raster")


def in_order(d: DataFrame) -> DataFrame:
    """By phase, check, row and place within the row."""
    phase = F.array_position(F.array(*[F.lit(p) for p in PHASES]), F.col("category"))
    return d.orderBy(F.when(phase == 0, len(PHASES) + 1).otherwise(phase), "check_id", F.col("row").asc_nulls_last(), "sub", "message")


def location(d: DataFrame) -> Column:
    """Where a finding is: a row, a field of the manifest, a column, or the file as a whole."""
    field = F.when(~F.col("check_id").isin("manifest.read", "manifest.json_parse", "manifest.deserialize"), F.regexp_extract("check_id", r"^manifest\.(\w+)$", 1))
    column = F.when(F.col("category") == "Schema", F.regexp_extract("message", r"^column (\S+) ", 1))
    return (
        F.when(F.col("row").isNotNull(), F.format_string(" row %d", "row"))
        .when(field != "", F.concat(F.lit(' field "'), field, F.lit('"')))
        .when(column != "", F.concat(F.lit(' column "'), column, F.lit('"')))
        .otherwise("")
    )


def line(d: DataFrame) -> DataFrame:
    """text: [SEVERITY] artifact location (check): message."""
    return d.select(F.concat(F.lit("["), "severity", F.lit("] "), "artifact", location(d), F.lit(" ("), "check_id", F.lit("): "), "message").alias("text"))


def as_text(d: DataFrame) -> str:
    """The printed report; d is capped before, so its rows are few."""
    c = counts(d).first()
    lines = [r.text for r in line(in_order(d)).collect()]
    return "\n".join([*lines, f"{c.errors} error(s), {c.warnings} warning(s), {c.infos} info", f"Result: {'VALID' if c.valid else 'INVALID'}"])


def as_json(d: DataFrame) -> str:
    c = counts(d).first()
    rows = [{k: v for k, v in r.asDict().items() if v is not None and k != "sub"} for r in in_order(d).collect()]
    return json.dumps({"passed": c.valid, "error_count": c.errors, "warning_count": c.warnings, "info_count": c.infos, "diagnostics": rows})
