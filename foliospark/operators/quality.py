"""Quality of extraction results: scores a document, error categories, and the report over all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions import text as t


def activity_scores(activities: Column, benefit_field: str = "benefit") -> Column:
    """array<struct<c, h, n>>: completeness, coherence and noise of each activity."""
    return F.transform(
        activities,
        lambda a: F.struct(S.completeness(a["activity"], a[benefit_field]).alias("c"), S.coherence(a["activity"], a[benefit_field]).alias("h"), S.noise(a["activity"], a[benefit_field]).alias("n")),
    )


def document_quality(parts: Column) -> Column:
    """struct<overall_score, completeness_score, coherence_score, noise_score, issues, activity_count> of activity scores; no activities: 0, 0, 0, 100."""
    size = F.size(parts)
    mean = lambda f: F.aggregate(parts, F.lit(0.0), lambda acc, p: acc + p[f]) / size
    name = lambda i, what: F.concat(F.lit("Activity "), (i + 1).cast("string"), F.lit(what))
    told = F.flatten(F.transform(parts, lambda p, i: F.array_compact(F.array(F.when(p["c"] < 50, name(i, ": Incomplete pair")), F.when(p["h"] < 50, name(i, ": Poor text quality")), F.when(p["n"] < 50, name(i, ": OCR artifacts detected"))))))
    empty = F.coalesce(size, F.lit(0)) <= 0
    one = lambda x, otherwise: F.when(empty, F.lit(otherwise)).otherwise(F.bround(x, 1))
    c, h, n = mean("c"), mean("h"), mean("n")
    return F.struct(
        one(S.overall(c, h, n), 0.0).alias("overall_score"),
        one(c, 0.0).alias("completeness_score"),
        one(h, 0.0).alias("coherence_score"),
        one(n, 100.0).alias("noise_score"),
        F.when(empty, F.array(F.lit("No activities extracted"))).otherwise(told).alias("issues"),
        F.when(empty, 0).otherwise(size).alias("activity_count"),
    )


def score_results(results: DataFrame, benefit_field: str = "description") -> DataFrame:
    """Results with quality (see ``score_activities``), quality_label, error_category and flag.

    benefit_field: ``description`` reads what is stored; ``benefit`` reads a field that stored
    results lack, as a view of how they were first evaluated.
    """
    acts = F.col("section_b.activities")
    if benefit_field not in [f.name for f in results.schema["section_b"].dataType["activities"].dataType.elementType.fields]:
        acts = F.transform(acts, lambda a: F.struct(a["activity"].alias("activity"), F.lit(None).cast("string").alias(benefit_field)))
    # Activity scores are a column of their own, so that they are computed once for all that reads them.
    out = results.withColumn("__parts", activity_scores(acts, benefit_field)).withColumn("quality", document_quality(F.col("__parts"))).drop("__parts")
    out = out.withColumn("quality_label", S.quality_label(F.col("quality.overall_score"))).withColumn("error_category", S.error_category(F.col("extraction_metadata.error"), acts, benefit_field=benefit_field))
    return out.withColumn("flag", F.when((F.col("quality.overall_score") < 50) | (F.col("error_category") != "success"), F.coalesce("company_number", "extraction_metadata.source_file", F.lit("unknown"))))


def quality_report(scored: DataFrame) -> DataFrame:
    """One row: bands, categories (map), mean score, flagged count; whole also for no results."""
    s = F.col("quality.overall_score")
    band = lambda name: F.count_if(F.col("quality_label") == name).alias(name)
    return scored.agg(band("excellent"), band("good"), band("fair"), band("poor"), F.coalesce(F.bround(F.avg(s), 1), F.lit(0.0)).alias("mean_quality_score"), F.count("flag").alias("flagged_count"), F.count("*").alias("documents"))


def error_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("error_category").agg(F.count("*").alias("documents"))


def quality_by_type(scored: DataFrame) -> DataFrame:
    return scored.groupBy("document_type").agg(F.bround(F.avg("quality.overall_score"), 1).alias("mean_quality_score"), F.count("*").alias("documents"))


def overall_pair_quality(activities: Column) -> Column:
    """Mean of the pairs' rounded scores; 0 without any."""
    parts = F.transform(activities, lambda a: S.validate_pair(a["activity"], a["benefit"])["quality_score"])
    return F.when(F.coalesce(F.size(activities), F.lit(0)) <= 0, F.lit(0.0)).otherwise(F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x) / F.size(activities))


def validate_result(results: DataFrame) -> DataFrame:
    """Results with validation: struct<valid, issues, activity_count>."""
    acts = F.coalesce(F.col("section_b.activities"), F.array().cast(results.schema["section_b"].dataType["activities"].dataType))
    blank = lambda c: t.text_of(c) == ""
    each = F.transform(acts, lambda a, i: F.when(blank(a["activity"]) & blank(a["description"]), F.concat(F.lit("Activity "), (i + 1).cast("string"), F.lit(" has no content"))))
    issues = F.array_compact(
        F.concat(
            F.array(
                F.when(blank(F.col("company_number")), "Missing company_number"),
                F.when(blank(F.col("extraction_status")), "Missing extraction_status"),
                F.when((F.col("extraction_status") == "success") & (F.size(acts) == 0), "Status is 'success' but no activities found"),
            ),
            each,
            F.array(F.when(blank(F.col("extraction_metadata.source_file")), "Missing source_file in metadata")),
        )
    )
    return results.withColumn("validation", F.struct((F.size(issues) == 0).alias("valid"), issues.alias("issues"), F.size(acts).alias("activity_count")))
