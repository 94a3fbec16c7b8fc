"""Metrics of a run: counts, rates, distributions, times, accuracies, and the comparison of two runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def flat(results: DataFrame) -> DataFrame:
    """Results reduced to what metrics need: a narrow relation."""
    m = "extraction_metadata"
    return results.select("company_number", "document_type", "extraction_status", F.greatest(F.coalesce(F.size("section_b.activities"), F.lit(0)), F.lit(0)).alias("activities"), F.col(f"{m}.processing_time").alias("processing_time"), F.col(f"{m}.cic36_page").alias("page"))


def batch_summary(rows: DataFrame) -> DataFrame:
    """One row of totals; every status but success and error counts as no data."""
    is_type = lambda name: F.count_if(F.col("document_type") == name)
    s = F.coalesce(F.col("extraction_status"), F.lit("unknown"))
    return rows.agg(
        F.count("*").alias("total"),
        F.count_if(s == "success").alias("success"),
        F.count_if(s == "error").alias("errors"),
        F.count_if(~s.isin("success", "error")).alias("no_data"),
        is_type("electronic").alias("electronic_docs"),
        is_type("scanned").alias("scanned_docs"),
        is_type("hybrid").alias("hybrid_docs"),
        F.coalesce(F.sum("activities"), F.lit(0)).alias("total_activities"),
    )


def united_summary(parts: DataFrame) -> DataFrame:
    """The summary of all results, from the summaries of their parts."""
    return parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in parts.columns])


def counts(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy(F.coalesce(by, F.lit("unknown")).alias(by)).agg(F.count("*").alias("documents"))


def success_rates(rows: DataFrame, by: str = "document_type", success: Column | None = None) -> DataFrame:
    """Rate of success by a column and overall (that column null, is_total true), in one pass with grouping sets."""
    ok = F.coalesce(success if success is not None else F.col("extraction_status") == "success", F.lit(False)).cast("double")
    out = rows.select(F.coalesce(F.col(by), F.lit("unknown")).alias(by), ok.alias("ok")).rollup(by).agg(F.count("*").alias("documents"), F.avg("ok").alias("rate"), F.grouping(by).alias("total"))
    return out.select(by, "documents", "rate", (F.col("total") == 1).alias("is_total"))


def status_grid(rows: DataFrame) -> DataFrame:
    return rows.groupBy("document_type", "extraction_status").agg(F.count("*").alias("documents"))


def count_statistics(rows: DataFrame, n: str = "activities") -> DataFrame:
    """One row: sum, mean, median, least, most, zero and non-zero documents; zeros for no rows."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    return rows.agg(
        zero(F.sum(n)).cast("long").alias("total"),
        F.coalesce(F.avg(n), F.lit(0.0)).alias("mean"),
        F.coalesce(F.median(n), F.lit(0.0)).alias("median"),
        zero(F.min(n)).cast("long").alias("least"),
        zero(F.max(n)).cast("long").alias("most"),
        F.count_if(F.col(n) == 0).alias("zero_documents"),
        F.count_if(F.col(n) > 0).alias("nonzero_documents"),
    )


def count_distribution(rows: DataFrame, n: str = "activities") -> DataFrame:
    return rows.groupBy(F.col(n).cast("long").alias("n")).agg(F.count("*").alias("documents"))


def ranked_value(df: DataFrame, value: str, by: Sequence[str] = (), share: float = 0.95) -> DataFrame:
    """The value at index floor(n * share) of the sorted values, of each group (column ``ranked``).

    A quantile sketch brackets it within 0.1 percent of the ranks to each side; what lies below
    is counted, and only the values inside are ranked.  So no group is gathered or sorted whole.
    """
    by = list(by)
    own = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("__v"))
    own = own if by else own.withColumn("__all", F.lit(0))
    keys = by or ["__all"]
    near = [max(0.0, share - 0.001), min(1.0, share + 0.001)]
    marks = own.groupBy(*keys).agg(F.count("*").alias("__n"), F.percentile_approx("__v", near, 10_000).alias("__q"))
    marks = marks.select(*keys, F.col("__q")[0].alias("__lo"), F.col("__q")[1].alias("__hi"), F.least(F.floor(F.col("__n") * F.lit(share)), F.col("__n") - 1).alias("__index"))
    joined = own.join(marks, keys)
    below = joined.where("__v < __lo").groupBy(*keys).agg(F.count("*").alias("__below"))
    inside = joined.where("__v between __lo and __hi").groupBy(*keys, "__v", "__index").agg(F.count("*").alias("__c"))
    inside = inside.join(below, keys, "left").withColumn("__upto", F.coalesce("__below", F.lit(0)) + F.sum("__c").over(W.partitionBy(*keys).orderBy("__v")))
    return inside.where("__upto > __index and __upto - __c <= __index").select(*by, F.col("__v").alias("ranked"))


def time_statistics(rows: DataFrame, value: str = "processing_time", share: float = 0.95) -> DataFrame:
    """One row over non-null times: mean, median, least, most, ranked (p95) and sum; zeros for none."""
    own = rows.where(F.col(value).isNotNull())
    zero = lambda c, name: F.coalesce(c, F.lit(0.0)).alias(name)
    out = own.agg(F.count("*").alias("n"), zero(F.avg(value), "mean"), zero(F.median(value), "median"), zero(F.min(value), "least"), zero(F.max(value), "most"), zero(F.sum(value), "total"))
    p = ranked_value(own, value, (), share).agg(F.coalesce(F.max("ranked"), F.lit(0.0)).alias("p95"))
    return out.crossJoin(F.broadcast(p))


def mean_time_by(rows: DataFrame, by: str = "document_type", value: str = "processing_time") -> DataFrame:
    return rows.where(F.col(value).isNotNull()).groupBy(by).agg(F.avg(value).alias("mean"), F.count("*").alias("documents"))


def tolerance_accuracy(found: DataFrame, truth: DataFrame, key: str = "company_number", page: str = "page", true_page: str = "section_page") -> DataFrame:
    """One row: joined rows and the shares within 0, 1 and 2 pages; a null page is no match but counts."""
    joined = found.select(key, page).join(truth.select(key, true_page), key)
    d = F.abs(F.col(page) - F.col(true_page))
    rate = lambda k: (F.count_if(d <= k) / F.greatest(F.count("*"), F.lit(1))).alias(f"within_{k}" if k else "exact")
    return joined.agg(F.count("*").alias("total"), rate(0), rate(1), rate(2))


def match_accuracy(sheet: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row over filled match columns: Y, P and other counts, exact and partial-or-better rates."""
    long = sheet.unpivot([], list(columns), "slot", "value").where("value is not null and value <> ''")
    n = F.greatest(F.count("*"), F.lit(1))
    y, p = F.count_if(F.upper("value") == "Y"), F.count_if(F.upper("value") == "P")
    return long.agg(F.count("*").alias("checked"), y.alias("exact"), p.alias("partial"), (F.count("*") - y - p).alias("wrong"), (y / n).alias("exact_rate"), ((y + p) / n).alias("partial_or_better_rate"))


def ratings(sheet: DataFrame, column: str = "overall_rating") -> DataFrame:
    return sheet.where(F.coalesce(F.col(column), F.lit("")) != "").groupBy(F.col(column).alias("rating")).agg(F.count("*").alias("documents"))


def compare_groups(baseline: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Both sides' values by key, a missing one as 0, and the change."""
    a = baseline.select(key, F.col(value).alias("baseline"))
    b = new.select(key, F.col(value).alias("new"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    out = a.join(b, key, "full_outer")
    return out.select(key, zero(F.col("baseline")).alias("baseline"), zero(F.col("new")).alias("new"), (zero(F.col("new")) - zero(F.col("baseline"))).alias("change"))


def verdict(old_rate: Column, new_rate: Column, old_quality: Column, new_quality: Column) -> Column:
    return F.when((new_rate > old_rate) & (new_quality >= old_quality), "adopt").when(new_rate > old_rate, "trade-off").when(new_rate < old_rate, "reject").otherwise("similar")
