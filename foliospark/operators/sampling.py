"""Exact samples: k of n rows, and stratified review samples with an allocation.

Rows are ordered by md5(seed || id), which any engine computes alike; so a sample is the same on
every run and for every partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def ticket(seed: int | str, *ids: str) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), *[F.coalesce(F.col(i).cast("string"), F.lit("")) for i in ids]).cast("binary"))


def share_size(n: Column, percent: float) -> Column:
    """floor(n * percent / 100), 1 at least."""
    return F.greatest(F.floor(n * F.lit(percent / 100)), F.lit(1)).cast("long")


def exact_sample(df: DataFrame, k: int, ids: Sequence[str], seed: int | str = 0) -> DataFrame:
    """k rows without replacement: a top-k by ticket, so each task sends k rows at most."""
    return df.orderBy(ticket(seed, *ids), *ids).limit(k)


def percent_sample(df: DataFrame, percent: float, ids: Sequence[str], seed: int | str = 0) -> DataFrame:
    if not 0 < percent < 100:
        return df
    n = df.count()
    return exact_sample(df, max(1, int(n * percent / 100)), ids, seed)


def allocation(groups: DataFrame, size: int, least: int = 2, key: str = "stratum") -> DataFrame:
    """groups(key, n) -> slots: in proportion, ``least`` at least and n at most; what is missing fills the largest groups.

    Filling in order of size is a running sum, so there is no loop; ties go by key.
    """
    everything, order = W.partitionBy(F.lit(0)), W.partitionBy(F.lit(0)).orderBy(F.desc("n"), key)
    base = groups.withColumn("base", F.least(F.col("n"), F.greatest(F.lit(least), F.floor(F.col("n") / F.sum("n").over(everything) * size))).cast("long"))
    base = base.withColumn("cap", F.col("n") - F.col("base"))
    missing = F.greatest(F.lit(0), F.lit(size) - F.sum("base").over(everything))
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return base.select(key, "n", (F.col("base") + F.greatest(F.lit(0), F.least(F.col("cap"), missing - before))).alias("slots"))


def stratified_sample(df: DataFrame, size: int, stratum: str, ids: Sequence[str], is_error: Column | None = None, seed: int | str = 0, least: int | None = None) -> DataFrame:
    """Rows of each stratum up to its slots, with sample_index and sample_size.

    With ``is_error`` a third of a stratum's slots, one at least, is for errors if it has any.
    Strata may be of any size: the ranking window is preceded by a window-group limit, since
    only ranks up to the slots are kept.
    """
    rows = df.withColumn("__s", F.coalesce(F.col(stratum).cast("string"), F.lit("unknown"))).withColumn("__e", F.coalesce(is_error, F.lit(False)) if is_error is not None else F.lit(False)).withColumn("__t", ticket(seed, *ids))
    groups = rows.groupBy("__s").agg(F.count("*").alias("n"), F.count_if("__e").alias("errors"))
    slots = allocation(groups.select("__s", "n"), size, (3 if is_error is not None else 2) if least is None else least, "__s")
    slots = groups.select("__s", "errors").join(slots, "__s")
    for_errors = F.when(F.col("errors") > 0, F.least(F.col("errors"), F.greatest(F.lit(1), F.floor(F.col("slots") / 3)))).otherwise(0).cast("long")
    slots = slots.select("__s", "slots", for_errors.alias("error_slots"))
    ranked = rows.withColumn("__r", F.row_number().over(W.partitionBy("__s", "__e").orderBy("__t", *ids))).where(F.col("__r") <= size + 3)
    kept = ranked.join(F.broadcast(slots), "__s").where(F.col("__r") <= F.when(F.col("__e"), F.col("error_slots")).otherwise(F.col("slots") - F.col("error_slots")))
    index = F.row_number().over(W.partitionBy(F.lit(0)).orderBy("__s", F.desc("__e"), "__r"))
    return kept.withColumn("sample_index", index).withColumn("sample_size", F.count("*").over(W.partitionBy(F.lit(0)))).drop("__s", "__e", "__t", "__r", "slots", "error_slots")


def worksheet(sample: DataFrame, k: int = 3) -> DataFrame:
    """A row a document for human review: the first k activities as columns and blanks to fill in."""
    blank = F.lit(None).cast("string")
    acts = F.col("section_b.activities")
    cols = [F.col("sample_index").alias("sample_no"), "company_number", F.col("extraction_metadata.source_file").alias("source_file"), "document_type", "extraction_status"]
    for i in range(1, k + 1):
        a = F.get(acts, F.lit(i - 1))
        cols += [F.coalesce(a["activity"], F.lit("")).alias(f"extracted_activity_{i}"), F.coalesce(a["description"], F.lit("")).alias(f"extracted_benefit_{i}")]
        cols += [blank.alias(f"{name}_{i}") for name in ("correct_activity", "correct_benefit", "is_match", "error_type")]
    return sample.select(*cols, blank.alias("overall_rating"), blank.alias("notes"))
