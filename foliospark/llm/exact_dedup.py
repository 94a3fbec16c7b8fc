"""Exact de-duplication by progressive refinement: length, then prefix hash, then full hash.

Two texts are equal when they are identical after deleting [\x20\x09-\x0D].  Each step only
looks at rows whose group of the step before has two rows at least; what is alone after a
step is unique.  All steps are DataFrame operations.

Of equal texts the row with the most code points in the original text stays, then the
smallest id (a null id comes last), and of rows with the same id and number of code points
one, whichever.  A null text counts as an empty one, so null, empty and blank texts are one
group.  Extra columns are ignored.  An empty table gives an empty result.

The text never enters a shuffle.  ``exact_groups`` has to give every row's digest, so its one
scan reduces each row to about 100 bytes, which are written to the scratch folder; the groups of
every step come from that table with partial aggregation before the shuffle, so a group of any
size costs a row a task.  The joins back to the rows are sort-merge joins whose large partitions
adaptive execution splits.  ``drop_copies`` needs no digest, so it takes one only of texts that
share length and prefix with another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import drop_rows, materialize, short

#: Code points of the normalised text in the prefix hash.
PREFIX = 128
BLANK = "[\\x20\\x09-\\x0D]+"


def normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, "")


def full_hash(normalised: Column) -> Column:
    return F.sha2(normalised.cast("binary"), 256)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document: doc_id, keep_id, group_size, kept, text_sha256.

    The digest is part of the result, so the one scan computes it for every row; the
    refinement uses it only where length and prefix hash leave a group.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.length(text).alias("chars"), normal(text).alias("norm"))
    rows = materialize(rows.select("doc_id", "chars", F.length("norm").alias("len"), F.xxhash64(F.substring("norm", 1, PREFIX)).alias("prefix"), full_hash(F.col("norm")).alias("sha")), "exact-dedup")
    return refine(rows)


def refine(rows: DataFrame) -> DataFrame:
    """rows: doc_id, chars, len, prefix, sha; materialised."""
    # Lengths that occur twice; then (length, prefix hash) among those that do; then full hashes.
    by_len = rows.groupBy("len").agg(F.count("*").alias("n")).where("n > 1").select("len")
    some = rows.join(by_len, "len", "left_semi")
    by_prefix = some.groupBy("len", "prefix").agg(F.count("*").alias("n")).where("n > 1").select("len", "prefix")
    some = some.join(by_prefix, ["len", "prefix"], "left_semi")
    best = F.min(F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    groups = some.groupBy("sha").agg(F.count("*").alias("n"), best.alias("best")).where("n > 1")
    groups = groups.select("sha", "n", F.col("best.doc_id").alias("keep"), (-F.col("best.less")).alias("most"))
    out = rows.join(groups, "sha", "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("doc_id").eqNullSafe(F.col("keep")) & (F.col("chars") == F.col("most")))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    return _one_of_repeated(out)


def _one_of_repeated(out: DataFrame) -> DataFrame:
    """Where the id that stays occurs more than once in its group, one of those rows stays kept.

    Such groups are found with a partial aggregate; the window sees their kept rows alone.
    """
    again = out.where("kept and group_size > 1").groupBy("text_sha256").agg(F.count("*").alias("c")).where("c > 1")
    again = materialize(again.select("text_sha256", F.lit(True).alias("again")), "exact-repeated")
    if not again.take(1):
        return out
    marked = out.join(again, "text_sha256", "left")
    first = F.row_number().over(W.partitionBy("text_sha256").orderBy("doc_id")) == 1
    twice = marked.where("again and kept").withColumn("kept", first)
    return marked.where("not (coalesce(again, false) and kept)").unionByName(twice).drop("again")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, in its own columns.

    Each step takes more of fewer texts: lengths and prefix hashes of all, as narrow rows; then, of
    the documents whose length occurs twice and whose length and prefix do, digests of the
    whole text.  Their ids are counted and broadcast to the scan, so texts aren't shuffled; ids too
    many for that let all texts through to the digests.
    """
    own, body = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    text = F.coalesce(body, F.lit(""))
    rows = docs.select(own.alias("doc_id"), normal(text).alias("norm"))
    rows = materialize(rows.select("doc_id", F.length("norm").alias("len"), F.xxhash64(F.substring("norm", 1, PREFIX)).alias("prefix")), "exact-prefixes")
    some = _groups_of_two(rows, "len")
    ids = materialize(_groups_of_two(some, "len", "prefix").select("doc_id").distinct(), "exact-suspects", merge=False)
    whole = docs.select(own.alias("doc_id"), text.alias("text"))
    if short(ids):
        suspect = F.broadcast(ids.withColumnRenamed("doc_id", "id"))
        whole = whole.join(suspect, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    rows = materialize(whole.select("doc_id", F.length("text").alias("chars"), F.unhex(full_hash(normal(F.col("text")))).alias("sha")), "exact-digests")
    best = F.min(F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    groups = rows.groupBy("sha").agg(F.count("*").alias("n"), best.alias("best")).where("n > 1")
    found = rows.join(groups.select("sha", "best"), "sha").select("doc_id", "sha", F.col("doc_id").eqNullSafe(F.col("best.doc_id")).alias("same"))
    # Rows are known by id and text: an id may be null or stand for other texts as well.
    gone = found.groupBy(F.col("doc_id").alias("id"), F.col("sha").alias("mark")).agg(F.count("*").alias("n"), F.first("same").alias("same"))
    gone = materialize(gone.where("n > 1 or not same"), "exact-gone", merge=False)
    return drop_rows(docs, gone.where("not same").select("id", "mark"), gone.where("same").select("id", "mark"), F.unhex(full_hash(normal(body))), id_col, text_col)


def _groups_of_two(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows whose keys occur twice at least."""
    twice = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys)
    return rows.join(twice, [*keys], "left_semi")
