"""Pages: kinds, document rollup, page windows and the joins between pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..options import DEFAULT, Options


def page_kinds(pages: DataFrame, min_chars: int = DEFAULT.page_chars) -> DataFrame:
    """pages(doc_id, page_num, text) with char_count and kind (electronic or image)."""
    n = F.length(t.strip(t.text_of(F.col("text"))))
    return pages.withColumn("char_count", n).withColumn("kind", F.when(n >= min_chars, "electronic").otherwise("image"))


def classify(pages: DataFrame, docs: DataFrame | None = None, min_chars: int = DEFAULT.page_chars) -> DataFrame:
    """A row a document: page_count, total_chars, avg_chars_per_page, page lists and document_type.

    docs, if given, brings documents without pages; those count as electronic.  One shuffle, on
    doc_id, of page numbers and lengths; texts stay behind.
    """
    kinds = page_kinds(pages, min_chars).select("doc_id", "page_num", "char_count", "kind")
    listed = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("page_num"))))
    out = kinds.groupBy("doc_id").agg(F.count("*").alias("page_count"), F.sum("char_count").alias("total_chars"), listed("electronic").alias("electronic_pages"), listed("image").alias("image_pages"))
    if docs is not None:
        none = F.array().cast(out.schema["image_pages"].dataType)
        out = docs.select("doc_id").join(out, "doc_id", "left").select("doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("page_count", "total_chars")], *[F.coalesce(c, none).alias(c) for c in ("electronic_pages", "image_pages")])
    average = F.when(F.col("page_count") == 0, F.lit(0.0)).otherwise(F.bround(F.col("total_chars") / F.col("page_count"), 2))
    return out.withColumn("avg_chars_per_page", average).withColumn("document_type", document_type(F.size("electronic_pages"), F.size("image_pages")))


def document_type(electronic: Column, image: Column) -> Column:
    return F.when(image == 0, "electronic").when(electronic == 0, "scanned").otherwise("hybrid")


def guess_pages(n: Column, o: Options = DEFAULT) -> Column:
    """Pages worth reading in a scan of n pages: the first ones, a middle stretch of long documents, the last ones."""
    none = F.array().cast("array<int>")
    n = n.cast("int")
    first = F.when(n >= 1, F.sequence(F.lit(1), F.least(F.lit(o.guess_first), n))).otherwise(none)
    a, b = o.guess_middle
    middle = F.when((n >= o.guess_middle_from) & (n >= a), F.sequence(F.lit(a), F.least(F.lit(b), n))).otherwise(none)
    last = F.when(n >= 1, F.sequence(F.greatest(F.lit(1), n - o.guess_last), n)).otherwise(none)
    return F.array_distinct(F.concat(first, middle, last))


def near_pages(page: Column, n: Column, back: int = 1, ahead: int = 2) -> Column:
    """Pages around a page that exist."""
    return F.filter(F.sequence(page - back, page + ahead), lambda p: (p >= 1) & (p <= n))


def section_a_pages(page: Column, n: Column) -> Column:
    return near_pages(page, n, 2, 0)


def last_pages(pages: Column, k: int = DEFAULT.last_pages) -> Column:
    return F.when(F.size(pages) > k, F.slice(pages, -k, k)).otherwise(pages)


def pages_to_read(kind: Column, section_page: Column, suggested: Column, image_pages: Column, o: Options = DEFAULT) -> Column:
    """Which pages the extraction of a document of this type reads."""
    none = F.array().cast("array<int>")
    return (
        F.when(kind == "electronic", F.when(section_page.isNotNull(), F.array(section_page)).otherwise(F.coalesce(F.slice(suggested, 1, 1), none)))
        .when(kind == "scanned", F.when(section_page.isNotNull(), F.array(section_page, section_page + 1)).otherwise(F.coalesce(suggested, none)))
        .when(kind == "hybrid", last_pages(image_pages, o.last_pages))
        .otherwise(none)
    )


def chosen_pages(pages: DataFrame, chosen: DataFrame) -> DataFrame:
    """Pages of a list (doc_id, page_num); missing ones drop out."""
    return pages.join(chosen.select("doc_id", "page_num").distinct(), ["doc_id", "page_num"])


def with_next_page(pages: DataFrame, sep: str = "\n") -> DataFrame:
    """Each page's text with that of the page one number on, if there is one."""
    after = pages.select("doc_id", (F.col("page_num") - 1).alias("page_num"), t.text_of(F.col("text")).alias("__next"))
    joined = F.when(F.col("__next").isNotNull(), F.concat(t.text_of(F.col("text")), F.lit(sep), F.col("__next"))).otherwise(t.text_of(F.col("text")))
    return pages.join(after, ["doc_id", "page_num"], "left").withColumn("text_with_next", joined).drop("__next")


def other_pages(pages: DataFrame, used: DataFrame) -> DataFrame:
    """Pages that aren't in a list."""
    return pages.join(used.select("doc_id", "page_num"), ["doc_id", "page_num"], "left_anti")


def joined_text(pages: DataFrame, sep: str = "\n", mark: bool = False) -> DataFrame:
    """A row a document: its pages' texts in page order, each under a page mark if asked."""
    text = t.text_of(F.col("text"))
    if mark:
        text = F.concat(F.lit("--- Page "), F.col("page_num").cast("string"), F.lit(" ---\n"), text)
    rows = F.array_sort(F.collect_list(F.struct("page_num", text.alias("x"))))
    return pages.groupBy("doc_id").agg(F.array_join(F.transform(rows, lambda r: r["x"]), sep).alias("text"))
