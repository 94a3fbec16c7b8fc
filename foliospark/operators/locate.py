"""Locating forms and sections: the first page by order of priority, and the pages that continue it.

Every search is flags by page, then one aggregation on doc_id.  Texts never enter a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import patterns as P
from ..functions import text as t
from ..options import DEFAULT, Options


def tier(c: Column, tiers: Sequence[Sequence[str]], extra: str = "") -> Column:
    """Number (from 1) of the first pattern set with a match; null without one."""
    out = F.lit(None).cast("int")
    for k, patterns in reversed(list(enumerate(tiers, 1))):
        out = F.when(t.any_match(c, patterns, extra), k).otherwise(out)
    return out


def find_form_pages(pages: DataFrame, form: Sequence[str] = P.FORM, tiers: Sequence[Sequence[str]] = (P.SECTION_HIGH, P.SECTION_MEDIUM, P.SECTION_LOW), excluded: Sequence[str] = P.EXCLUDED, names: Sequence[str] = ("high", "medium", "low")) -> DataFrame:
    """A row a document with text pages: form_pages, candidates, section_page and its tier, confidence, suggested_pages.

    The section is the first candidate at or after the first form page, else the first
    candidate.  A form page of an excluded section is no candidate.
    """
    text = t.text_of(F.col("text"))
    flags = pages.select("doc_id", "page_num", t.any_match(text, form).alias("form"), t.any_match(text, excluded).alias("out"), tier(text, tiers).alias("tier"))
    flags = flags.withColumn("tier", F.when(~(F.col("form") & F.col("out")), F.col("tier")))
    listed = lambda cond, x: F.array_sort(F.collect_list(F.when(cond, x)))
    out = flags.groupBy("doc_id").agg(
        F.max("page_num").alias("page_count"),
        listed(F.col("form"), F.col("page_num")).alias("form_pages"),
        listed(F.col("tier").isNotNull(), F.struct("page_num", "tier")).alias("found"),
    )
    first_form = F.get("form_pages", F.lit(0))
    chosen = F.coalesce(F.get(F.filter("found", lambda f: f["page_num"] >= first_form), F.lit(0)), F.get("found", F.lit(0)))
    labels = F.array(*[F.lit(n) for n in names])
    out = out.withColumn("chosen", chosen)
    has_form, has_section = F.size("form_pages") > 0, F.col("chosen").isNotNull()
    n = F.col("page_count")
    return out.select(
        "doc_id",
        "page_count",
        "form_pages",
        F.transform("found", lambda f: f["page_num"]).alias("candidates"),
        F.col("chosen.page_num").alias("section_page"),
        F.get(labels, F.col("chosen.tier") - 1).alias("section_tier"),
        F.when(has_form & has_section, "high").when(has_form | has_section, "medium").otherwise("low").alias("confidence"),
        F.when(~has_form & ~has_section, F.sequence(F.greatest(F.lit(1).cast(pages.schema["page_num"].dataType), n - 10), n)).alias("suggested_pages"),
    )


def form_start(pages: DataFrame, high: Sequence[str] = P.START_HIGH, medium: Sequence[str] = P.START_MEDIUM, articles: Sequence[str] = P.ARTICLES) -> DataFrame:
    """(doc_id, start_page): the lowest page with a sure mark, else the lowest with a weaker one that isn't articles."""
    text = t.text_of(F.col("text"))
    weaker = t.any_match(text, medium, "m") & ~t.any_match(text, articles)
    page = F.col("page_num")
    return pages.groupBy("doc_id").agg(F.coalesce(F.min(F.when(t.any_match(text, high), page)), F.min(F.when(weaker, page))).alias("start_page"))


def first_page(pages: DataFrame, patterns: Sequence[str] = P.SECTION_A, name: str = "page") -> DataFrame:
    """(doc_id, page): the lowest page with any of the patterns."""
    return pages.groupBy("doc_id").agg(F.min(F.when(t.any_match(t.text_of(F.col("text")), patterns), F.col("page_num"))).alias(name))


def section_span(
    pages: DataFrame,
    starts: DataFrame | None = None,
    tiers: Sequence[Sequence[str]] = (P.OCR_PRIMARY, P.OCR_FALLBACK, P.OCR_JUMBLED),
    closing: Sequence[str] = P.SURPLUS_MARKS,
    ends: Sequence[str] = P.SECTION_ENDS,
    o: Options = DEFAULT,
) -> DataFrame:
    """(doc_id, page_num, header_page, header_tier): the header's page and those that continue the section.

    The header is the lowest page of the best tier, searched only behind the form's start
    (starts: doc_id, start_page) where that is known.  If its own page closes the section, it
    stays alone; else later pages follow up to and with the first that closes or ends it or
    lies more than ``pages_after_header`` on.
    """
    text = t.text_of(F.col("text"))
    closes = t.any_match(text, closing)
    flags = pages.select("doc_id", "page_num", tier(text, tiers).alias("tier"), closes.alias("closes"), (closes | t.any_match(text, ends)).alias("stops"))
    first, last = o.window_after_start
    if starts is not None:
        flags = flags.join(starts.select("doc_id", "start_page"), "doc_id", "left")
    else:
        flags = flags.withColumn("start_page", F.lit(None).cast("int"))
    inside = F.col("start_page").isNull() | F.col("page_num").between(F.col("start_page") + first, F.col("start_page") + last)
    doc = W.partitionBy("doc_id")
    flags = flags.withColumn("header", F.min(F.when(inside & F.col("tier").isNotNull(), F.struct("tier", "page_num"))).over(doc)).where("header is not null")
    flags = flags.withColumn("header_page", F.col("header.page_num")).withColumn("header_tier", F.col("header.tier"))
    alone = F.max((F.col("page_num") == F.col("header_page")) & F.col("closes")).over(doc)
    beyond = F.col("page_num") > F.col("header_page") + o.pages_after_header
    stop = F.min(F.when((F.col("page_num") > F.col("header_page")) & (F.col("stops") | beyond), F.col("page_num"))).over(doc)
    flags = flags.withColumn("last_page", F.when(alone, F.col("header_page")).otherwise(stop))
    return flags.where("page_num >= header_page and (last_page is null or page_num <= last_page)").select("doc_id", "page_num", "header_page", "header_tier")


def standalone_section(pages: DataFrame, used: DataFrame, parse, starts: Sequence[str] = P.STANDALONE, ends: Sequence[str] = P.STANDALONE_ENDS) -> DataFrame:
    """(doc_id, page_num, activities): the first unused page with a heading whose content parses to more than a reference.

    parse: text Column -> array of activities.
    """
    from .rows import is_referential

    text = t.text_of(F.col("text"))
    rest = pages.join(used.select("doc_id", "page_num"), ["doc_id", "page_num"], "left_anti")
    tries = F.array(*[t.until_first_listed(t.after(text, p), ends) for p in starts])
    tries = F.filter(tries, lambda x: F.length(t.strip(x)) > 50)
    found = rest.select("doc_id", "page_num", F.posexplode(tries).alias("heading", "part")).withColumn("activities", parse(F.col("part")))
    found = found.where((F.size("activities") > 0) & ~is_referential(F.col("activities")))
    # Several headings may match one page; the first listed one counts.
    one = found.groupBy("doc_id").agg(F.min_by(F.struct("page_num", "activities"), F.struct("page_num", "heading")).alias("x"))
    return one.select("doc_id", "x.page_num", "x.activities")
