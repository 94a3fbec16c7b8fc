"""Extraction: from page texts to result documents.

Documents are columns of one relation from stage to stage; the only shuffles are on doc_id, of
page flags or of the pages chosen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions import text as t
from ..operators import locate as L
from ..operators import pages as P
from ..operators import rows as R
from ..operators import slices as X
from ..options import DEFAULT, Options
from ..sources import results as IO


def activities_of_tables(tables: DataFrame) -> DataFrame:
    """tables(doc_id, page_num, strategy, table_idx, cells) -> (doc_id, activities), de-duplicated.

    On each page only tables of its lowest strategy count.
    """
    best = tables.groupBy("doc_id", "page_num").agg(F.min("strategy").alias("strategy"))
    rows = tables.join(best, ["doc_id", "page_num", "strategy"]).select("doc_id", "page_num", "table_idx", F.posexplode(R.parse_table(F.col("cells"))).alias("pos", "a"))
    order = F.array_sort(F.collect_list(F.struct("page_num", "table_idx", "pos", "a")))
    return rows.groupBy("doc_id").agg(R.dedupe(F.transform(order, lambda r: r["a"])).alias("activities"))


def extract_text(pages: DataFrame, chosen: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """Documents with a text layer: (doc_id, activities, company_differs, surplus_use, beneficiaries, extraction_method).

    chosen: doc_id, section_page.  Tables come first; without any, the section's lines make one activity.
    """
    extent = pages.groupBy("doc_id").agg(F.max("page_num").alias("n"))
    at = chosen.where("section_page is not null").join(extent, "doc_id")
    near = at.select("doc_id", F.explode(P.near_pages(F.col("section_page"), F.col("n"))).alias("page_num"))
    before = at.select("doc_id", F.explode(P.section_a_pages(F.col("section_page"), F.col("n"))).alias("page_num"))
    body = P.joined_text(P.chosen_pages(pages, near), mark=True)
    head = P.joined_text(P.chosen_pages(pages, before)).withColumnRenamed("text", "head")
    out = body.join(head, "doc_id", "left").select("doc_id", X.text_body(F.col("text")).alias("body"), X.company_differs(F.col("text")).alias("company_differs"), X.surplus_use(F.col("text")).alias("surplus_use"), X.beneficiaries(F.col("head")).alias("beneficiaries"))
    lines = F.when(F.col("body") != "", F.array(R.pair(F.col("body"), F.lit("")))).otherwise(R.none())
    if tables is None:
        return out.select("doc_id", lines.alias("activities"), "company_differs", "surplus_use", "beneficiaries", F.lit("text_fallback").alias("extraction_method"))
    found = activities_of_tables(tables.join(near, ["doc_id", "page_num"], "left_semi")).withColumnRenamed("activities", "rows")
    has = F.coalesce(F.size("rows"), F.lit(0)) > 0
    return out.join(found, "doc_id", "left").select("doc_id", F.when(has, F.col("rows")).otherwise(lines).alias("activities"), "company_differs", "surplus_use", "beneficiaries", F.when(has, "table").otherwise("text_fallback").alias("extraction_method"))


def extract_recognised(pages: DataFrame, words: DataFrame | None = None, o: Options = DEFAULT) -> DataFrame:
    """Recognised documents: the same columns, and section_page, ocr_confidence, status_detail, error.

    The form's start, the section's pages behind it, its rows by layout or by text, then checks:
    other forms' content is dropped, a mere reference leads to a section elsewhere in the document.
    """
    starts = L.form_start(pages)
    span = L.section_span(pages, starts, o=o)
    head = P.with_next_page(pages)
    page_a = L.first_page(pages, name="page_a")
    heads = starts.join(page_a, "doc_id").join(head.select("doc_id", F.col("page_num").alias("start_page"), F.col("text_with_next").alias("t1")), ["doc_id", "start_page"], "left").join(head.select("doc_id", F.col("page_num").alias("page_a"), F.col("text_with_next").alias("t2")), ["doc_id", "page_a"], "left")
    heads = heads.select("doc_id", "start_page", F.coalesce(F.nullif(X.ocr_beneficiaries(F.col("t1")), F.lit("")), X.ocr_beneficiaries(F.col("t2")), F.lit("")).alias("beneficiaries"))

    section = P.joined_text(P.chosen_pages(pages, span)).join(span.groupBy("doc_id").agg(F.min("header_page").alias("section_page")), "doc_id")
    # Two steps, so that the parser stands in the plan once.
    section = section.withColumn("raw", F.col("text")).withColumn("text", X.strip_boilerplate(F.col("text")))
    section = section.withColumn("plain", R.parse_section(F.col("text")))
    if words is not None:
        boxes = R.layout(words, o).join(span.select("doc_id", "page_num"), ["doc_id", "page_num"])
        boxes = boxes.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_num", "has_two_columns", "left", "right", "linear_text"))).alias("boxes"))
        section = section.join(boxes, "doc_id", "left")
        two = F.coalesce(F.exists("boxes", lambda b: b["has_two_columns"]), F.lit(False))
        parsed = F.when(two, R.parse_layout(F.col("boxes"), F.col("text"), F.col("raw"), F.col("plain"))).otherwise(F.col("plain"))
        method = F.when(two, "ocr_layout").otherwise("ocr")
    else:
        parsed, method = F.col("plain"), F.lit("ocr")
    section = section.select("doc_id", "section_page", "text", parsed.alias("entries"), method.alias("method"), S.ocr_quality(F.col("text")).alias("quality"), S.likely_handwritten(F.col("text")).alias("handwritten"))
    section = section.withColumn("activities", F.transform("entries", lambda e: R.pair(e["activity"], e["benefit"])))
    section = section.withColumn("refers", R.is_referential(F.col("activities")))
    # Read twice below.  The two plans are alike up to this shuffle, so it runs once, and the parser with it: fields read
    # by a lambda aren't pruned, no filter is pushed behind an aggregate, and the documents' own partitioning isn't kept.
    fields = [c for c in section.columns if c != "doc_id"]
    section = section.select("doc_id", F.array(F.struct(*fields)).alias("parsed")).repartition(F.xxhash64("doc_id"))
    refers = section.groupBy("doc_id").agg(F.max(F.exists("parsed", lambda s: s["refers"])).alias("refers")).where("refers").select("doc_id")
    field = lambda name: F.get(F.transform("parsed", lambda s: s[name]), F.lit(0)).alias(name)
    section = section.select("doc_id", *[field(c) for c in fields if c != "refers"])

    parse = lambda c: F.transform(R.parse_section(c), lambda e: R.pair(e["activity"], e["benefit"]))
    elsewhere = L.standalone_section(pages.join(refers, "doc_id", "left_semi"), span, parse)
    elsewhere = elsewhere.select("doc_id", R.dedupe_by_activity(F.col("activities")).alias("other"))
    out = heads.join(section, "doc_id", "left").join(elsewhere, "doc_id", "left")
    has = F.coalesce(F.size("activities"), F.lit(0)) > 0
    check = R.check_content(F.col("activities"), F.col("text"))
    wrong = has & ~check["valid"]
    other = F.coalesce(F.size("other"), F.lit(0)) > 0
    halves = R.two_halves(F.col("text"))
    none = R.none()
    missing = F.col("section_page").isNull()
    rows = F.when(missing | wrong, none).when(other, F.col("other")).when(has, F.col("activities")).otherwise(halves)
    detail = F.when(missing & F.col("start_page").isNull(), "no_form_found").when(missing, "section_not_found").when(wrong, "wrong_section").when(F.col("quality") == "very_low", "ocr_quality_issue")
    error = F.when(missing & F.col("start_page").isNull(), "No form found in document").when(missing, F.concat(F.lit("Form found on page "), F.col("start_page").cast("string"), F.lit(" but no section behind it"))).when(wrong, F.concat(F.lit("Wrong section detected - "), check["reason"]))
    own = lambda name: F.coalesce(F.get(F.filter(F.transform("entries", lambda e: e[name]), lambda x: F.coalesce(x, F.lit("")) != ""), F.lit(0)), F.lit(""))
    return out.select(
        "doc_id",
        rows.alias("activities"),
        own("company_differs").alias("company_differs"),
        own("surplus_use").alias("surplus_use"),
        "beneficiaries",
        F.when(other, "ocr_standalone").when(~missing & ~has, "ocr_alternative").otherwise(F.col("method")).alias("extraction_method"),
        "section_page",
        "quality",
        "handwritten",
        detail.alias("status_detail"),
        error.alias("error"),
    )


def extract_enhanced(recognised: DataFrame) -> DataFrame:
    """Rows of all pages that were recognised with ``enhanced``, read as one text: doc_id, activities, extraction_method."""
    text = P.joined_text(recognised.where("error is null"))
    rows = F.filter(F.transform(R.parse_section(F.col("text")), lambda e: R.pair(e["activity"], e["benefit"])), lambda a: (a["activity"] != "") | (a["benefit"] != ""))
    return text.select("doc_id", rows.alias("activities"), F.lit("ocr_enhanced").alias("extraction_method"))


def pages_to_recognise(pages: DataFrame, docs: DataFrame | None = None, o: Options = DEFAULT) -> DataFrame:
    """(doc_id, page_num) of the image pages that recognition reads: the usual places of a scan, a hybrid's last image pages."""
    kinds = P.classify(pages, docs, o.page_chars)
    read = P.pages_to_read(F.col("document_type"), F.lit(None).cast("int"), P.guess_pages(F.col("page_count"), o), F.col("image_pages"), o)
    return kinds.where("document_type <> 'electronic'").select("doc_id", F.explode(read).alias("page_num"))


def structure(extracted: DataFrame, classified: DataFrame, o: Options = DEFAULT, extracted_at: str | None = None) -> DataFrame:
    """Result documents (see ``sources.results.schema``), one for each classified document, and status_detail."""
    d = classified.join(extracted, "doc_id", "left")
    for name, kind in (("section_page", "int"), ("quality", "string"), ("status_detail", "string"), ("error", "string"), ("traceback", "string"), ("confidence", "string"), ("form_pages", "array<int>"), ("pages_searched", "array<int>"), ("processing_time", "double")):
        if name not in d.columns:
            d = d.withColumn(name, F.lit(None).cast(kind))
    name = IO.parse_file_name(F.col("doc_id").cast("string"), o)
    acts = F.coalesce(F.transform("activities", lambda a: F.struct(a["activity"].alias("activity"), a["benefit"].alias("description"))), F.array().cast("array<struct<activity:string,description:string>>"))
    meta = F.struct(
        F.col("doc_id").cast("string").alias("source_file"),
        F.col("section_page").cast("int").alias("cic36_page"),
        F.coalesce(F.col("form_pages").cast("array<int>"), F.array().cast("array<int>")).alias("cic36_pages_found"),
        F.coalesce("confidence", F.lit("low")).alias("location_confidence"),
        F.col("extraction_method"),
        F.coalesce(F.col("pages_searched").cast("array<int>"), F.array().cast("array<int>")).alias("pages_searched"),
        F.lit(extracted_at).cast("string").alias("extracted_at"),
        F.col("page_count").cast("int").alias("document_page_count"),
        F.col("avg_chars_per_page").cast("double").alias("avg_chars_per_page"),
        F.col("quality").alias("ocr_confidence"),
        F.col("error"),
        F.col("traceback"),
        F.col("processing_time").cast("double").alias("processing_time"),
    )
    text = lambda c: F.coalesce(c, F.lit(""))
    return d.select(
        name["company_number"].alias("company_number"),
        name["incorporation_date"].alias("incorporation_date"),
        "document_type",
        IO.status(F.size(acts) > 0, F.col("error")).alias("extraction_status"),
        F.struct(text("beneficiaries").alias("beneficiaries")).alias("section_a"),
        F.struct(acts.alias("activities"), text("company_differs").alias("company_differs"), text("surplus_use").alias("surplus_use")).alias("section_b"),
        meta.alias("extraction_metadata"),
        "status_detail",
    )


def run(pages: DataFrame, tables: DataFrame | None = None, words: DataFrame | None = None, docs: DataFrame | None = None, o: Options = DEFAULT, recognised: DataFrame | None = None, failures: DataFrame | None = None, extracted_at: str | None = None) -> DataFrame:
    """Page texts (doc_id, page_num, text) of any documents -> result documents.

    Documents with a text layer on every page go by tables and text; the others are read as recognised ones.
    recognised (doc_id, page_num, text, error) stands in for those pages' text layer, which alone
    says what kind a document is; a document of which no page could be recognised says so.  Where
    it has ``seconds`` too, their sum is the document's processing time.
    failures (doc_id, error, traceback): documents that couldn't be read, status ``error``, type ``unknown``.
    """
    classified = P.classify(pages, docs, o.page_chars)
    found = L.find_form_pages(pages).select("doc_id", "form_pages", "confidence", F.col("section_page").alias("located"))
    kinds = classified.select("doc_id", "document_type")
    electronic = pages.join(kinds.where("document_type = 'electronic'").select("doc_id"), "doc_id", "left_semi")
    others = pages.join(kinds.where("document_type <> 'electronic'").select("doc_id"), "doc_id", "left_semi")
    if recognised is not None:
        new = recognised.where("error is null").select("doc_id", "page_num", F.col("text").alias("new"))
        others = others.join(new, ["doc_id", "page_num"], "left").withColumn("text", F.coalesce("new", "text")).drop("new")
    by_text = extract_text(electronic, found.select("doc_id", F.col("located").alias("section_page")), tables)
    by_ocr = extract_recognised(others, words, o)
    if recognised is not None:
        failed = recognised.groupBy("doc_id").agg(F.min("error").alias("failure"), F.count("*").alias("n"), F.count("error").alias("failed")).where("failed = n")
        by_ocr = by_ocr.join(failed.select("doc_id", "failure"), "doc_id", "left")
        lost = F.col("failure").isNotNull() & (F.size("activities") == 0)
        told = F.when(lost, F.concat(F.lit("No page could be recognised: "), F.col("failure"))).otherwise(F.col("error"))
        by_ocr = by_ocr.withColumn("status_detail", F.when(lost, "not_recognised").otherwise(F.col("status_detail"))).withColumn("error", told).drop("failure")
        if "seconds" in recognised.columns:
            classified = classified.join(recognised.groupBy("doc_id").agg(F.sum("seconds").alias("processing_time")), "doc_id", "left")
    extracted = by_text.unionByName(by_ocr, allowMissingColumns=True).join(found, "doc_id", "left").withColumn("section_page", F.coalesce("section_page", "located"))
    if failures is not None:
        broken = failures.groupBy("doc_id").agg(F.min(F.struct("error", "traceback")).alias("broken"))
        classified = classified.join(broken, "doc_id", "left").withColumn("document_type", F.when(F.col("broken").isNotNull(), "unknown").otherwise(F.col("document_type")))
        classified = classified.withColumn("traceback", F.col("broken.traceback"))
        extracted = extracted.join(broken.withColumnRenamed("broken", "b"), "doc_id", "full").withColumn("error", F.coalesce("b.error", "error")).withColumn("status_detail", F.when(F.col("b").isNotNull(), "not_readable").otherwise(F.col("status_detail"))).drop("b")
    return structure(extracted, classified, o, extracted_at)


def run_one(pages: DataFrame, doc_id, **kw) -> DataFrame:
    """The same plan for one document, with its validation."""
    from ..operators.quality import validate_result

    return validate_result(run(pages.where(F.col("doc_id") == doc_id), **kw))
