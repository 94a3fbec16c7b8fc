"""Operators on hand-written rows: dialect edges, order, empty and odd inputs."""

import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from foliospark.functions import cleaning as C
from foliospark.functions import scores as S
from foliospark.functions import text as t
from foliospark.operators import locate as L
from foliospark.operators import metrics as M
from foliospark.operators import pages as P
from foliospark.operators import quality as Q
from foliospark.operators import reports as REP
from foliospark.operators import rows as R
from foliospark.operators import sampling as SA
from foliospark.operators import slices as X
from foliospark.options import Options
from foliospark.plans import evaluate as E
from foliospark.plans import extract, forms
from foliospark.sources import pdf
from foliospark.sources import results as IO
from foliospark.streaming import incremental


def one(spark, column, **values):
    """A column's value over one row of literals."""
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first().x


def each(spark, f, texts):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


ODD = [None, "", "   ", "  a b ", "a\x00b", "�", "|", "\U0001f600 b", "line\n", "c\rd"]


def test_white_space_is_unicode(spark):
    assert each(spark, lambda c: t.strip(t.text_of(c)), ODD)[:4] == ["", "", "", "a b"]
    assert each(spark, lambda c: t.collapse(t.text_of(c)), ["a \n b"]) == ["a b"]
    assert each(spark, lambda c: F.size(t.words(c)), ["  a b ", "", " "]) == [2, 0, 0]


def test_case_and_dot_follow_unicode(spark):
    assert each(spark, lambda c: t.matches(c, "é.b"), ["É\u0085b", "é\nb", "ÉXB"]) == [True, False, True]


def test_patterns_run_only_where_their_words_stand(spark):
    assert t.needed((r"to\s+enable\s+the\s+(?:CIC\s+)?Regulator", r"it\s+would\s+be\s+useful")) == ("regulator", "useful")
    assert t.needed((r"a?b*", "x")) is None and t.needed((r"\Qab\E",)) is None and t.needed(("[[ab]c]d",)) is None
    # Tried on this text, a pattern that repeats a group ends with a stack overflow.
    hard = [rf"(?:a|b)+\s+{w}" for w in ("regulator", "surplus", "company", "benefit")]
    assert each(spark, lambda c: F.length(t.remove_each(c, hard)), ["ab" * 200_000]) == [400_000]


def test_words_are_found_wherever_patterns_match(spark):
    chars = spark.range(1, 0x10000).where("not id between 55296 and 57343").select(F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("x"))
    for letter in "aiksz":
        lost = chars.where(t.matches(F.col("x"), letter) & ~t.possible(F.col("x"), [letter]))
        assert [r.x for r in lost.collect()] == []
    texts = ["See \u017furplu\u017f of the \u212aing", "NOTE \u0130t", "not\u0131n", "sur note plus k\u0131ng", None, "", "plain"]
    patterns = ["surplus", "king", r"note\s+it", r"notin", "x+y"] * 2
    plain = lambda c: reduce(lambda a, p: F.regexp_replace(a, t.rx(p), ""), patterns, c)
    assert each(spark, lambda c: t.remove_each(c, patterns), texts) == each(spark, plain, texts)


def test_slices_by_match_with_wide_characters(spark):
    assert each(spark, lambda c: t.before(c, "b"), ["\U0001f600b x", "no"]) == ["\U0001f600", "no"]
    assert each(spark, lambda c: t.after(c, "b"), ["\U0001f600b x", "no"]) == [" x", None]


def test_two_rules_for_ends_differ(spark):
    text = ["start one END2 two END1 three"]
    assert each(spark, lambda c: t.until_first_listed(c, ["END1", "END2"]), text) == ["start one END2 two "]
    assert each(spark, lambda c: t.until_nearest(c, ["END1", "END2"]), text) == ["start one "]


def test_an_empty_slice_passes_on_only_if_asked(spark):
    f = lambda skip: lambda c: t.first_slice(c, ["A:", "B:"], lambda x: t.until_nearest(x, ["!"]), t.strip, skip)
    assert each(spark, f(True), ["A: ! B: yes!"]) == ["yes"]
    assert each(spark, f(False), ["A: ! B: yes!"]) == [""]


def test_fields_of_text_documents(spark):
    text = "Our company differs from a general commercial company because we care. If the company makes any surplus it will be used for training. SECTION C"
    assert each(spark, X.surplus_use, [text, None, "nothing"]) == ["training.", "", ""]
    assert each(spark, X.company_differs, [text]) == ["we care."]
    assert each(spark, X.beneficiaries, ["The company's activities will provide benefit to: local people\nof Kent Page 3 of 9\nSECTION B"]) == ["local people of Kent"]


def test_surplus_of_recognised_documents_is_capped_at_a_sentence(spark):
    long = "If the company makes any surplus it will be used for ... " + "good work. " * 60
    got = each(spark, X.ocr_surplus_use, [long])[0]
    assert len(got) <= 300 and got.endswith("work.")
    assert len(each(spark, X.ocr_surplus_use, ["surplus it will be used for " + "x" * 500])[0]) == 500


def test_cells_and_headers(spark):
    assert each(spark, C.clean_cell, [None, "  a \n b ", "x\x00##|y"]) == ["", "a b", "x|y"]
    assert each(spark, C.is_header_or_instruction, ["", "Activities", "Community dance classes", "see guidance notes", "Real text"]) == [True, True, False, True, False]
    assert each(spark, lambda c: C.is_header_or_instruction(c, loose=True), ["Community dance classes"]) == [True]
    assert each(spark, C.is_form_instruction, ["", "Please describe it", "text"]) == [False, True, False]
    assert each(spark, C.special_ratio, ["", "ab##"]) == [0.0, 0.5]


def test_scores(spark):
    lens = [0, 19, 20, 49, 50]
    assert each(spark, lambda c: S.completeness(c, F.lit("y" * 60)), ["x" * n for n in lens]) == [50, 70, 90, 90, 100]
    assert each(spark, lambda c: S.noise(c, F.lit("")), ["plain", "a|b plain text here", "a\x00b plain text here"]) == [100, 85, 70]
    assert each(spark, lambda c: S.quality_label(F.length(c)), ["x" * n for n in (49, 50, 70, 90)]) == ["poor", "fair", "good", "excellent"]
    v = one(spark, S.validate_pair(F.col("a"), F.col("b")), a="short", b="")
    assert not v.is_valid and v.issues[0] == "Activity too short (5 chars, min 20)" and v.issues[-1] == "Benefit is empty"


def test_error_categories(spark):
    kind = "array<struct<activity:string,benefit:string>>"
    rows = [(None, []), ("boom", [("a", "b")]), (None, [("see Section A here.", "ok.")]), (None, [("a ## b.", "x.")]), (None, [("this is cut off by", "ok.")]), (None, [("only this.", "")]), (None, [("fine.", "fine too.")])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, e string, a {kind}")
    got = [r.x for r in df.select("i", S.error_category(F.col("e"), F.col("a")).alias("x")).orderBy("i").collect()]
    assert got == ["missing_data", "processing_error", "wrong_section", "ocr_errors", "truncated", "partial_extraction", "success"]


def test_page_windows(spark):
    def guess(n):
        out = list(range(1, min(15, n) + 1)) + (list(range(35, min(65, n) + 1)) if n > 30 else []) + list(range(max(1, n - 30), n + 1))
        return list(dict.fromkeys(out))

    rows = spark.range(0, 90).select("id", P.guess_pages(F.col("id")).alias("g")).collect()
    assert all(r.g == (guess(r.id) if r.id else []) for r in rows)
    assert one(spark, P.near_pages(F.col("p"), F.col("n")), p=1, n=2) == [1, 2]


def pages(spark, *texts):
    return spark.createDataFrame([("d", i, x) for i, x in enumerate(texts, 1)], "doc_id string, page_num int, text string")


def test_section_span(spark):
    p = pages(spark, "Form CIC 36", "x", "SECTION B: Community Interest Statement - Activities & Related Benefit", "more", "Any surplus will be used", "after")
    starts = L.form_start(p)
    assert starts.first().start_page == 1
    assert [r.page_num for r in L.section_span(p, starts).orderBy("page_num").collect()] == [3, 4, 5]
    alone = pages(spark, "SECTION B: x. If the company makes any surplus", "next")
    assert [r.page_num for r in L.section_span(alone).collect()] == [1]
    far = pages(spark, "SECTION B.", *["more"] * 9)
    assert [r.page_num for r in L.section_span(far).orderBy("page_num").collect()] == [1, 2, 3, 4, 5, 6]
    assert L.section_span(pages(spark, "nothing")).count() == 0


def test_form_pages(spark):
    r = L.find_form_pages(pages(spark, "Activities & Related Benefit", "CIC 36", "Section B: Activities and Related Benefit")).first()
    assert (r.form_pages, r.candidates, r.section_page, r.section_tier, r.confidence) == ([2], [1, 3], 3, "high", "high")
    r = L.find_form_pages(pages(spark, *["x"] * 14)).first()
    assert r.confidence == "low" and r.suggested_pages == list(range(4, 15))


def pairs(rows):
    return [(r.activity, r.benefit) for r in rows]


def test_rows_of_tables(spark):
    df = spark.createDataFrame([([["Activities", "How will the activity benefit"], ["Dance", "Joy"], ["", "lost"], ["one"], ["Activities", "x"]],), ([["a", "b"]],), (None,)], "t array<array<string>>")
    got = [r.x for r in df.select(R.parse_table(F.col("t")).alias("x")).collect()]
    assert pairs(got[0]) == [("Dance", "Joy")] and got[1] == [] and not got[2]
    v = df.select(R.validate_table(F.col("t")).alias("v")).first().v
    assert v.is_valid and v.confidence == "high" and v.row_count == 4


def test_row_splitters(spark):
    text = "Intro words that are long enough\n1. First activity that is long enough to keep\n2) Second activity that is long enough too\n- Third thing that is also long enough"
    assert len(each(spark, R.by_delimiters, [text])[0]) == 4
    assert len(each(spark, R.by_delimiters, ["first paragraph that is long enough here\n\nsecond paragraph that is long enough here"])[0]) == 2
    d = each(spark, R.describe, ["We teach. This will help all", "One. Two. Three", "no stop"])
    assert [(x.activity, x.benefit) for x in d] == [("We teach.", "all"), ("One.", "Two.  Three"), ("no stop", "")]
    halves = each(spark, R.two_halves, ["line number one\nline number two\nline number three", "", "short"])
    assert pairs(halves[0]) == [("line number one", "line number two line number three")] and halves[1:] == [[], []]
    routed = each(spark, R.route_lines, ["left | right | more\nWe run clubs The community will benefit by joy\nimprove things\nplain words"])[0]
    assert [(x.left, x.right) for x in routed] == [("left", "right | more"), ("We run clubs", "The community will benefit by joy"), (None, "improve things"), ("plain words", None)]


def test_dedupe_keeps_order_and_is_idempotent(spark):
    r = random.Random(1)
    kind = "array<struct<activity:string,benefit:string>>"
    rows = [[(r.choice(["a", "A", "b", "", None]), r.choice(["x", "", None])) for _ in range(r.randrange(9))] for _ in range(60)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], f"i int, a {kind}")
    once = df.withColumn("a", R.dedupe(F.col("a")))
    for got, x in zip(once.orderBy("i").collect(), rows, strict=True):
        seen, want = set(), []
        for a, b in x:
            k = ((a or "").lower(), (b or "").lower())
            if k not in seen and any(k):
                seen.add(k)
                want.append((a, b))
        assert pairs(got.a) == want
    assert once.withColumn("b", R.dedupe(F.col("a"))).where("not (a <=> b)").count() == 0


def test_lines_of_words_use_the_lines_first_word(spark):
    words = [("b", 50, 12, 5, 5), ("a", 0, 0, 5, 5), ("c", 0, 16, 5, 5), ("d", 9, 30, 5, 5)]
    df = spark.createDataFrame([(words,), ([],)], f"w array<{R.WORD}>")
    assert [r.x for r in df.select(R.lines_of_words(F.col("w")).alias("x")).collect()] == ["a b\nc d", ""]


def test_allocation_by_the_greedy_rule(spark):
    r = random.Random(2)
    for _ in range(6):
        sizes = {f"g{i}": r.randrange(1, 200) for i in range(r.randrange(1, 7))}
        size, least = r.randrange(1, 120), r.randrange(0, 4)
        n = sum(sizes.values())
        want = {k: min(v, max(least, int(v / n * size))) for k, v in sizes.items()}
        left = size - sum(want.values())
        for k in sorted(sizes, key=lambda k: (-sizes[k], k)):
            if left > 0:
                add = min(sizes[k] - want[k], left)
                want[k], left = want[k] + add, left - add
        got = SA.allocation(spark.createDataFrame(list(sizes.items()), "stratum string, n long"), size, least).collect()
        assert {x.stratum: x.slots for x in got} == want


def test_exact_samples_do_not_depend_on_partitions(spark):
    df = spark.range(1000)
    a = SA.exact_sample(df, 37, ["id"], 5).collect()
    b = SA.exact_sample(df.repartition(13), 37, ["id"], 5).collect()
    assert len(a) == 37 and {x.id for x in a} == {x.id for x in b}
    assert SA.percent_sample(df, 0.01, ["id"]).count() == 1 and SA.percent_sample(df, 100, ["id"]).count() == 1000


@pytest.mark.parametrize("n", [1, 2, 3, 19, 20, 21, 1000, 5003])
def test_ranked_value(spark, n):
    r = random.Random(n)
    v = [float(r.randrange(n)) for _ in range(n)]
    got = M.ranked_value(spark.createDataFrame([(x,) for x in v] + [(None,)], "v double"), "v").first().ranked
    assert got == sorted(v)[min(int(n * 0.95), n - 1)]


def test_metrics_of_no_rows(spark):
    none = spark.createDataFrame([], IO.schema())
    m = REP.collect_metrics(none)
    assert m["documents"]["total"] == 0 and m["quality"]["flagged_count"] == 0 and m["times"]["p95"] == 0
    assert "Flagged for review: 0" in REP.summary(m) and REP.as_json(m)


def result(i, kind="scanned", status="success", acts=(("We run dance classes for everyone in the town hall.", "People meet and keep fit in good company all year."),), time=1.0):
    return (f"{i:08d}", None, kind, status, ("x",), ([tuple(a) for a in acts], "", ""), (f"{i:08d}.pdf", None, [], "low", "ocr", [], None, 3, 10.0, None, None if status == "success" else "failed", None, time))


def test_results_round_trip_and_reports(spark, tmp_path):
    rows = [result(1), result(2, "hybrid"), result(3, "unknown", "error", (), None)]
    df = spark.createDataFrame(rows, IO.schema())
    IO.write_results(df, str(tmp_path / "run"))
    back = IO.read_results(spark, str(tmp_path / "run"))
    assert sorted(map(str, back.drop("file_name").collect())) == sorted(map(str, df.collect()))
    IO.write_results(df, str(tmp_path / "pretty"), pretty=True)
    IO.write_failed(df, str(tmp_path / "failed"))
    assert [r.value for r in spark.read.text(str(tmp_path / "failed")).collect()] == ["00000003.pdf"]
    m = REP.collect_metrics(df)
    assert m["success_rate"] == 0.6667 and m["quality"]["excellent"] == 2 and m["errors"] == {"success": 2, "processing_error": 1}
    assert REP.decide(m, m) == "similar" and "Results are similar" in REP.comparison(m, m)
    assert any("Low success rate" in x for x in REP.recommendations(m))
    assert E.report(df, str(tmp_path / "r.md")).startswith("# Document extraction report")
    sheet = E.sample(df, str(tmp_path / "sheet"), 3)
    assert sheet.count() == 3 and IO.read_worksheet(spark, str(tmp_path / "sheet")).count() == 3
    v = {r.company_number: r.validation for r in Q.validate_result(df).collect()}
    assert v["00000001"].valid and v["00000003"].valid


def test_bad_result_files_are_skipped(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"company_number": "1", "document_type": "scanned"}')
    (tmp_path / "b.json").write_text("{bad")
    (tmp_path / "c.json").write_text('[{"company_number": "2"}, {"company_number": "3"}]')
    (tmp_path / "batch_summary.json").write_text('{"company_number": "9"}')
    assert sorted(r.company_number for r in IO.read_results(spark, str(tmp_path)).collect()) == ["1", "2", "3"]


def test_file_names(spark):
    got = each(spark, IO.parse_file_name, ["/x/12345678_newinc_2020-01-02.pdf", "SC509200.pdf", "1234567 old.PDF", "letter.v2.pdf", None])
    assert [tuple(g) for g in got[:4]] == [("12345678", "2020-01-02", "modern"), ("SC509200", None, "partial"), ("1234567", None, "partial"), (None, None, "legacy")]


SECTION = "SECTION B: Community Interest Statement - Activities & Related Benefit\nWe run a weekly dance class in the village hall for all ages.\nThe community will benefit by meeting people and keeping fit all year.\nIf the company makes any surplus it will be used for new equipment.\nSECTION C"


def test_extraction_of_recognised_documents(spark):
    p = pages(spark, "Form CIC 36 the company will benefit below local people in the town\nSECTION B", "", SECTION)
    r = extract.run(p).first()
    assert r.document_type == "hybrid" and r.extraction_status == "success" and r.extraction_metadata.cic36_page == 3
    assert "dance class" in r.section_b.activities[0].activity and r.section_b.surplus_use == "new equipment."
    r = extract.run(pages(spark, "x", "y")).first()
    assert r.extraction_status == "error" and r.status_detail == "no_form_found"


def test_extraction_of_text_documents(spark):
    filler = "These are plain words that make the page long enough to count as text. "
    body = "Section B: Activities and Related Benefit\nPainting for all\nSection C " + filler
    p = pages(spark, "Form CIC 36 " + filler, body)
    r = extract.run(p).first()
    assert r.document_type == "electronic" and r.extraction_metadata.extraction_method == "text_fallback" and r.section_b.activities[0].activity == "Painting for all"
    tables = spark.createDataFrame([("d", 2, k, 0, [["Activities", "Benefit to community"], [x, "Joy"], [x, "joy"]]) for k, x in ((0, "Dance"), (1, "Other"))], pdf.TABLES)
    r = extract.run_one(p, "d", tables=tables).first()
    assert [tuple(a) for a in r.section_b.activities] == [("Dance", "Joy")] and r.extraction_metadata.extraction_method == "table" and not r.validation.valid
    both = extract.run(p, docs=spark.createDataFrame([("d",), ("empty",)], "doc_id string"))
    assert {x.extraction_metadata.source_file: x.extraction_status for x in both.collect()} == {"d": "success", "empty": "no_data"}


def test_forms_are_dealt_over_tasks(spark):
    docs = forms.documents(spark.range(600, numPartitions=1).select(F.col("id").alias("c_custkey"), F.lit("A").alias("c_mktsegment")))
    sizes = [r["count"] for r in docs.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 600 and len(sizes) > 1 and max(sizes) < 300


def test_sections_are_parsed_once(spark):
    pages = spark.createDataFrame([("d", 1, "Form CIC 36"), ("d", 2, "SECTION B: Company Activities please see attached appendix")], "doc_id string, page_num int, text string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = extract.extract_recognised(pages)._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    of_parser = [line for line in plan if "hashpartitioning(xxhash64(" in line]
    assert len(of_parser) == 2 and sum("ReusedExchange" in line for line in of_parser) == 1


def test_layout_of_words(spark):
    rows = [("d", 1, 1000, f"w{i}", (i % 2) * 600, i // 2 * 30, 50, 10, 90, 0, 0) for i in range(8)] + [("d", 1, 1000, "noise", 0, 0, 9, 9, 5, 0, 0)]
    r = R.layout(spark.createDataFrame(rows, pdf.LAYOUT_WORDS)).first()
    assert r.has_two_columns and r.left == "w0\nw2\nw4\nw6" and r.right == "w1\nw3\nw5\nw7" and r.linear_text == "w0 w1 w2 w3 w4 w5 w6 w7"


def test_adapters_without_libraries(spark, tmp_path):
    assert set(pdf.capabilities()) >= {"available", "tesseract"}
    assert pdf.executor_capabilities(spark).count() == 1
    (tmp_path / "a.pdf").write_bytes(b"not a pdf")
    (tmp_path / "b.PDF").write_bytes(b"x")
    (tmp_path / "c.txt").write_bytes(b"x")
    files = pdf.scan_folder(spark, str(tmp_path))
    assert files.count() == 2 and all(r.error for r in pdf.page_texts(files).collect())
    assert pdf.best_text(lambda dpi: {200: "x", 150: "", 250: "longer", 300: "longest"}[dpi]) == "longer"
    (tmp_path / "none").mkdir()
    assert E.batch(spark, str(tmp_path / "none"), str(tmp_path))["total"] == 0


def test_streaming_resumes(spark, tmp_path):
    docs = lambda a, b: spark.range(a, b).selectExpr("cast(id as string) doc_id", "array(named_struct('page_num', 1, 'text', repeat('x', int(id) * 30))) pages")
    docs(0, 3).write.parquet(str(tmp_path / "in"))
    run = lambda: incremental.start(incremental.read(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    run()
    docs(3, 5).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert spark.read.parquet(str(tmp_path / "out/results")).count() == 5
    assert {r.document_type: r.documents for r in spark.read.parquet(str(tmp_path / "out/summary")).collect()} == {"scanned": 2, "electronic": 3}


def test_scores_do_not_depend_on_partitions(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", S.noise(F.col("text"), F.lit("")).alias("n"), S.ocr_quality(F.col("text")).alias("q"))
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, docs.repartition(7).collect()))


FAKES = {
    "pdf2image": """
class Image:
    def __init__(self, text, dpi):
        self.text, self.dpi, self.width = text, dpi, 1000
    def convert(self, mode):
        return self

def convert_from_bytes(content, first_page, last_page, dpi):
    return [Image(content.decode().split("|")[first_page - 1], dpi)]
""",
    "pytesseract": """
class Output:
    DICT = "dict"

def image_to_string(image, config=""):
    if image.text == "broken":
        raise ValueError("no page")
    return f"{image.text} {image.dpi} {config}" if image.text.startswith("plain") else image.text

def image_to_data(image, config, output_type):
    assert config == "--psm 6" and output_type == "dict"
    words = image.text.split()
    n = range(len(words))
    return {"text": words + [" "], "left": [0 for _ in n] + [0], "top": [20 * i for i in n] + [0], "width": [50 for _ in n] + [0], "height": [9 for _ in n] + [0], "conf": ["91.5" for _ in n] + ["-1"], "line_num": list(n) + [0], "block_num": [0 for _ in n] + [0]}
""",
}


def test_batch_recognises_scans(spark, tmp_path, monkeypatch):
    for name, code in FAKES.items():
        (tmp_path / f"{name}.py").write_text(code)
        spark.sparkContext.addPyFile(str(tmp_path / f"{name}.py"))
    scan = ["Form CIC 36 the company will benefit below local people in the town\nSECTION B", "broken", SECTION]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/00000001.pdf").write_text("|".join(scan))
    (tmp_path / "in/00000002.pdf").write_text("broken|broken")
    # No page has a text layer.
    layer = [("00000001.pdf", n, "", None) for n in (1, 2, 3)] + [("00000002.pdf", n, "", None) for n in (1, 2)] + [("00000003.pdf", None, "", "SyntaxError: no PDF")]
    (tmp_path / "in/00000003.pdf").write_text("x")
    monkeypatch.setattr(E.PDF, "page_texts", lambda files: spark.createDataFrame(layer, pdf.PAGES))
    monkeypatch.setattr(E.PDF, "capabilities", lambda: {"pdf_text": False})
    assert E.batch(spark, str(tmp_path / "in"), str(tmp_path / "out"), dated=False)["success"] == 1
    rows = {r.company_number: r for r in spark.read.parquet(str(tmp_path / "out/results")).collect()}
    good, bad = rows["00000001"], rows["00000002"]
    assert good.document_type == bad.document_type == "scanned" and good.extraction_metadata.cic36_page == 3
    assert "dance class" in good.section_b.activities[0].activity and good.extraction_metadata.extraction_method == "ocr"
    assert bad.status_detail == "not_recognised" and "no page" in bad.extraction_metadata.error
    lost = rows["00000003"]
    assert (lost.document_type, lost.extraction_status, lost.status_detail, lost.extraction_metadata.error) == ("unknown", "error", "not_readable", "SyntaxError: no PDF")
    assert all(r.extraction_metadata.extracted_at for r in rows.values())
    assert good.extraction_metadata.processing_time > 0 and bad.extraction_metadata.processing_time > 0 and lost.extraction_metadata.processing_time is None
    words = spark.read.parquet(str(tmp_path / "out/words"))
    assert words.columns == [x.split()[0] for x in pdf.LAYOUT_WORDS.split(", ")]
    assert words.where("doc_id = '00000001.pdf' and page_num = 1").count() == len(scan[0].split()) and {r.conf for r in words.collect()} == {91}
    files = spark.createDataFrame([("d", b"plain")], "doc_id string, content binary")
    one = spark.createDataFrame([("d", 1)], "doc_id string, page_num int")
    assert pdf.recognise(files, one, enhanced=True).first().text == "plain 400 --oem 3 --psm 6"
    whole = spark.createDataFrame([("e", 2, "Benefit to community SECTION C", None), ("e", 1, SECTION.removesuffix("\nSECTION C"), None)], pdf.PAGES)
    r = extract.extract_enhanced(whole).first()
    assert r.extraction_method == "ocr_enhanced" and "dance class" in r.activities[0].activity


def test_sampled_files_are_copied(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.pdf").write_text("a")
    rows = spark.createDataFrame([(("a.pdf",),), (("a.pdf",),), (("gone.pdf",),), ((None,),)], "extraction_metadata struct<source_file:string>")
    assert E.copy_sample(rows, str(tmp_path / "in"), str(tmp_path / "out")) == [None, "gone.pdf"]
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["a.pdf"]
    assert E.copy_sample(rows.where("false"), str(tmp_path / "in"), str(tmp_path / "none")) == []


def test_options_are_frozen():
    with pytest.raises(Exception):
        Options().page_chars = 3
