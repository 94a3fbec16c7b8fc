"""The registered queries over the shared tables, each with the SQL that says the same.

The tables have none of the form's vocabulary, so queries pass pattern sets of their own to the
operators.  Conversations stand for documents (a turn is a page), first and other lines of
documents for activities and benefits, cells between bars for tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions import patterns as PT
from ..functions import scores as S
from ..functions import text as t
from ..operators import locate as L
from ..operators import metrics as M
from ..operators import pages as P
from ..operators import quality as Q
from ..operators import rows as R
from ..operators import sampling as SA
from ..operators import slices as X
from ..options import Options
from ..sources import results as IO
from ..streaming import incremental
from . import extract, forms

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

PAGE_CHARS = 200


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def conversation_pages(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).cast("int").alias("page_num"), "text")


def lines(spark: SparkSession, d: str) -> DataFrame:
    """documents with activity (first line) and benefit (the rest)."""
    first = F.get(F.split("text", "\n", 2), F.lit(0))
    rest = F.coalesce(F.get(F.split("text", "\n", 2), F.lit(1)), F.lit(""))
    return read(spark, d, "documents").select("doc_id", "lang", "source", "text", first.alias("activity"), rest.alias("benefit"))


def cell_tables(spark: SparkSession, d: str) -> DataFrame:
    """documents with bars, as tables: a row a line, a cell between bars."""
    rows = F.transform(F.split("text", "\n"), lambda x: F.split(x, r"\|"))
    return read(spark, d, "documents").where(F.col("text").contains("|")).select("doc_id", rows.alias("cells"))


# ---------------------------------------------------------------- parts of SQL


def q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def sql_match(x: str, pattern: str, flags: str = "i") -> str:
    return f"regexp_matches({x}, {q(f'(?{flags})' + pattern if flags else pattern)})"


def sql_any(x: str, patterns) -> str:
    return "(" + " OR ".join(sql_match(x, p) for p in patterns) + ")"


def sql_count(x: str, patterns) -> str:
    return "(" + " + ".join(f"{sql_match(x, p)}::INT" for p in patterns) + ")"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def sql_collapse(x: str) -> str:
    return f"regexp_replace({x}, '\\s+', ' ', 'g')"


def sql_drop(x: str, literals) -> str:
    for a in literals:
        x = f"replace({x}, {'chr(0)' if a == chr(0) else q(a)}, '')"
    return x


def sql_remove(x: str, patterns, flags: str = "i") -> str:
    for p in patterns:
        x = f"regexp_replace({x}, {q(f'(?{flags})' + p if flags else p)}, '', 'g')"
    return x


def sql_words(x: str) -> str:
    return f"regexp_extract_all({x}, '[^\\s]+')"


def sql_has(x: str, literals) -> str:
    return "(" + " OR ".join(f"contains({x}, {'chr(0)' if a == chr(0) else q(a)})" for a in literals) + ")"


SQL_PAGES = "pages_ AS (SELECT conv_id AS doc_id, (turn + 1)::INT AS page_num, text FROM conversations)"
SQL_LINES = "lines_ AS (SELECT doc_id, lang, source, text, split_part(text, chr(10), 1) AS activity, CASE WHEN contains(text, chr(10)) THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS benefit FROM documents)"
SQL_TABLES = "tables_ AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: string_split(x, '|')) AS cells FROM documents WHERE contains(text, '|'))"
SQL_SPECIAL = r"(length(x) - length(regexp_replace(x, '[^\p{L}\p{N} .,;:!?()\-''\"]', '', 'g')))"


def sql_special(x: str) -> str:
    gone = f"length(regexp_replace({x}, {q(chr(91) + chr(92) + 'p{L}' + chr(92) + 'p{N} .,;:!?()' + chr(92) + '-' + chr(39) + chr(34) + chr(93))}, '', 'g'))"
    return f"(CASE WHEN length({x}) = 0 THEN 0.0::DOUBLE ELSE {gone}::DOUBLE / length({x}) END)"


def word_edge(w: str) -> str:
    """A whole word in a dialect whose \\b knows ASCII only."""
    return rf"(^|[^\p{{L}}\p{{M}}\p{{N}}_]){w}($|[^\p{{L}}\p{{M}}\p{{N}}_])"


# ---------------------------------------------------------------- pages


@query(f"WITH {SQL_PAGES} SELECT doc_id, page_num, length({sql_strip('text')})::INT AS char_count, CASE WHEN length({sql_strip('text')}) >= {PAGE_CHARS} THEN 'electronic' ELSE 'image' END AS kind FROM pages_")
def page_kind(spark, d):
    return P.page_kinds(conversation_pages(spark, d), PAGE_CHARS).drop("text")


SQL_TYPES = f"""kinds AS (SELECT doc_id, page_num, length({sql_strip("text")}) AS n FROM pages_),
types_ AS (SELECT doc_id, count(*) AS page_count, sum(n)::BIGINT AS total_chars, count(*) FILTER (n >= {PAGE_CHARS}) AS e, count(*) FILTER (n < {PAGE_CHARS}) AS i,
  coalesce(string_agg(page_num::VARCHAR, ',' ORDER BY page_num) FILTER (n < {PAGE_CHARS}), '') AS image_pages FROM kinds GROUP BY doc_id),
typed AS (SELECT *, CASE WHEN i = 0 THEN 'electronic' WHEN e = 0 THEN 'scanned' ELSE 'hybrid' END AS document_type FROM types_)"""


@query(f"WITH {SQL_PAGES}, {SQL_TYPES} SELECT doc_id, page_count, total_chars, total_chars::DOUBLE / page_count AS mean_chars, image_pages, document_type FROM typed")
def doc_type_rollup(spark, d):
    out = P.classify(conversation_pages(spark, d), min_chars=PAGE_CHARS)
    return out.select("doc_id", "page_count", "total_chars", (F.col("total_chars") / F.col("page_count")).alias("mean_chars"), F.array_join("image_pages", ",").alias("image_pages"), "document_type")


@query(f"WITH {SQL_PAGES}, {SQL_TYPES} SELECT document_type, count(*) AS documents FROM typed GROUP BY document_type")
def status_counts_by_type(spark, d):
    return M.counts(P.classify(conversation_pages(spark, d), min_chars=PAGE_CHARS), "document_type")


@query(f"WITH {SQL_PAGES}, {SQL_TYPES}, w AS (SELECT c.c_custkey AS doc_id, t.doc_id AS has, coalesce(t.page_count, 0) AS page_count, coalesce(t.document_type, 'electronic') AS document_type FROM customer c LEFT JOIN typed t ON c.c_custkey = t.doc_id) SELECT doc_id, page_count, document_type FROM w")
def doc_type_of_empty(spark, d):
    docs = read(spark, d, "customer").select(F.col("c_custkey").alias("doc_id"))
    return P.classify(conversation_pages(spark, d), docs, PAGE_CHARS).select("doc_id", "page_count", "document_type")


def _sizes(spark):
    return spark.range(0, 80).select(F.col("id").cast("int").alias("n"))


@query(
    """WITH s AS (SELECT n::INT AS n FROM generate_series(0, 79) g(n)),
r AS (SELECT n, list_distinct_ordered AS x FROM (SELECT n, [p FOR p IN range(1, 80) IF p <= n AND p >= 1] AS all_,
 [p FOR p IN range(1, 80) IF p <= least(15, n)] || CASE WHEN n >= 35 THEN [p FOR p IN range(35, 66) IF p <= n AND p > 15] ELSE [] END || [p FOR p IN range(1, 80) IF p >= greatest(1, n - 30) AND p <= n AND p > 15 AND NOT (n >= 35 AND p BETWEEN 35 AND 65)] AS list_distinct_ordered FROM s))
SELECT n, array_to_string(x, ',') AS guessed FROM r"""
)
def page_window_guess(spark, d):
    return _sizes(spark).select("n", F.array_join(P.guess_pages(F.col("n")), ",").alias("guessed"))


@query(
    f"""WITH {SQL_PAGES}, x AS (SELECT doc_id, page_num, max(page_num) OVER (PARTITION BY doc_id) AS n FROM pages_)
SELECT doc_id, page_num, array_to_string([p FOR p IN range(page_num - 1, page_num + 3) IF p BETWEEN 1 AND n], ',') AS near, array_to_string([p FOR p IN range(page_num - 2, page_num + 1) IF p BETWEEN 1 AND n], ',') AS section_a FROM x"""
)
def neighbour_pages(spark, d):
    pages = conversation_pages(spark, d)
    extent = pages.groupBy("doc_id").agg(F.max("page_num").alias("n"))
    p, n = F.col("page_num"), F.col("n")
    return pages.join(extent, "doc_id").select("doc_id", "page_num", F.array_join(P.near_pages(p, n), ",").alias("near"), F.array_join(P.section_a_pages(p, n), ",").alias("section_a"))


@query(
    f"""WITH {SQL_PAGES}, {SQL_TYPES}, im AS (SELECT doc_id, list(page_num ORDER BY page_num) FILTER (n < {PAGE_CHARS}) AS l FROM kinds GROUP BY doc_id)
SELECT doc_id, document_type, CASE document_type WHEN 'electronic' THEN '2' WHEN 'scanned' THEN '2,3' ELSE array_to_string(l[-3:], ',') END AS to_read FROM typed JOIN im USING (doc_id)"""
)
def pages_by_type(spark, d):
    """Which pages are read: hybrids' last three image pages here."""
    kinds = P.classify(conversation_pages(spark, d), min_chars=PAGE_CHARS)
    none = F.array().cast("array<int>")
    return kinds.select("doc_id", "document_type", F.array_join(P.pages_to_read(F.col("document_type"), F.lit(2), none, F.col("image_pages"), Options(last_pages=3)), ",").alias("to_read"))


@query(f"WITH {SQL_PAGES} SELECT a.doc_id, a.page_num, md5(a.text || CASE WHEN b.text IS NULL THEN '' ELSE chr(10) || b.text END) AS digest FROM pages_ a LEFT JOIN pages_ b ON a.doc_id = b.doc_id AND b.page_num = a.page_num + 1")
def next_page_concat(spark, d):
    return P.with_next_page(conversation_pages(spark, d)).select("doc_id", "page_num", F.md5(F.col("text_with_next").cast("binary")).alias("digest"))


@query(f"WITH {SQL_PAGES} SELECT doc_id, md5(string_agg('--- Page ' || page_num || ' ---' || chr(10) || text, chr(10) ORDER BY page_num)) AS digest FROM pages_ GROUP BY doc_id")
def marked_text(spark, d):
    return P.joined_text(conversation_pages(spark, d), mark=True).select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))


def _user_pages(spark, d):
    return read(spark, d, "conversations").where("role = 'user'").select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).cast("int").alias("page_num"))


@query(f"WITH {SQL_PAGES}, u AS (SELECT conv_id AS doc_id, turn + 1 AS page_num FROM conversations WHERE role = 'user') SELECT doc_id, page_num, length(text)::INT AS n FROM pages_ p WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.doc_id = p.doc_id AND u.page_num = p.page_num)")
def anti_pages(spark, d):
    return P.other_pages(conversation_pages(spark, d), _user_pages(spark, d)).select("doc_id", "page_num", F.length("text").alias("n"))


@query(f"WITH {SQL_PAGES}, u AS (SELECT DISTINCT conv_id AS doc_id, turn + 1 AS page_num FROM conversations WHERE role = 'user') SELECT doc_id, page_num, length(text)::INT AS n FROM pages_ JOIN u USING (doc_id, page_num)")
def chosen_pages(spark, d):
    return P.chosen_pages(conversation_pages(spark, d), _user_pages(spark, d)).select("doc_id", "page_num", F.length("text").alias("n"))


@query("SELECT o_orderpriority AS kind FROM orders UNION SELECT c_mktsegment FROM customer")
def union_of_kinds(spark, d):
    return read(spark, d, "orders").select(F.col("o_orderpriority").alias("kind")).unionByName(read(spark, d, "customer").select(F.col("c_mktsegment").alias("kind"))).distinct()


# ---------------------------------------------------------------- location

TIERS = ((r"(?:^|\s)when\s",), (r"(?:^|\s)from\s", r"\spour\s"), (r"\sand\s", r"\sund\s", r"\sde\s"))
CLOSING = (r"\sthis\s", r"\slos\s")
ENDS = (r"\sby\s", r"\sdans\s")
FORM_MARKS = (r"\sthat\s", r"\sist\s")
OUT_MARKS = (r"\swas\s",)


def sql_tier(x: str, tiers) -> str:
    return "CASE " + " ".join(f"WHEN {sql_any(x, p)} THEN {k}" for k, p in enumerate(tiers, 1)) + " END"


@query(f"WITH {SQL_PAGES}, f AS (SELECT doc_id, page_num, {sql_tier('text', TIERS)} AS tier FROM pages_), b AS (SELECT doc_id, min(tier) AS tier FROM f GROUP BY doc_id) SELECT b.doc_id, b.tier::INT AS tier, min(page_num)::INT AS page_num FROM b LEFT JOIN f ON f.doc_id = b.doc_id AND f.tier = b.tier GROUP BY b.doc_id, b.tier")
def tiered_header_page(spark, d):
    pages = conversation_pages(spark, d)
    flags = pages.select("doc_id", "page_num", L.tier(t.text_of(F.col("text")), TIERS).alias("tier"))
    return flags.groupBy("doc_id").agg(F.min(F.when(F.col("tier").isNotNull(), F.struct("tier", "page_num"))).alias("x")).select("doc_id", "x.tier", "x.page_num")


@query(
    f"""WITH {SQL_PAGES}, f AS (SELECT doc_id, page_num, {sql_tier("text", TIERS)} AS tier, {sql_any("text", CLOSING)} AS closes, {sql_any("text", [*CLOSING, *ENDS])} AS stops FROM pages_),
b AS (SELECT doc_id, min(tier) AS t FROM f GROUP BY doc_id HAVING min(tier) IS NOT NULL),
h AS (SELECT b.doc_id, t, min(page_num) AS header FROM b JOIN f ON f.doc_id = b.doc_id AND f.tier = t GROUP BY b.doc_id, t),
l AS (SELECT h.doc_id, t, header, bool_or(page_num = header AND closes) AS alone, min(page_num) FILTER (page_num > header AND (stops OR page_num > header + 4)) AS stop FROM h JOIN f USING (doc_id) GROUP BY h.doc_id, t, header)
SELECT l.doc_id, f.page_num, l.header AS header_page, l.t::INT AS header_tier FROM l JOIN f USING (doc_id) WHERE f.page_num >= header AND (f.page_num <= coalesce(CASE WHEN alone THEN header ELSE stop END, 1000000))"""
)
def stop_page_span(spark, d):
    return L.section_span(conversation_pages(spark, d), None, TIERS, CLOSING, ENDS)


@query(
    f"""WITH {SQL_PAGES}, s AS (SELECT doc_id, coalesce(min(page_num) FILTER ({sql_any("text", TIERS[0])}), min(page_num) FILTER ({sql_any("text", TIERS[1])} AND NOT {sql_any("text", OUT_MARKS)})) AS start_page FROM pages_ GROUP BY doc_id)
SELECT doc_id, start_page::INT AS start_page FROM s"""
)
def form_start(spark, d):
    return L.form_start(conversation_pages(spark, d), TIERS[0], TIERS[1], OUT_MARKS)


@query(
    f"""WITH {SQL_PAGES}, s AS (SELECT doc_id, min(page_num) FILTER ({sql_any("text", FORM_MARKS)}) AS start_page FROM pages_ GROUP BY doc_id),
f AS (SELECT p.doc_id, page_num, {sql_tier("text", TIERS)} AS tier FROM pages_ p JOIN s USING (doc_id) WHERE start_page IS NULL OR page_num BETWEEN start_page + 1 AND start_page + 6),
b AS (SELECT doc_id, min(tier) AS t FROM f GROUP BY doc_id HAVING min(tier) IS NOT NULL) SELECT b.doc_id, min(page_num)::INT AS header_page FROM b JOIN f ON f.doc_id = b.doc_id AND f.tier = t GROUP BY b.doc_id"""
)
def header_behind_start(spark, d):
    pages = conversation_pages(spark, d)
    starts = L.first_page(pages, FORM_MARKS, "start_page")
    return L.section_span(pages, starts, TIERS, CLOSING, ENDS).groupBy("doc_id").agg(F.min("header_page").alias("header_page"))


@query(
    f"""WITH {SQL_PAGES}, f AS (SELECT doc_id, page_num, {sql_any("text", FORM_MARKS)} AS form, {sql_any("text", OUT_MARKS)} AS out_, {sql_tier("text", TIERS)} AS tier FROM pages_),
g AS (SELECT doc_id, max(page_num) AS n, list(page_num ORDER BY page_num) FILTER (form) AS forms, list(page_num ORDER BY page_num) FILTER (tier IS NOT NULL AND NOT (form AND out_)) AS found FROM f GROUP BY doc_id),
c AS (SELECT *, coalesce([p FOR p IN found IF p >= forms[1]][1], found[1]) AS section_page FROM g)
SELECT doc_id, coalesce(array_to_string(forms, ','), '') AS form_pages, coalesce(array_to_string(found, ','), '') AS candidates, section_page::INT AS section_page,
CASE WHEN forms IS NOT NULL AND section_page IS NOT NULL THEN 'high' WHEN forms IS NOT NULL OR section_page IS NOT NULL THEN 'medium' ELSE 'low' END AS confidence FROM c"""
)
def form_pages(spark, d):
    out = L.find_form_pages(conversation_pages(spark, d), FORM_MARKS, TIERS, OUT_MARKS)
    return out.select("doc_id", F.array_join("form_pages", ",").alias("form_pages"), F.array_join("candidates", ",").alias("candidates"), "section_page", "confidence")


# ---------------------------------------------------------------- cleaning and tests

_SEVERAL = [a for a in PT.ARTIFACTS if len(a) > 1]


@query(f"SELECT doc_id, {sql_drop(sql_collapse(sql_strip('text')), [chr(0), *_SEVERAL])} AS clean FROM documents")
def clean_cell(spark, d):
    return read(spark, d, "documents").select("doc_id", C.clean_cell(F.col("text")).alias("clean"))


def _sql_fixed(x: str) -> str:
    for wrong, right in PT.FIXES:
        x = f"regexp_replace({x}, {q('(?i)' + wrong)}, {q(right)}, 'g')"
    return x


@query(f"SELECT doc_id, {_sql_fixed(sql_strip(sql_collapse(sql_drop('text', PT.ARTIFACTS))))} AS clean FROM documents")
def clean_text(spark, d):
    return read(spark, d, "documents").select("doc_id", C.clean_text(F.col("text")).alias("clean"))


@query(f"SELECT doc_id, {sql_special('text')} AS ratio, {sql_has('text', PT.ARTIFACTS)} AS has_artifacts FROM documents")
def special_ratio(spark, d):
    return read(spark, d, "documents").select("doc_id", C.special_ratio(F.col("text")).alias("ratio"), C.has_artifacts(F.col("text")).alias("has_artifacts"))


_DASH = [r"^\s*[-–—]\s*", r"\s*[-–—]\s*$"]


@query(
    f"""SELECT doc_id, {sql_strip(sql_remove(sql_remove("regexp_replace(regexp_replace(text, '[|¦]', ' ', 'g'), '\\s+', ' ', 'g')", _DASH, ""), [r"having\s+access\s+to\s+flexible.*$", r"\s+[\p{L}\p{M}\p{N}_]{1,3}\s*$"]))} AS activity,
{sql_strip("regexp_replace(regexp_replace(text, '[|¦]', ' ', 'g'), '\\s+', ' ', 'g')")} AS benefit, {sql_strip(sql_remove("regexp_replace(regexp_replace(text, '[|¦]', '', 'g'), '\\s+', ' ', 'g')", _DASH, ""))} AS entry FROM documents"""
)
def clean_fields(spark, d):
    x = F.col("text")
    return read(spark, d, "documents").select("doc_id", C.clean_activity(x).alias("activity"), C.clean_benefit(x).alias("benefit"), C.clean_entry(x).alias("entry"))


NON_CONTENT = (r"Released\s+under[^\n]*", r"\d{8}", r"^[\s\-_=]+$")


@query(f"SELECT doc_id, {sql_strip(sql_collapse(sql_remove('text', NON_CONTENT, 'im')))} AS content FROM documents")
def drop_non_content(spark, d):
    return read(spark, d, "documents").select("doc_id", C.drop_non_content(F.col("text"), NON_CONTENT).alias("content"))


HEADS = (r"the\s", r"die\s", r"section\s+[a-z]", r"\d+\.\s*$")
TOLD = (r"licen[sc]e", r"page\s+\d+\s+of", r"^if\s", r"^\d{8}$")
MARKS = ("released under", "copyright")
SHORT_STARTS = (r"^the\s", r"^le\s", r"^der\s")
INDICATORS = (r"licen[sc]ed?\s", r"\sunder\s", r"\srights\s", r"@")


@query(
    f"""WITH {SQL_LINES}, a AS (SELECT doc_id, activity AS x, {sql_strip("activity")} AS s, {sql_strip("lower(activity)")} AS low FROM lines_)
SELECT doc_id, (s = '' OR {sql_any("s", [f"^(?:{p})" for p in HEADS])} OR {sql_any("s", TOLD)}) AS header, (s <> '' AND ({sql_any("s", TOLD)} OR {sql_has("lower(s)", MARKS)})) AS instruction,
(length(x) < 20 OR {sql_any("low", SHORT_STARTS)} OR ({sql_count("low", INDICATORS)} >= 2 AND length(low) < 500) OR ({sql_count("low", INDICATORS)} >= 1 AND length(low) < 200)) AS only_instruction,
{sql_any("s", [f"^(?:{p})" for p in HEADS])} AS header_line, {sql_any("x", (r"xxx+", r"\[.*\]"))} AS placeholder FROM a"""
)
def line_tests(spark, d):
    x = F.col("activity")
    return lines(spark, d).select(
        "doc_id",
        C.is_header_or_instruction(x, headers=HEADS, instructions=TOLD).alias("header"),
        C.is_form_instruction(x, TOLD, MARKS).alias("instruction"),
        C.is_instruction_only(x, SHORT_STARTS, INDICATORS).alias("only_instruction"),
        C.is_header_line(x, HEADS).alias("header_line"),
        C.is_placeholder(x, (r"xxx+", r"\[.*\]")).alias("placeholder"),
    )


# ---------------------------------------------------------------- scores


def sql_pair_scores() -> str:
    pen = lambda n: f"(CASE WHEN {n} = 0 THEN 50 WHEN {n} < 20 THEN 30 WHEN {n} < 50 THEN 10 ELSE 0 END)"
    found = " + ".join(f"(CASE WHEN contains(b, {'chr(0)' if a == chr(0) else q(a)}) THEN {15 * PT.ARTIFACT_WEIGHT.get(a, 1)} ELSE 0 END)" for a in PT.ARTIFACTS)
    return f"""p AS (SELECT *, activity || ' ' || benefit AS b FROM lines_), w AS (SELECT *, {sql_words("b")} AS w, {sql_special("b")} AS sp FROM p),
scores_ AS (SELECT doc_id, activity, benefit, b, sp, greatest(0.0, 100.0 - {pen("length(" + sql_strip("activity") + ")")} - {pen("length(" + sql_strip("benefit") + ")")})::DOUBLE AS completeness,
greatest(0.0, 100.0 - 20 * {sql_count("b", PT.INSTRUCTIONS)} - (CASE WHEN len(w) < 5 THEN 30 WHEN len(w) < 10 THEN 15 ELSE 0 END) - (CASE WHEN len(w) > 5 AND len(list_distinct(w))::DOUBLE / len(w) < 0.3 THEN 20 ELSE 0 END))::DOUBLE AS coherence,
greatest(0.0, 100.0 - ({found}) - (CASE WHEN sp > 0.2 THEN 30 WHEN sp > 0.1 THEN 15 ELSE 0 END) - (CASE WHEN length(regexp_replace(b, '[\\x00-\\x7F]', '', 'g')) > length(b) * 0.1 THEN 20 ELSE 0 END))::DOUBLE AS noise FROM w)"""


def _scored(spark, d):
    a, b = F.col("activity"), F.col("benefit")
    return lines(spark, d).select("doc_id", S.completeness(a, b).alias("completeness"), S.coherence(a, b).alias("coherence"), S.noise(a, b).alias("noise"), "activity", "benefit")


@query(f"WITH {SQL_LINES}, {sql_pair_scores()} SELECT doc_id, completeness, coherence, noise, round(completeness * 0.4::DOUBLE + coherence * 0.35::DOUBLE + noise * 0.25::DOUBLE, 6) AS overall FROM scores_")
def pair_scores(spark, d):
    total = S.overall(F.col("completeness"), F.col("coherence"), F.col("noise"))
    return _scored(spark, d).select("doc_id", "completeness", "coherence", "noise", F.round(total, 6).alias("overall"))


@query(
    f"""WITH {SQL_LINES}, {sql_pair_scores()}, o AS (SELECT round(completeness * 0.4::DOUBLE + coherence * 0.35::DOUBLE + noise * 0.25::DOUBLE, 6) AS s FROM scores_)
SELECT CASE WHEN s >= 90 THEN 'excellent' WHEN s >= 70 THEN 'good' WHEN s >= 50 THEN 'fair' ELSE 'poor' END AS band, count(*) AS documents FROM o GROUP BY 1"""
)
def quality_bands(spark, d):
    total = F.round(S.overall(F.col("completeness"), F.col("coherence"), F.col("noise")), 6)
    return _scored(spark, d).select(S.quality_label(total).alias("band")).groupBy("band").agg(F.count("*").alias("documents"))


def _sql_cut(x: str) -> str:
    return f"({x} <> '' AND ({x} LIKE '%...' OR {x} LIKE '%-' OR (length({x}) > 10 AND NOT contains('.!?\"''', right({x}, 1)))))"


@query(
    f"""WITH {SQL_LINES}, p AS (SELECT doc_id, activity AS a, benefit AS b, activity || benefit AS ab FROM lines_)
SELECT doc_id, CASE WHEN {sql_has("lower(ab)", ("released under", "licensed under"))} THEN 'wrong_section' WHEN {sql_has("ab", PT.ARTIFACTS)} THEN 'ocr_errors' WHEN {_sql_cut("a")} OR {_sql_cut("b")} THEN 'truncated'
WHEN (a = '') <> (b = '') THEN 'partial_extraction' ELSE 'success' END AS category FROM p"""
)
def error_category(spark, d):
    acts = F.array(R.pair(F.col("activity"), F.col("benefit")))
    return lines(spark, d).select("doc_id", S.error_category(F.lit(None).cast("string"), acts, wrong=("released under", "licensed under")).alias("category"))


@query(
    f"""WITH {SQL_LINES}, p AS (SELECT doc_id, {sql_strip("activity")} AS a, {sql_strip("benefit")} AS b FROM lines_), c AS (SELECT *, a || ' ' || b AS ab FROM p),
i AS (SELECT doc_id, a, b, ((length(a) < 20)::INT + (length(b) < 20)::INT + {sql_has("ab", PT.ARTIFACTS)}::INT + {sql_count("a", PT.INSTRUCTIONS)} + {sql_count("b", PT.INSTRUCTIONS)} + {sql_any("ab", PT.PLACEHOLDERS)}::INT + ({sql_special("ab")} > 0.15)::INT + (a = '' OR b = '')::INT) AS n FROM c)
SELECT doc_id, n = 0 AS is_valid, n::INT AS issues, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1.0::DOUBLE - 0.15::DOUBLE * n + (CASE WHEN length(a) > 100 THEN 0.1 WHEN length(a) < 20 THEN -0.2 ELSE 0 END)::DOUBLE + (CASE WHEN length(b) > 100 THEN 0.1 WHEN length(b) < 20 THEN -0.2 ELSE 0 END)::DOUBLE)), 6) AS score FROM i"""
)
def pair_validation(spark, d):
    a, b = t.strip(F.col("activity")), t.strip(F.col("benefit"))
    out = lines(spark, d).select("doc_id", a.alias("a"), b.alias("b"), S.validate_pair(F.col("activity"), F.col("benefit")).alias("v"))
    return out.select("doc_id", "v.is_valid", F.size("v.issues").alias("issues"), F.round(S.pair_score(F.col("a"), F.col("b"), F.col("v.issues")), 6).alias("score"))


SQL_OCR = f"""x AS (SELECT doc_id, text, lower(text) AS low FROM documents), y AS (SELECT doc_id, text, low, length(regexp_replace(low, '[^aeiou]', '', 'g')) AS v, length(regexp_replace(low, '[^a-z]', '', 'g')) AS l,
{sql_count("low", [word_edge(w) for w in PT.COMMON_WORDS])} AS k, {sql_count("low", [word_edge(w) for w in PT.FORM_WORDS])} AS kf, len(regexp_extract_all(text, '[{{}}\\[\\]|\\\\<>~`^@#$%&*+=]'))::DOUBLE / greatest(length(text), 1) AS sp, len(regexp_extract_all(low, '[bcdfghjklmnpqrstvwxyz]{{6,}}')) AS r,
len(regexp_extract_all(low, '[bcdfghjklmnpqrstvwxyz]{{5,}}')) + len(regexp_extract_all(low, '[aeiou]{{4,}}')) + len(regexp_extract_all(low, '\\|{{2,}}')) AS odd, {sql_words("text")} AS w FROM x)"""


@query(
    f"""WITH {SQL_OCR} SELECT doc_id, CASE WHEN length({sql_strip("text")}) < 50 OR l = 0 THEN 'very_low' WHEN v::DOUBLE / l < 0.15 OR v::DOUBLE / l > 0.65 OR k < 3 OR sp > 0.1 OR r > 3 THEN 'very_low'
WHEN v::DOUBLE / l < 0.25 OR v::DOUBLE / l > 0.55 OR k < 6 OR sp > 0.05 OR r > 1 THEN 'low' WHEN k >= 10 THEN 'medium' ELSE 'low' END AS quality FROM y"""
)
def ocr_quality_band(spark, d):
    return read(spark, d, "documents").select("doc_id", S.ocr_quality(F.col("text")).alias("quality"))


@query(
    f"""WITH {SQL_OCR} SELECT doc_id, CASE WHEN length({sql_strip("text")}) < 50 OR len(w) = 0 THEN false ELSE (len(list_filter(w, lambda z: length(z) <= 2))::DOUBLE / len(w) > 0.4 AND kf < 5) OR (length(text) / 100.0 > 2 AND kf < length(text) / 100.0 * 0.3) OR odd > 5 END AS handwritten FROM y"""
)
def handwriting_flag(spark, d):
    return read(spark, d, "documents").select("doc_id", S.likely_handwritten(F.col("text")).alias("handwritten"))


# ---------------------------------------------------------------- slices

STARTS = (r"\swhen\s+", r"\sfrom\s+", r"\spour\s+")
STOPS = (r"\sby\s", r"\sthe\s", r"\n")


def sql_before(x: str, p: str) -> str:
    """What stands before the first match: the match and all behind it go."""
    return f"regexp_replace({x}, {q('(?is)' + p + '.*')}, '')"


def sql_after(x: str, p: str) -> str:
    return f"CASE WHEN {sql_match(x, p, 'is')} THEN regexp_replace({x}, {q('(?is)^.*?' + p)}, '') END"


def _sql_first_listed(x: str, ends) -> str:
    return "CASE " + " ".join(f"WHEN {sql_match(x, p)} THEN {sql_before(x, p)}" for p in ends) + f" ELSE {x} END"


def sql_slices(cut) -> str:
    rests = ", ".join(f"{sql_after('text', p)} AS r{i}" for i, p in enumerate(STARTS))
    return f"WITH r AS (SELECT doc_id, text, {rests} FROM documents) SELECT doc_id, coalesce({', '.join(f'nullif({cut(f"r{i}")}, {chr(39) * 2})' for i in range(len(STARTS)))}, '') AS part FROM r"


@query(sql_slices(lambda r: sql_strip(sql_collapse(_sql_first_listed(r, STOPS)))))
def slice_first_listed(spark, d):
    return read(spark, d, "documents").select("doc_id", X.company_differs(F.col("text"), STARTS, STOPS).alias("part"))


@query(sql_slices(lambda r: sql_strip(sql_collapse(sql_before(r, "(?:" + "|".join(STOPS) + ")")))))
def slice_nearest_end(spark, d):
    clean = lambda x: t.strip(t.collapse(x))
    return read(spark, d, "documents").select("doc_id", t.first_slice(F.col("text"), STARTS, lambda x: t.until_nearest(x, STOPS), clean, True).alias("part"))


@query(
    f"""WITH r AS (SELECT doc_id, coalesce({", ".join(sql_after("text", p) for p in STARTS)}) AS x FROM documents), c AS (SELECT doc_id, {sql_strip("coalesce(" + sql_before("x", chr(92) + "n") + ", '')")} AS x FROM r), e AS (SELECT doc_id, x, regexp_extract(left(x, 60), '(?s)^(.*[.!?])', 1) AS whole FROM c)
SELECT doc_id, CASE WHEN length(x) > 60 AND length(whole) > 11 THEN whole ELSE x END AS part FROM e"""
)
def slice_capped(spark, d):
    x = t.strip(F.coalesce(t.until_first_listed(t.after_first_listed(F.col("text"), STARTS), (r"\n",)), F.lit("")))
    return read(spark, d, "documents").select("doc_id", X.cap_at_sentence(x, 60, 10).alias("part"))


BOILER = (r"Released\s+under.*?\.", r"licensed\s+under[^.]*\.?", r"^\s*the\s", r"##+\s*", r"\s+\|\s+")


@query(
    f"""SELECT doc_id, {sql_strip("regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(" + sql_remove("text", BOILER, "is") + ", '" + chr(92) + "n" + chr(92) + "s*" + chr(92) + "n" + chr(92) + "s*" + chr(92) + "n+', chr(10) || chr(10), 'g'), '  +', ' ', 'g'), '(?m)^" + chr(92) + "s+', '', 'g'), '(?m)^" + chr(92) + "s*[(" + chr(92) + "[" + chr(92) + "])" + chr(92) + "s]+" + chr(92) + "s*$', '', 'g'), '(?m)^" + chr(92) + "s*" + chr(92) + "(" + chr(92) + "s*$', '', 'g')")} AS body FROM documents"""
)
def boilerplate_fold(spark, d):
    return read(spark, d, "documents").select("doc_id", X.strip_boilerplate(F.col("text"), BOILER).alias("body"))


# ---------------------------------------------------------------- rows

_TAIL = r"\s+[\p{L}\p{M}\p{N}_]{1,3}\s*$"


@query(
    f"""WITH l AS (SELECT doc_id, i, {sql_strip("x")} AS x FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
k AS (SELECT * FROM l WHERE length(x) >= 5),
m AS (SELECT doc_id, i, CASE WHEN contains(x, '|') THEN {sql_strip("split_part(x, '|', 1)")} WHEN {sql_match("x", "^.+?" + chr(92) + "s+with" + chr(92) + "s.*$")} THEN CASE WHEN length({sql_strip("regexp_extract(x, '(?i)^(.+?)" + chr(92) + "s+(with" + chr(92) + "s.*)$', 1)")}) > 5 THEN {sql_strip("regexp_extract(x, '(?i)^(.+?)" + chr(92) + "s+(with" + chr(92) + "s.*)$', 1)")} END WHEN {sql_match("x", "(the|der|la)")} THEN NULL ELSE x END AS l,
CASE WHEN contains(x, '|') THEN {sql_strip("substr(x, strpos(x, '|') + 1)")} WHEN {sql_match("x", "^.+?" + chr(92) + "s+with" + chr(92) + "s.*$")} THEN CASE WHEN length({sql_strip("regexp_extract(x, '(?i)^(.+?)" + chr(92) + "s+(with" + chr(92) + "s.*)$', 2)")}) > 5 THEN {sql_strip("regexp_extract(x, '(?i)^(.+?)" + chr(92) + "s+(with" + chr(92) + "s.*)$', 2)")} END WHEN {sql_match("x", "(the|der|la)")} THEN x END AS r FROM k)
SELECT d.doc_id, coalesce(string_agg(l, ' ' ORDER BY i), '') AS left_text, coalesce(string_agg(r, ' ' ORDER BY i), '') AS right_text FROM documents d LEFT JOIN m USING (doc_id) GROUP BY d.doc_id"""
)
def line_routing(spark, d):
    routed = R.route_lines(F.col("text"), r"with\s.*", r"no such cue", r"(the|der|la)")
    side = lambda name: F.array_join(F.filter(F.transform(routed, lambda r: r[name]), lambda x: x.isNotNull()), " ")
    return read(spark, d, "documents").select("doc_id", side("left").alias("left_text"), side("right").alias("right_text"))


@query(
    f"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: {sql_strip("x")}), lambda x: length(x) > 10 AND NOT {sql_any("x", [f"^(?:{p})" for p in PT.HEADER_LINES])}) AS l FROM documents)
SELECT doc_id, len(l)::INT AS n, array_to_string(l[1:len(l) // 2], ' ') AS activity, array_to_string(l[len(l) // 2 + 1:], ' ') AS benefit FROM l WHERE len(l) > 0"""
)
def half_split(spark, d):
    x = R.two_halves(F.col("text"))
    kept = F.filter(F.transform(F.split("text", "\n"), t.strip), lambda z: (F.length(z) > 10) & ~C.is_header_line(z))
    return read(spark, d, "documents").select("doc_id", F.size(kept).alias("n"), F.get(x, F.lit(0)).alias("p")).where("p is not null").select("doc_id", "n", "p.activity", "p.benefit")


@query(
    f"""WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\\s+([A-Z])', '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda x: {sql_strip("x")}), lambda x: length(x) > 30 AND NOT {sql_any("lower(x)", PT.ONLY_STARTS)}) AS l FROM documents)
SELECT doc_id, len(l)::INT AS n, md5(array_to_string(l, chr(1))) AS digest FROM s WHERE len(l) > 1"""
)
def sentence_split(spark, d):
    rows = R.split_sentences(F.col("text"), F.lit(""))
    return read(spark, d, "documents").select("doc_id", rows.alias("r")).where("size(r) > 0").select("doc_id", F.size("r").alias("n"), F.md5(F.array_join(F.transform("r", lambda p: p["activity"]), "\x01").cast("binary")).alias("digest"))


@query(
    f"""WITH x AS (SELECT doc_id, chr(10) || text AS x FROM documents), s AS (SELECT doc_id, x, regexp_matches(x, '(?i)\\n\\s*(?:\\d+[.):]\\s+|[a-z]{{2,3}}\\s)') AS has, list_transform(string_split(regexp_replace(x, '(?i)\\n\\s*((?:\\d+[.):]\\s+|[a-z]{{2,3}}\\s))', chr(1) || '\\1', 'g'), chr(1)), lambda z: regexp_replace(z, '^\\s+|\\s+$', '', 'g')) AS l FROM x)
SELECT doc_id, len(list_filter(l, lambda z: length(z) >= 20 AND NOT {sql_any("lower(z)", PT.ONLY_STARTS)}))::INT AS n FROM s WHERE has"""
)
def delimiter_rows(spark, d):
    marks = (r"\d+[.):]\s+", r"[a-z]{2,3}\s")
    has = F.concat(F.lit("\n"), "text").rlike(t.rx(r"\n\s*(?:\d+[.):]\s+|[a-z]{2,3}\s)"))
    return read(spark, d, "documents").where(has).select("doc_id", F.size(R.by_delimiters(F.col("text"), marks)).alias("n"))


def sql_describe(x: str, markers) -> str:
    """CTE ``h`` out of ``seg_`` (doc_id, pos, x): each entry as its two halves around a marker, or of its sentences."""
    return f"""y AS (SELECT doc_id, pos, {sql_strip(sql_collapse(x))} AS x FROM seg_), f AS (SELECT doc_id, pos, CASE {" ".join(f"WHEN {sql_match('x', p)} THEN {sql_strip(sql_before('x', p))}" for p in markers)} ELSE x END AS a, CASE {" ".join(f"WHEN {sql_match('x', p)} THEN {sql_strip(sql_after('x', p))}" for p in markers)} ELSE '' END AS b FROM y),
s AS (SELECT *, string_split(a, '.') AS l FROM f), t AS (SELECT *, {sql_strip("array_to_string(l[1:len(l) // 2], '. ')")} AS head, {sql_strip("array_to_string(l[len(l) // 2 + 1:], '. ')")} AS tail FROM s),
h AS (SELECT doc_id, pos, CASE WHEN b = '' AND contains(a, '.') THEN CASE WHEN head <> '' AND NOT ends_with(head, '.') THEN head || '.' ELSE head END ELSE a END AS activity, CASE WHEN b = '' AND contains(a, '.') THEN tail ELSE b END AS benefit FROM t)"""


def _sql_told(x: str) -> str:
    n = sql_count("lower(z)", PT.ONLY_INDICATORS)
    return f"list_filter({x}, lambda z: length(z) >= 20 AND NOT ({sql_any(sql_strip('lower(z)'), PT.ONLY_STARTS)} OR ({n} >= 2 AND length(z) < 500) OR ({n} >= 1 AND length(z) < 200)))"


def _sql_entry(x: str) -> str:
    return sql_strip(sql_remove(sql_remove(f"regexp_replace(regexp_replace({x}, '[|¦]', '', 'g'), '\\s+', ' ', 'g')", _DASH, ""), [r"\([^)]*tell\s+us[^)]*\)", r"\([^)]*community\s+will\s+benefit\s+by[^)]*\)"]))


#: The delimiters for a dialect that can't look ahead: line ends get a mark before them, so that a match may
#: take the mark behind a delimiter and leave the line end to the next one.
_ROW_MARK = r"(?i)\n[\s\x02]*(" + "|".join(re.sub(r"\\s([*+])", r"[\\s\\x02]\1", re.sub(r"\\s\+$", r"[\\s\\x02]", p.replace("(?=[A-Z])", "[A-Z]"))) for p in PT.ROW_DELIMITERS) + ")"


@query(
    f"""WITH d AS (SELECT doc_id, regexp_replace(text, '([.!?]) +([A-Z])', '\\1' || chr(10) || '2. \\2', 'g') AS text FROM documents), x AS (SELECT doc_id, replace(chr(10) || text, chr(10), chr(2) || chr(10)) AS x, text FROM d), m AS (SELECT *, regexp_matches(x, {q(_ROW_MARK)}) AS marked FROM x),
p AS (SELECT doc_id, marked, CASE WHEN marked THEN string_split(regexp_replace(x, {q(_ROW_MARK)}, chr(1) || '\\1', 'g'), chr(1)) ELSE string_split(regexp_replace(text, '\\n\\s*\\n+', chr(1), 'g'), chr(1)) END AS l FROM m),
k AS (SELECT doc_id, {_sql_told(f"list_transform(l, lambda z: {sql_strip('replace(z, chr(2), %s)' % repr(''))})")} AS l, marked FROM p WHERE marked OR len(l) > 1),
seg_ AS (SELECT doc_id, unnest(l) AS x, generate_subscripts(l, 1) AS pos FROM (SELECT doc_id, CASE WHEN marked THEN l ELSE list_filter(l, lambda z: length(z) >= 30) END AS l FROM k)),
{sql_describe("x", PT.BENEFIT_MARKS)}, o AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS pos, activity, benefit FROM h WHERE activity <> '' OR benefit <> '')
SELECT doc_id, pos::INT AS pos, {_sql_entry("activity")} AS activity, {_sql_entry("benefit")} AS benefit FROM o"""
)
def described_rows(spark, d):
    """Rows by delimiters or paragraphs, each described; sentences get a number and a line of their own first."""
    rows = R.by_delimiters(F.regexp_replace("text", "([.!?]) +([A-Z])", "$1\n2. $2"))
    return read(spark, d, "documents").select("doc_id", F.posexplode(rows).alias("pos", "p")).select("doc_id", "pos", "p.*")


@query()
def section_rows(spark, d):
    """The whole parser of recognised sections over documents."""
    return read(spark, d, "documents").select("doc_id", F.posexplode(R.parse_section(F.col("text"))).alias("pos", "e")).select("doc_id", "pos", "e.*")


@query(f"WITH {SQL_LINES} SELECT source, min(doc_id) AS doc_id FROM lines_ WHERE activity <> '' OR benefit <> '' GROUP BY source, lower(activity), lower(benefit)")
def dedupe_exact(spark, d):
    return R.dedupe_rows(lines(spark, d), ["source"], F.col("activity"), F.col("benefit"), "doc_id").select("source", "doc_id")


@query(f"WITH {SQL_LINES} SELECT source, min(doc_id) AS doc_id FROM lines_ WHERE activity <> '' OR benefit <> '' GROUP BY source, lower(left(activity, 100)), lower(left(benefit, 100))")
def dedupe_prefix(spark, d):
    return R.dedupe_rows(lines(spark, d), ["source"], F.col("activity"), F.col("benefit"), "doc_id", 100).select("source", "doc_id")


SQL_LIST_ROWS = "r AS (SELECT lang, n_chars % 50 AS g, list({'activity': activity, 'benefit': benefit, 'doc_id': doc_id} ORDER BY doc_id) AS l FROM (SELECT l.*, d.n_chars FROM lines_ l JOIN documents d USING (doc_id)) GROUP BY 1, 2)"


def _grouped_rows(spark, d):
    n = read(spark, d, "documents").select("doc_id", (F.col("n_chars") % 50).alias("g"))
    rows = F.array_sort(F.collect_list(F.struct("doc_id", "activity", "benefit")))
    return lines(spark, d).join(n, "doc_id").groupBy("lang", "g").agg(rows.alias("rows"))


@query(f"WITH {SQL_LINES}, k AS (SELECT l.lang, d.n_chars % 50 AS g, l.doc_id, lower(activity) AS a, lower(benefit) AS b FROM lines_ l JOIN documents d USING (doc_id)), f AS (SELECT lang, g, min(doc_id) AS doc_id FROM k WHERE a <> '' OR b <> '' GROUP BY lang, g, a, b) SELECT lang, g, count(*)::INT AS n, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS kept FROM f GROUP BY lang, g")
def dedupe_array(spark, d):
    out = _grouped_rows(spark, d).withColumn("rows", R.dedupe(F.col("rows"))).where("size(rows) > 0")
    return out.select("lang", "g", F.size("rows").alias("n"), F.array_join(F.transform("rows", lambda r: r["doc_id"].cast("string")), ",").alias("kept"))


@query(
    f"""WITH {SQL_LINES}, k AS (SELECT l.lang, d.n_chars % 50 AS g, l.doc_id, left({sql_strip("lower(activity)")}, 10) AS a, {sql_strip("benefit")} AS b FROM lines_ l JOIN documents d USING (doc_id)),
f AS (SELECT lang, g, min(doc_id) AS doc_id FROM k WHERE a <> '' GROUP BY lang, g, a UNION ALL SELECT lang, g, doc_id FROM k WHERE a = '' AND b <> '') SELECT lang, g, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS kept FROM f GROUP BY lang, g"""
)
def dedupe_empty_key(spark, d):
    out = _grouped_rows(spark, d).withColumn("rows", R.dedupe_by_activity(F.col("rows"), 10)).where("size(rows) > 0")
    return out.select("lang", "g", F.array_join(F.transform("rows", lambda r: r["doc_id"].cast("string")), ",").alias("kept"))


# ---------------------------------------------------------------- tables of cells

KEYS = (r"the", r"und", r"de\s", r"ing")
HEAD_A, HEAD_B = (r"the", r"der"), (r"ing", r"ung")


def sql_row_text(r: str) -> str:
    return f"lower(array_to_string({r}, ' '))"


@query(
    f"""WITH {SQL_TABLES}, h AS (SELECT doc_id, cells, coalesce(list_position(list_transform(cells, lambda r: {sql_count(sql_row_text("r"), KEYS)} >= 2), true), 0) - 1 AS header,
list_transform(cells[1:5], lambda r: {sql_any(sql_row_text("r"), HEAD_A)}) AS a, list_transform(cells[1:5], lambda r: {sql_any(sql_row_text("r"), HEAD_B)}) AS b FROM tables_),
l AS (SELECT *, list_position(list_transform(list_zip(a, b), lambda z: z[1] OR z[2]), true) AS i FROM h)
SELECT doc_id, header::INT AS header, (coalesce(i, 0) - 1)::INT AS labelled, coalesce(a[i], false) AS has_a, coalesce(b[i], false) AS has_b FROM l"""
)
def header_rows(spark, d):
    x = F.col("cells")
    out = cell_tables(spark, d).select("doc_id", R.header_row(x, KEYS).alias("header"), R.labelled_header(x, HEAD_A, HEAD_B).alias("l"))
    return out.select("doc_id", "header", F.col("l.row").alias("labelled"), F.col("l.has_activity").alias("has_a"), F.col("l.has_benefit").alias("has_b"))


@query(f"WITH {SQL_TABLES} SELECT doc_id, len(cells)::INT AS n_rows, len(cells[1])::INT AS column_count, len(list_filter(cells, lambda r: len(r) >= 2))::INT AS wide_rows FROM tables_")
def table_shape(spark, d):
    x = F.col("cells")
    return cell_tables(spark, d).select("doc_id", F.size(x).alias("n_rows"), R.validate_table(x)["column_count"].alias("column_count"), F.size(F.filter(x, lambda r: F.size(r) >= 2)).alias("wide_rows"))


def _sql_cell(x: str) -> str:
    return sql_drop(sql_collapse(sql_strip(x)), [chr(0), *_SEVERAL])


@query(
    f"""WITH {SQL_TABLES}, r AS (SELECT doc_id, unnest(cells) AS r FROM tables_ WHERE len(cells) >= 2), p AS (SELECT doc_id, {_sql_cell("r[1]")} AS activity, {_sql_cell("r[2]")} AS benefit FROM r WHERE len(r) >= 2),
k AS (SELECT * FROM p WHERE NOT ({sql_strip("activity")} = '' OR {sql_any(sql_strip("activity"), [f"^(?:{h})" for h in PT.HEADERS])} OR {sql_any(sql_strip("activity"), PT.INSTRUCTIONS)}))
SELECT t.doc_id, false AS is_valid, 'low' AS confidence, '' AS headers, k.activity, k.benefit FROM tables_ t LEFT JOIN k USING (doc_id)"""
)
def table_rows(spark, d):
    """Rows of tables behind their header (the synthetic tables have none), with the table's validity."""
    x = F.col("cells")
    out = cell_tables(spark, d).select("doc_id", R.validate_table(x).alias("v"), F.array_join(R.table_headers(x), ",").alias("headers"), F.explode_outer(R.parse_table(x)).alias("p"))
    return out.select("doc_id", "v.is_valid", "v.confidence", "headers", "p.activity", "p.benefit")


@query(
    """WITH c AS (SELECT page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1) AS a, regexp_extract_all(html, '<p>([^<]*)', 1) AS b, regexp_extract_all(html, '(?s)<body>(.*)</body>', 1) AS c FROM pages)
SELECT page_id, CASE WHEN len(a) > 0 THEN 0 WHEN len(b) > 0 THEN 1 WHEN len(c) > 0 THEN 2 END::INT AS strategy, CASE WHEN len(a) > 0 THEN len(a) WHEN len(b) > 0 THEN len(b) WHEN len(c) > 0 THEN len(c) END::INT AS items FROM c"""
)
def fallback_strategy(spark, d):
    tries = F.array(F.regexp_extract_all("html", F.lit(r"<li>(.*?)</li>")), F.regexp_extract_all("html", F.lit(r"<p>([^<]*)")), F.regexp_extract_all("html", F.lit(r"(?s)<body>(.*)</body>")))
    best = R.first_strategy(tries)
    return read(spark, d, "pages").select("page_id", F.nullif(F.array_position(tries, best), F.lit(0)).cast("int").alias("s"), F.size(best).alias("items")).select("page_id", (F.col("s") - 1).alias("strategy"), F.when(F.col("items") > 0, F.col("items")).alias("items"))


# ---------------------------------------------------------------- results

SQL_RESULTS = """res AS (SELECT d.doc_id, d.lang AS document_type, CASE WHEN l.quality = 1 THEN 'success' WHEN l.quality = 0 THEN 'error' ELSE 'no_data' END AS extraction_status, (d.n_chars % 4)::INT AS activities FROM documents d LEFT JOIN labels l USING (doc_id))"""


def results(spark, d):
    docs, labels = read(spark, d, "documents"), read(spark, d, "labels")
    joined = docs.join(labels, "doc_id", "left")
    status = IO.status(F.coalesce(F.col("quality") == 1, F.lit(False)), F.when(F.col("quality") == 0, "low"))
    return joined.select("doc_id", F.col("lang").alias("document_type"), status.alias("extraction_status"), (F.col("n_chars") % 4).cast("int").alias("activities"))


@query("WITH " + SQL_RESULTS + " SELECT count(*) AS total, count(*) FILTER (extraction_status = 'success') AS success, count(*) FILTER (extraction_status = 'error') AS errors, count(*) FILTER (extraction_status = 'no_data') AS no_data, sum(activities)::BIGINT AS total_activities FROM res")
def batch_summary(spark, d):
    return M.batch_summary(results(spark, d)).select("total", "success", "errors", "no_data", "total_activities")


@query("WITH " + SQL_RESULTS + " SELECT document_type, extraction_status, count(*) AS documents FROM res GROUP BY 1, 2")
def status_grid(spark, d):
    return M.status_grid(results(spark, d))


@query("WITH " + SQL_RESULTS + " SELECT document_type, count(*) AS documents, avg((extraction_status = 'success')::INT)::DOUBLE AS rate, grouping(document_type) = 1 AS is_total FROM res GROUP BY ROLLUP (document_type)")
def success_rate_by_group(spark, d):
    return M.success_rates(results(spark, d))


SQL_TURNS = "n AS (SELECT conv_id, count(*)::BIGINT AS activities FROM conversations GROUP BY conv_id)"


def _turns(spark, d):
    return read(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("activities"))


@query(f"WITH {SQL_TURNS} SELECT sum(activities)::BIGINT AS total, avg(activities)::DOUBLE AS mean, median(activities)::DOUBLE AS median, min(activities) AS least, max(activities) AS most, count(*) FILTER (activities = 0) AS zero_documents, count(*) FILTER (activities > 0) AS nonzero_documents FROM n")
def activity_stats(spark, d):
    return M.count_statistics(_turns(spark, d))


@query(f"WITH {SQL_TURNS} SELECT activities AS n, count(*) AS documents FROM n GROUP BY 1")
def count_distribution(spark, d):
    return M.count_distribution(_turns(spark, d))


@query(
    """WITH s AS (SELECT list_sort(list(value)) AS l, count(*) AS n FROM events WHERE value IS NOT NULL)
SELECT e.n, round(mean, 6) AS mean, median, least, most, round(total, 4) AS total, l[(least(floor(s.n * 0.95::DOUBLE), s.n - 1) + 1)::BIGINT] AS p95 FROM (SELECT count(*) AS n, avg(value) AS mean, median(value) AS median, min(value) AS least, max(value) AS most, sum(value) AS total FROM events WHERE value IS NOT NULL) e, s"""
)
def timing_stats(spark, d):
    out = M.time_statistics(read(spark, d, "events"), "value")
    return out.select("n", F.round("mean", 6).alias("mean"), "median", "least", "most", F.round("total", 4).alias("total"), "p95")


@query("WITH s AS (SELECT event_type, list_sort(list(value)) AS l, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY event_type) SELECT event_type, l[(least(floor(n * 0.95::DOUBLE), n - 1) + 1)::BIGINT] AS ranked FROM s")
def p95_by_type(spark, d):
    return M.ranked_value(read(spark, d, "events"), "value", ["event_type"])


@query("SELECT event_type, round(avg(value), 6) AS mean, count(*) AS documents FROM events WHERE value IS NOT NULL GROUP BY event_type")
def mean_time_by_type(spark, d):
    return M.mean_time_by(read(spark, d, "events"), "event_type", "value").select("event_type", F.round("mean", 6).alias("mean"), "documents")


@query(
    """WITH f AS (SELECT l_orderkey AS k, min(l_linenumber) AS page FROM lineitem WHERE l_quantity > 25 GROUP BY 1), g AS (SELECT l_orderkey AS k, min(l_linenumber) AS section_page FROM lineitem WHERE l_discount > 0.05 GROUP BY 1), j AS (SELECT abs(page - section_page) AS d FROM f JOIN g USING (k))
SELECT count(*) AS total, (count(*) FILTER (d <= 0))::DOUBLE / greatest(count(*), 1) AS exact, (count(*) FILTER (d <= 1))::DOUBLE / greatest(count(*), 1) AS within_1, (count(*) FILTER (d <= 2))::DOUBLE / greatest(count(*), 1) AS within_2 FROM j"""
)
def tolerance_accuracy(spark, d):
    li = read(spark, d, "lineitem")
    first = lambda cond, name: li.where(cond).groupBy(F.col("l_orderkey").alias("k")).agg(F.min("l_linenumber").alias(name))
    return M.tolerance_accuracy(first("l_quantity > 25", "page"), first("l_discount > 0.05", "section_page"), "k")


@query(
    """WITH a AS (SELECT o_orderpriority AS kind, avg((o_orderstatus = 'F')::INT)::DOUBLE AS r FROM orders WHERE year(o_orderdate) % 2 = 0 AND o_orderpriority <> '1-URGENT' GROUP BY 1), b AS (SELECT o_orderpriority AS kind, avg((o_orderstatus = 'F')::INT)::DOUBLE AS r FROM orders WHERE year(o_orderdate) % 2 = 1 GROUP BY 1)
SELECT coalesce(a.kind, b.kind) AS kind, coalesce(a.r, 0)::DOUBLE AS baseline, coalesce(b.r, 0)::DOUBLE AS new, (coalesce(b.r, 0) - coalesce(a.r, 0))::DOUBLE AS change FROM a FULL OUTER JOIN b ON a.kind = b.kind"""
)
def run_comparison(spark, d):
    o = read(spark, d, "orders").withColumn("kind", F.col("o_orderpriority")).withColumn("ok", (F.col("o_orderstatus") == "F").cast("int"))
    half = lambda cond: o.where(cond).groupBy("kind").agg(F.avg("ok").alias("r"))
    return M.compare_groups(half("year(o_orderdate) % 2 = 0 and kind <> '1-URGENT'"), half("year(o_orderdate) % 2 = 1"), "kind", "r")


@query(
    """WITH v AS (SELECT n_nationkey::BIGINT AS k, (n_nationkey % 5) / 5.0 AS a, (n_nationkey % 3) / 3.0 AS b, n_nationkey % 4 AS c, n_nationkey % 7 AS e FROM nation)
SELECT k, CASE WHEN b > a AND e >= c THEN 'adopt' WHEN b > a THEN 'trade-off' WHEN b < a THEN 'reject' ELSE 'similar' END AS verdict FROM v"""
)
def run_verdict(spark, d):
    n = F.col("n_nationkey")
    return read(spark, d, "nation").select(n.cast("long").alias("k"), M.verdict(n % 5 / 5, n % 3 / 3, n % 4, n % 7).alias("verdict"))


@query(
    """WITH s AS (SELECT o_orderkey, list({'a': l_returnflag || l_linenumber, 'b': l_linestatus} ORDER BY l_linenumber, l_returnflag, l_linestatus) AS l FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey)
SELECT o_orderkey AS sample_no, coalesce(l[1].a, '') AS extracted_activity_1, coalesce(l[1].b, '') AS extracted_benefit_1, coalesce(l[2].a, '') AS extracted_activity_2, coalesce(l[3].b, '') AS extracted_benefit_3 FROM s"""
)
def worksheet_wide(spark, d):
    li = read(spark, d, "lineitem").select("l_orderkey", F.struct("l_linenumber", F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("activity"), F.col("l_linestatus").alias("description")).alias("a"))
    acts = F.array_sort(F.collect_list("a"))
    null = F.lit(None).cast("string")
    docs = li.groupBy("l_orderkey").agg(acts.alias("activities")).select(F.col("l_orderkey").alias("sample_index"), null.alias("company_number"), F.struct(null.alias("source_file")).alias("extraction_metadata"), null.alias("document_type"), null.alias("extraction_status"), F.struct("activities").alias("section_b"))
    return SA.worksheet(docs).select("sample_no", "extracted_activity_1", "extracted_benefit_1", "extracted_activity_2", "extracted_benefit_3")


@query(
    """WITH u AS (SELECT unnest([CASE l_returnflag WHEN 'R' THEN 'P' WHEN 'A' THEN 'Y' ELSE 'N' END, CASE WHEN l_linestatus = 'F' THEN 'y' ELSE '' END]) AS v FROM lineitem), w AS (SELECT upper(v) AS v FROM u WHERE v <> '')
SELECT count(*) AS checked, count(*) FILTER (v = 'Y') AS exact, count(*) FILTER (v = 'P') AS partial, count(*) FILTER (v NOT IN ('Y', 'P')) AS wrong, (count(*) FILTER (v = 'Y'))::DOUBLE / count(*) AS exact_rate, (count(*) FILTER (v IN ('Y', 'P')))::DOUBLE / count(*) AS partial_or_better_rate FROM w"""
)
def unpivot_accuracy(spark, d):
    li = read(spark, d, "lineitem")
    a = F.when(F.col("l_returnflag") == "R", "P").when(F.col("l_returnflag") == "A", "Y").otherwise("N")
    return M.match_accuracy(li.select(a.alias("is_match_1"), F.when(F.col("l_linestatus") == "F", "y").otherwise("").alias("is_match_2")), ["is_match_1", "is_match_2"])


@query("SELECT o_orderpriority AS rating, count(*) AS documents FROM orders WHERE o_orderpriority <> '' GROUP BY 1")
def rating_counts(spark, d):
    return M.ratings(read(spark, d, "orders"), "o_orderpriority")


@query(
    """WITH n AS (SELECT regexp_extract(regexp_extract(url, '([^/]*)$', 1), '^(.+?)(?:[?#].*)?$', 1) AS name, page_id, url FROM pages), s AS (SELECT page_id, regexp_replace(regexp_extract(url, '([^/\\\\]*)$', 1), '(.)\\.[^.]+$', '\\1') AS stem FROM pages)
SELECT page_id, stem, CASE WHEN regexp_matches(stem, '^\\d{2,4}') THEN regexp_extract(stem, '^(\\d{2,4})', 1) END AS company_number, CASE WHEN regexp_matches(stem, '^\\d{2,4}') THEN 'partial' ELSE 'legacy' END AS format FROM s"""
)
def filename_parse(spark, d):
    o = Options(company_number=r"^(\d{2,4})")
    p = IO.parse_file_name(F.col("url"), o)
    return read(spark, d, "pages").select("page_id", IO.file_stem(F.col("url")).alias("stem"), p["company_number"].alias("company_number"), p["format"].alias("format"))


# ---------------------------------------------------------------- samples

SQL_ALLOC = """g AS (SELECT lang AS stratum, count(*) AS n FROM documents GROUP BY 1), b AS (SELECT *, least(n, greatest({least}, floor(n::DOUBLE / sum(n) OVER () * {size})))::BIGINT AS base FROM g),
c AS (SELECT *, n - base AS cap, greatest(0, {size} - sum(base) OVER ()) AS missing FROM b), a AS (SELECT stratum, n, (base + greatest(0, least(cap, missing - coalesce(sum(cap) OVER (ORDER BY n DESC, stratum ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))))::BIGINT AS slots FROM c)"""


@query("WITH " + SQL_ALLOC.format(least=3, size=50) + " SELECT stratum, n, slots FROM a")
def strat_allocation(spark, d):
    return SA.allocation(read(spark, d, "documents").groupBy(F.col("lang").alias("stratum")).agg(F.count("*").alias("n")), 50, 3)


@query(
    "WITH "
    + SQL_ALLOC.format(least=3, size=50)
    + """, e AS (SELECT d.doc_id, d.lang AS stratum, coalesce(l.toxic = 1, false) AS err, md5('7' || d.doc_id) AS t FROM documents d LEFT JOIN labels l USING (doc_id)),
k AS (SELECT stratum, count(*) FILTER (err) AS errors FROM e GROUP BY 1), s AS (SELECT a.stratum, slots, CASE WHEN errors > 0 THEN least(errors, greatest(1, slots // 3)) ELSE 0 END AS es FROM a JOIN k USING (stratum)),
r AS (SELECT e.*, row_number() OVER (PARTITION BY stratum, err ORDER BY t, doc_id) AS r FROM e) SELECT r.stratum, doc_id, err FROM r JOIN s USING (stratum) WHERE r.r <= CASE WHEN err THEN es ELSE slots - es END"""
)
def strat_sample(spark, d):
    rows = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id", "left").withColumn("err", F.coalesce(F.col("toxic") == 1, F.lit(False)))
    return SA.stratified_sample(rows, 50, "lang", ["doc_id"], F.col("err"), 7).select(F.col("lang").alias("stratum"), "doc_id", "err")


@query("SELECT doc_id, lang FROM documents ORDER BY md5('42' || doc_id), doc_id LIMIT 65")
def exact_sample(spark, d):
    return SA.exact_sample(read(spark, d, "documents"), 65, ["doc_id"], 42).select("doc_id", "lang")


# ---------------------------------------------------------------- whole plans, without one SQL text


@query(
    """WITH w AS (SELECT conv_id::VARCHAR AS doc_id, turn::INT AS page_num, regexp_extract_all(text, '[^\\s]+') AS l FROM conversations), i AS (SELECT doc_id, page_num, unnest(l) AS t, generate_subscripts(l, 1) - 1 AS i FROM w),
n AS (SELECT doc_id, page_num, sum(length(t)) FILTER (i % 5 < 3)::DOUBLE / sum(length(t)) AS share, string_agg(t, ' ' ORDER BY i) AS linear_text FROM i GROUP BY 1, 2),
r AS (SELECT doc_id, page_num, i // 5 AS row_, string_agg(t, ' ' ORDER BY i) FILTER (i % 5 < 3) AS lt, string_agg(t, ' ' ORDER BY i) FILTER (i % 5 >= 3) AS rt FROM i GROUP BY 1, 2, 3),
s AS (SELECT doc_id, page_num, string_agg(lt, chr(10) ORDER BY row_) AS l, string_agg(rt, chr(10) ORDER BY row_) AS r FROM r GROUP BY 1, 2)
SELECT doc_id, page_num, share > 0.15 AND share < 0.85 AS has_two_columns, 500 AS column_boundary, coalesce(l, '') AS "left", coalesce(r, '') AS "right", linear_text FROM n JOIN s USING (doc_id, page_num)"""
)
def word_box_lines(spark, d):
    """Layout of word boxes: words of a turn on a grid of five columns, with slightly uneven lines."""
    words = read(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("doc_id"), F.col("turn").cast("int").alias("page_num"), F.posexplode(t.words(F.col("text"))).alias("i", "text"))
    col = F.col("i") % 5
    words = words.select("doc_id", "page_num", F.lit(1000).alias("page_width"), "text", (col * 200 + 10).cast("int").alias("left"), (F.floor(F.col("i") / 5) * 30 + col).cast("int").alias("top"), F.lit(100).alias("width"), F.lit(20).alias("height"), F.lit(90).alias("conf"))
    return R.layout(words)


@query(
    f"""WITH {SQL_PAGES}, {SQL_TYPES} SELECT doc_id::VARCHAR AS source_file, document_type, CASE document_type WHEN 'electronic' THEN 'no_data' ELSE 'error' END AS extraction_status, 0 AS activities,
CASE WHEN document_type <> 'electronic' THEN 'no_form_found' END AS status_detail, CASE WHEN document_type <> 'electronic' THEN 'No form found in document' END AS error FROM typed"""
)
def extraction_results(spark, d):
    """The whole extraction over conversations as documents, flattened; no conversation holds a form."""
    out = extract.run(conversation_pages(spark, d), o=Options(page_chars=PAGE_CHARS))
    return out.select(F.col("extraction_metadata.source_file").alias("source_file"), "document_type", "extraction_status", F.size("section_b.activities").alias("activities"), "status_detail", F.col("extraction_metadata.error").alias("error"))


@query(
    f"""WITH f AS (SELECT lpad(c_custkey::VARCHAR, 8, '0') AS no, (c_custkey % {len(forms.KINDS)})::INT AS kind, lower(c_mktsegment) AS w FROM customer),
x AS (SELECT *, 'new ' || w || ' tools.' AS surplus, 'it is owned by its ' || w || ' workers.' AS differs, 'people of the valley who work with ' || w AS people FROM f)
SELECT no AS company_number, no || '.pdf' AS source_file,
CASE WHEN kind < 2 THEN 'electronic' WHEN kind = 2 THEN 'hybrid' WHEN kind = 11 THEN 'unknown' ELSE 'scanned' END AS document_type,
CASE WHEN kind IN (6, 7, 8, 10, 11) THEN 'error' ELSE 'success' END AS extraction_status,
CASE kind WHEN 6 THEN 'no_form_found' WHEN 7 THEN 'section_not_found' WHEN 8 THEN 'wrong_section' WHEN 9 THEN 'ocr_quality_issue' WHEN 10 THEN 'not_recognised' WHEN 11 THEN 'not_readable' END AS status_detail,
CASE kind WHEN 6 THEN 'No form found in document' WHEN 7 THEN 'Form found on page 1 but no section behind it' WHEN 8 THEN 'Wrong section detected - other form''s content' WHEN 10 THEN 'No page could be recognised: ValueError: no image' WHEN 11 THEN 'SyntaxError: no PDF' END AS error,
CASE kind WHEN 0 THEN 'text_fallback' WHEN 1 THEN 'table' WHEN 2 THEN 'ocr' WHEN 3 THEN 'ocr' WHEN 4 THEN 'ocr_standalone' WHEN 5 THEN 'ocr_layout' WHEN 8 THEN 'ocr' WHEN 9 THEN 'ocr_alternative' END AS extraction_method,
CASE WHEN kind IN (6, 7, 10, 11) THEN NULL ELSE 2 END::INT AS section_page,
CASE kind
WHEN 0 THEN 'We teach ' || w || ' to adults. We lend ' || w || ' to schools. Our company differs from a general commercial company because ' || differs || ' If the company makes any surplus it will be used for ' || surplus || ' => '
WHEN 1 THEN 'Classes in ' || w || ' => Skills for adults; Loans of ' || w || ' => Tools for schools'
WHEN 2 THEN 'We run a weekly ' || w || ' class in the village hall for all ages. ' || differs || ' => learning ' || w || ' skills all year.'
WHEN 3 THEN 'If the company makes any surplus it will be used for ' || surplus || ' => ; 1. We teach ' || w || ' to adults. => It helps people find work.; 2. We lend ' || w || ' to schools. => Pupils learn to use it.'
WHEN 4 THEN 'We repair ' || w || ' for poor families of the valley. => saving money on repairs.'
WHEN 5 THEN 'We run a weekly ' || w || ' class for adults in the village hall on every Monday evening => People of the valley learn a trade and earn more in it than before'
WHEN 9 THEN ' => Hire of ' || w ELSE '' END AS rows,
CASE WHEN kind IN (0, 5) THEN differs ELSE '' END AS company_differs,
CASE WHEN kind = 3 THEN surplus || ' 1. We teach ' || w || ' to adults. It helps people find work. 2. We lend ' || w || ' to schools. Pupils learn to use it.' WHEN kind IN (0, 1, 2, 4, 5, 8) THEN surplus ELSE '' END AS surplus_use,
CASE WHEN kind IN (0, 2, 3, 4, 5, 7, 8, 9) THEN people ELSE '' END AS beneficiaries FROM x"""
)
def form_results(spark, d):
    """The whole extraction over forms made of customers: tables, text, recognised text, layouts, references and every failure."""
    docs = forms.documents(read(spark, d, "customer"))
    out = extract.run(forms.text_layer(docs), forms.tables(docs), forms.word_boxes(docs), docs.select("doc_id"), recognised=forms.recognised(docs), failures=forms.failures(docs))
    meta = F.col("extraction_metadata")
    rows = F.array_join(F.transform("section_b.activities", lambda a: F.concat_ws(" => ", a["activity"], a["description"])), "; ")
    return out.select("company_number", meta["source_file"].alias("source_file"), "document_type", "extraction_status", "status_detail", meta["error"].alias("error"), meta["extraction_method"].alias("extraction_method"), meta["cic36_page"].alias("section_page"), rows.alias("rows"), "section_b.company_differs", "section_b.surplus_use", "section_a.beneficiaries")


_SQL_CATEGORY = f"CASE WHEN {sql_has('lower(a || c)', PT.WRONG_MARKERS)} THEN 'wrong_section' WHEN {sql_has('a || c', PT.ARTIFACTS)} THEN 'ocr_errors' WHEN {_sql_cut('a')} OR {_sql_cut('c')} THEN 'truncated' WHEN (a = '') <> (c = '') THEN 'partial_extraction' ELSE 'success' END"


@query(
    f"""WITH {SQL_LINES}, {sql_pair_scores()}, o AS (SELECT doc_id, activity AS a, benefit AS c, round_even(completeness * 0.4::DOUBLE + coherence * 0.35::DOUBLE + noise * 0.25::DOUBLE, 1) AS s FROM scores_), e AS (SELECT o.*, lang, {_SQL_CATEGORY} AS category FROM o JOIN documents USING (doc_id))
SELECT doc_id::VARCHAR AS company_number, lang AS document_type, s AS overall_score, CASE WHEN s >= 90 THEN 'excellent' WHEN s >= 70 THEN 'good' WHEN s >= 50 THEN 'fair' ELSE 'poor' END AS quality_label, category AS error_category,
CASE WHEN s < 50 OR category <> 'success' THEN doc_id::VARCHAR END AS flag, NOT (a = '' AND c = '') AS valid FROM e"""
)
def result_quality(spark, d):
    """Quality, category, flag and validation of results made of documents' lines."""
    null = F.lit(None)
    a = F.array(F.struct("activity", F.col("benefit").alias("description")))
    meta = F.struct(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("source_file"), null.cast("string").alias("error"))
    res = lines(spark, d).select(F.col("doc_id").cast("string").alias("company_number"), F.col("lang").alias("document_type"), F.lit("success").alias("extraction_status"), F.struct(a.alias("activities")).alias("section_b"), meta.alias("extraction_metadata"))
    out = Q.validate_result(Q.score_results(res))
    return out.select("company_number", "document_type", "quality.overall_score", "quality_label", "error_category", "flag", "validation.valid")


@query(f"WITH {SQL_PAGES}, {SQL_TYPES} SELECT doc_id, page_count::INT AS page_count, total_chars, document_type FROM typed")
def stateless_rollup(spark, d):
    """The rollup that the streaming plan uses: from each document's own array."""
    docs = conversation_pages(spark, d).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_num", "text"))).alias("pages"))
    return incremental.classify_rows(docs, Options(page_chars=PAGE_CHARS)).drop("pages")


# ---------------------------------------------------------------- single operators


@query(f"WITH {SQL_PAGES} SELECT doc_id, min(page_num) FILTER ({sql_any('text', FORM_MARKS)})::INT AS page FROM pages_ GROUP BY doc_id")
def first_marked_page(spark, d):
    return L.first_page(conversation_pages(spark, d), FORM_MARKS)


@query("SELECT lang, count(*) AS n, greatest(floor(count(*) * 0.07::DOUBLE), 1)::BIGINT AS size FROM documents GROUP BY lang")
def sample_sizes(spark, d):
    n = read(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    return n.select("lang", "n", SA.share_size(F.col("n"), 7).alias("size"))


_LEAD = r"^\s*[.:]?\s*"
_BRACKETS = (r"\([^)]*\)", r"\d+")


@query(sql_slices(lambda r: sql_strip(sql_remove(f"regexp_replace({sql_collapse(sql_strip(_sql_first_listed(r, STOPS)))}, {q(_LEAD)}, '')", _BRACKETS))))
def slice_without_noise(spark, d):
    return read(spark, d, "documents").select("doc_id", X.surplus_use(F.col("text"), STARTS, STOPS, _BRACKETS).alias("part"))


_NEAREST = "(?:" + "|".join(STOPS) + ")"
_TAILS = (r"\s*\d+\s*$",)
_PREFIXES = (r"^an\s+", r"^of\s+")


@query(sql_slices(lambda r: sql_strip(sql_remove(sql_strip(sql_remove(f"regexp_replace({sql_collapse(sql_strip(sql_before(r, _NEAREST)))}, {q(_LEAD)}, '')", _TAILS)), _PREFIXES))))
def slice_with_prefixes(spark, d):
    return read(spark, d, "documents").select("doc_id", X.beneficiaries(F.col("text"), STARTS, STOPS, _TAILS, _PREFIXES).alias("part"))


@query(f"WITH {SQL_LINES} SELECT doc_id, coalesce(CASE WHEN lang <> 'en' THEN nullif(source, '') END, CASE WHEN activity <> '' THEN activity WHEN benefit <> '' THEN benefit END, '') AS value FROM lines_")
def field_precedence(spark, d):
    acts = F.array(F.struct(F.col("activity").alias("x")), F.struct(F.col("benefit").alias("x")))
    top = F.when(F.col("lang") != "en", F.col("source"))
    return lines(spark, d).select("doc_id", IO.field(top, acts, "x").alias("value"))


_REFERS = (r"\swith\s", r"\svon\s")
_OTHERS = (r"released\s+under", r"licensed\s+under")


@query(
    f"""WITH {SQL_LINES}, b AS (SELECT doc_id, activity || ' ' || benefit AS b, text FROM lines_), w AS (SELECT *, text || ' ' || b AS whole FROM b)
SELECT doc_id, {sql_any("b", _REFERS)} AND length({sql_strip("b")}) < 300 AS referential, {sql_any("b", _OTHERS)} AS other_section,
CASE WHEN {sql_any("whole", _OTHERS)} THEN 'other form''s content' WHEN {sql_count("whole", (r"tion", r"und"))} < 1 AND length(whole) > 100 THEN 'no content of this section' END AS reason FROM w"""
)
def content_checks(spark, d):
    acts = F.array(R.pair(F.col("activity"), F.col("benefit")))
    return lines(spark, d).select("doc_id", R.is_referential(acts, _REFERS).alias("referential"), R.is_other_section(acts, _OTHERS).alias("other_section"), R.check_content(acts, F.col("text"), _OTHERS, (r"tion", r"und"))["reason"].alias("reason"))


_SAYS = (r"\swhich\s", r"\sfor\s")


@query(
    f"""WITH x AS (SELECT doc_id, {sql_strip(sql_collapse("text"))} AS x FROM documents), f AS (SELECT doc_id, CASE {" ".join(f"WHEN {sql_match('x', p)} THEN {sql_strip(sql_before('x', p))}" for p in _SAYS)} ELSE x END AS a, CASE {" ".join(f"WHEN {sql_match('x', p)} THEN {sql_strip(sql_after('x', p))}" for p in _SAYS)} ELSE '' END AS b FROM x),
s AS (SELECT *, string_split(a, '.') AS l FROM f), h AS (SELECT *, {sql_strip("array_to_string(l[1:len(l) // 2], '. ')")} AS head, {sql_strip("array_to_string(l[len(l) // 2 + 1:], '. ')")} AS tail FROM s)
SELECT doc_id, CASE WHEN b = '' AND contains(a, '.') THEN CASE WHEN head <> '' AND NOT ends_with(head, '.') THEN head || '.' ELSE head END ELSE a END AS activity, CASE WHEN b = '' AND contains(a, '.') THEN tail ELSE b END AS benefit FROM h"""
)
def described_texts(spark, d):
    return read(spark, d, "documents").select("doc_id", R.describe(F.col("text"), _SAYS).alias("p")).select("doc_id", "p.*")


@query(f"WITH {SQL_TABLES} SELECT doc_id, array_to_string(list_transform(list_filter(range(1, len(cells[1]) + 1), lambda i: {sql_any('cells[1][i]', HEAD_A)} OR {sql_any('cells[1][i]', HEAD_B)}), lambda i: (i - 1) || ':' || CASE WHEN {sql_any('cells[1][i]', HEAD_A)} THEN 'activity' ELSE 'benefit' END), ',') AS mapping FROM tables_")
def column_mapping(spark, d):
    m = R.column_mapping(F.get("cells", F.lit(0)), HEAD_A, HEAD_B)
    text = F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"].cast("string"), F.lit(":"), e["value"])), ",")
    return cell_tables(spark, d).select("doc_id", text.alias("mapping"))
