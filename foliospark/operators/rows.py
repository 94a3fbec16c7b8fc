"""Rows out of tables and texts: array<struct<activity, benefit>> columns, and their de-duplication.

Everything here maps one value to one value with array functions, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import cleaning as C
from ..functions import patterns as P
from ..functions import text as t
from ..options import DEFAULT, Options
from . import slices as S

ACTIVITY = "struct<activity:string,benefit:string>"
ENTRY = "struct<activity:string,benefit:string,company_differs:string,surplus_use:string,confidence:string>"


def pair(activity: Column, benefit: Column) -> Column:
    return F.struct(activity.alias("activity"), benefit.alias("benefit"))


def none() -> Column:
    return F.array().cast(f"array<{ACTIVITY}>")


# ---------------------------------------------------------------- tables of cells


def _row_text(row: Column) -> Column:
    return F.lower(F.array_join(F.transform(row, t.text_of), " "))


def header_row(table: Column, keywords: Sequence[str] = P.TABLE_KEYWORDS, least: int = 2) -> Column:
    """Index of the first row with ``least`` keywords; -1 without one."""
    return F.coalesce(F.array_position(F.transform(table, lambda r: t.count_matching(_row_text(r), keywords) >= least), True).cast("int"), F.lit(0)) - 1


def labelled_header(table: Column, activity: Sequence[str] = P.ACTIVITY_HEADS, benefit: Sequence[str] = P.BENEFIT_HEADS, within: int = 5) -> Column:
    """struct<row, has_activity, has_benefit> of the first of the first rows that names either."""
    rows = F.transform(F.slice(table, 1, within), lambda r, i: F.struct(i.cast("int").alias("row"), t.any_match(_row_text(r), activity).alias("has_activity"), t.any_match(_row_text(r), benefit).alias("has_benefit")))
    first = F.get(F.filter(rows, lambda r: r["has_activity"] | r["has_benefit"]), F.lit(0))
    return F.coalesce(first, F.struct(F.lit(-1).alias("row"), F.lit(False).alias("has_activity"), F.lit(False).alias("has_benefit")))


def parse_table(table: Column, loose_headers: bool = False) -> Column:
    """Activities of a table: rows behind the header with two cells, cleaned, without headers and empty ones."""
    body = F.slice(table, header_row(table) + 2, F.greatest(F.size(table), F.lit(1)))
    body = F.filter(body, lambda r: F.size(r) >= 2)
    out = F.transform(body, lambda r: pair(C.clean_cell(F.get(r, F.lit(0))), C.clean_cell(F.get(r, F.lit(1)))))
    out = F.filter(out, lambda p: ~C.is_header_or_instruction(p["activity"], loose_headers))
    return F.when(F.size(table) < 2, none()).otherwise(F.coalesce(out, none()))


def first_strategy(candidates: Column) -> Column:
    """Tables of several strategies in order: the first that found any."""
    return F.get(F.filter(candidates, lambda x: F.size(x) > 0), F.lit(0))


def validate_table(table: Column) -> Column:
    """struct<is_valid, column_count, has_activity_column, has_benefit_column, row_count, issues, confidence>."""
    head = labelled_header(table)
    columns = F.greatest(F.coalesce(F.size(F.get(table, F.lit(0))), F.lit(0)), F.lit(0))
    rows = F.size(table) - head["row"] - 1
    a, b = head["has_activity"], head["has_benefit"]
    empty = F.coalesce(F.size(table), F.lit(0)) <= 0
    issues = F.array_compact(F.array(F.when((columns < 2) | (columns > 3), F.concat(F.lit("Table has "), columns.cast("string"), F.lit(" columns, expected 2"))), F.when(~a, "No 'Activities' column header found"), F.when(~b, "No 'Benefit' or 'Community' column header found"), F.when(rows == 0, "No data rows in table")))
    valid = ~empty & (a | b) & (rows > 0)
    return F.struct(
        valid.alias("is_valid"),
        columns.alias("column_count"),
        a.alias("has_activity_column"),
        b.alias("has_benefit_column"),
        F.when(empty, 0).otherwise(rows).alias("row_count"),
        F.when(empty, F.array(F.lit("Empty table data"))).otherwise(issues).alias("issues"),
        F.when(valid & a & b & (columns == 2), "high").when(valid & a & b, "medium").otherwise("low").alias("confidence"),
    )


def is_table(table: Column, both: bool = True) -> Column:
    head = labelled_header(table)
    found = (head["has_activity"] & head["has_benefit"]) if both else (head["has_activity"] | head["has_benefit"])
    return (F.coalesce(F.size(table), F.lit(0)) > 0) & found


def table_headers(table: Column) -> Column:
    """Trimmed cells of the header row, none without one."""
    row = labelled_header(table)["row"]
    return F.when(row >= 0, F.transform(F.get(table, row), lambda c: t.strip(t.text_of(c)))).otherwise(F.array().cast("array<string>"))


def column_mapping(headers: Column, activity: Sequence[str] = P.ACTIVITY_HEADS, benefit: Sequence[str] = P.BENEFIT_HEADS) -> Column:
    """map<index, field> for header cells that name a field."""
    named = F.transform(headers, lambda h, i: F.struct(i.cast("int").alias("i"), F.when(t.any_match(h, activity), "activity").when(t.any_match(h, benefit), "benefit").alias("field")))
    return F.map_from_entries(F.filter(named, lambda e: e["field"].isNotNull()))


def first_wide_table(tables: Column) -> Column:
    """Index of the first table (struct with ``cells``) of at least two cells, or null."""
    return F.nullif(F.array_position(F.transform(tables, lambda x: F.size(x["cells"]) >= 2), True), F.lit(0)).cast("int") - 1


# ---------------------------------------------------------------- texts


def describe(c: Column, markers: Sequence[str] = P.BENEFIT_MARKS) -> Column:
    """Activity and benefit of one entry: around the first listed marker, else the two halves of its sentences."""

    def around(x: Column) -> Column:
        return F.coalesce(*[F.when(t.matches(x, m), pair(t.strip(t.before(x, m)), t.strip(t.after(x, m)))) for m in markers], pair(x, F.lit("")))

    def halves(parts: Column) -> Column:
        half = F.floor(F.size(parts) / 2).cast("int")
        head = t.let(t.strip(F.array_join(F.slice(parts, F.lit(1), half), ". ")), lambda h: F.when((h != "") & ~h.endswith("."), F.concat(h, F.lit("."))).otherwise(h))
        return pair(head, t.strip(F.array_join(F.slice(parts, half + 1, F.size(parts)), ". ")))

    split = lambda found: F.when((found["benefit"] == "") & found["activity"].contains("."), t.let(F.split(found["activity"], r"\."), halves)).otherwise(found)
    return t.let(t.let(t.strip(t.collapse(t.text_of(c))), around), split)


def _entries(segments: Column) -> Column:
    out = F.transform(segments, lambda s: describe(s))
    out = F.filter(out, lambda p: (p["activity"] != "") | (p["benefit"] != ""))
    return F.transform(out, lambda p: pair(C.clean_entry(p["activity"]), C.clean_entry(p["benefit"])))


def by_delimiters(c: Column, delimiters: Sequence[str] = P.ROW_DELIMITERS, least: int = 20) -> Column:
    """Rows before each number, letter, bullet, dash, label or numeral at a line's start; paragraphs without any."""
    mark = r"\n\s*(?=" + "|".join(f"(?:{d})" for d in delimiters) + ")"

    def rows(x: Column) -> Column:
        segments = F.transform(F.split(F.regexp_replace(x, t.rx(mark), "\x01"), "\x01"), t.strip)
        kept = F.filter(segments, lambda s: (F.length(s) >= least) & ~C.is_instruction_only(s))
        return F.when(t.matches(x, mark), _entries(kept)).otherwise(by_paragraphs(x))

    return t.let(F.concat(F.lit("\n"), t.text_of(c)), rows)


def by_paragraphs(c: Column, least: int = 30) -> Column:
    kept = lambda parts: F.filter(F.transform(parts, t.strip), lambda s: (F.length(s) >= least) & ~C.is_instruction_only(s))
    return t.let(F.split(t.text_of(c), r"(?U)\n\s*\n+"), lambda parts: F.when(F.size(parts) > 1, _entries(kept(parts))).otherwise(none()))


def single_entry(c: Column) -> Column:
    def one(p: Column) -> Column:
        empty = (p["activity"] == "") & (p["benefit"] == "")
        told = C.is_instruction_only(p["activity"]) & C.is_instruction_only(p["benefit"])
        return F.when(empty | told, none()).otherwise(F.array(p))

    clean = lambda x: t.let(describe(x), lambda p: pair(C.clean_entry(p["activity"]), C.clean_entry(p["benefit"])))
    return t.let(t.strip(t.collapse(t.text_of(c))), lambda x: F.when(F.length(x) < 20, none()).otherwise(t.let(clean(x), one)))


def two_halves(c: Column) -> Column:
    """All lines that say something; the first half as activity, the rest as benefit."""

    def halves(lines: Column) -> Column:
        half = F.floor(F.size(lines) / 2).cast("int")
        first, rest = F.slice(lines, F.lit(1), half), F.slice(lines, half + 1, F.greatest(F.size(lines), F.lit(1)))
        return F.when(F.size(lines) > 0, F.array(pair(F.array_join(first, " "), F.array_join(rest, " ")))).otherwise(none())

    return t.let(F.filter(F.transform(F.split(t.text_of(c), "\n"), t.strip), lambda x: (F.length(x) > 10) & ~C.is_header_line(x)), halves)


def split_sentences(c: Column, benefit: Column) -> Column:
    """One long activity as its sentences, the benefit with the first; none unless there are two."""
    parts = F.filter(F.transform(F.split(t.text_of(c), r"(?uUd)(?<=[.!?])\s+(?=[A-Z])"), t.strip), lambda s: (F.length(s) > 30) & ~C.is_instruction_only(s))
    return t.let(parts, lambda x: F.when(F.size(x) > 1, F.transform(x, lambda s, i: pair(s, F.when(i == 0, benefit).otherwise("")))).otherwise(none()))


def route_lines(c: Column, benefit_line: str = P.BENEFIT_LINE, cues: str = P.BENEFIT_CUES, right_words: str = P.RIGHT_WORDS) -> Column:
    """array<struct<left, right>>: each line of an interleaved table dealt to its columns.

    In turn: a bar splits; a benefit phrase inside splits; a cue behind 20 characters splits;
    else words about effects send the line to the right, and all others go to the left.
    """
    side = lambda left, right: F.struct(left.alias("left"), right.alias("right"))
    lines = F.filter(F.transform(F.split(c, "\n"), t.strip), lambda x: F.length(x) >= 5)
    long = lambda x: F.when(F.length(x) > 5, x)
    # A pattern runs once: what it splits gets a mark between its groups, a character that no text has.
    mark = "\uffff"
    cut = lambda x, pattern: F.split(F.regexp_replace(x, t.rx(pattern), f"$1{mark}$2"), mark, 2)
    part = lambda parts, i: t.strip(F.get(parts, F.lit(i)))
    nothing = F.lit(None).cast("string")

    def route(x: Column) -> Column:
        phrase, cue = rf"^(.+?)\s+(?:({benefit_line}))$", rf"^(.{{20,}}?)\s+((?:{cues}).*)$"
        words = F.when(t.matches(x, right_words), side(nothing, x)).otherwise(side(x, nothing))
        by_cue = t.let(cut(x, cue), lambda p: F.when(F.size(p) > 1, side(part(p, 0), part(p, 1))).otherwise(words))
        by_cue = F.when(t.possible(x, [cue]), by_cue).otherwise(words)
        by_phrase = t.let(cut(x, phrase), lambda p: F.when(F.size(p) > 1, side(long(part(p, 0)), long(part(p, 1)))).otherwise(by_cue))
        by_phrase = F.when(t.possible(x, [phrase]), by_phrase).otherwise(by_cue)
        bar = F.split(x, r"\|", 2)
        return F.when(x.contains("|"), side(part(bar, 0), part(bar, 1))).otherwise(by_phrase)

    # Where no line can be split or hold a word about effects, all go to the left.
    some = c.contains("|") | t.possible(c, [benefit_line, cues, right_words])
    return F.when(some, F.transform(lines, route)).otherwise(F.transform(lines, lambda x: side(x, nothing)))


def _side(routed: Column, name: str) -> Column:
    return t.strip(F.array_join(F.filter(F.transform(routed, lambda r: r[name]), lambda x: x.isNotNull()), " "))


def _entry(p: Column, differs: Column, surplus: Column, confidence: str) -> Column:
    return F.struct(p["activity"].alias("activity"), p["benefit"].alias("benefit"), differs.alias("company_differs"), surplus.alias("surplus_use"), F.lit(confidence).alias("confidence"))


def interleaved(c: Column, starts: Sequence[str] = P.INTERLEAVED_STARTS, ends: Sequence[str] = P.INTERLEAVED_ENDS) -> Column:
    """The one activity of a table whose columns were read line by line; none if the table is short or empty."""

    def join(routed: Column) -> Column:
        b = t.strip(F.regexp_replace(C.clean_benefit(_side(routed, "right")), t.rx(r"^The\s+community\s+will\s+benefit\s+(?:by\s+)?"), ""))
        return pair(C.clean_activity(_side(routed, "left")), b)

    keep = lambda p: F.when((p["activity"] == "") & (p["benefit"] == ""), none()).otherwise(F.array(p))
    rows = lambda body: F.when(F.length(t.strip(body)) < 30, none()).otherwise(t.let(t.let(route_lines(body), join), keep))
    return t.let(t.let(t.text_of(c), lambda x: t.until_nearest(F.coalesce(t.after_last_listed(x, starts), x), ends)), rows)


def by_benefit_marker(c: Column, split: str = P.BENEFIT_SPLIT, present: Sequence[str] = P.BENEFIT_PRESENT) -> Column:
    """Alternating activity and benefit around a marker phrase: what stands before the first marker and the text behind it.

    A text behind a later marker has no activity of its own and adds no row.  A single row is
    split into sentences if it can be.
    """

    def rows(parts: Column) -> Column:
        before = F.get(parts, F.lit(0))
        a, b = C.clean_activity(before), C.clean_benefit(F.get(parts, F.lit(1)))
        both = F.filter(F.array(pair(a, b)), lambda p: (p["activity"] != "") | (p["benefit"] != ""))
        alone = F.filter(F.array(pair(a, F.lit(""))), lambda p: F.length(p["activity"]) > 20)
        return F.when(F.size(parts) == 1, alone).when(t.strip(before) != "", both).otherwise(none())

    def sentences(one: Column) -> Column:
        first = F.get(one, F.lit(0))
        return t.let(split_sentences(first["activity"], first["benefit"]), lambda x: F.when(F.size(x) > 1, x).otherwise(one))

    found = lambda x: F.when((F.length(t.strip(x)) < 50) | ~t.any_match(x, present), none()).otherwise(t.let(t.let(F.split(x, t.rx(split)), rows), sentences))
    return t.let(t.text_of(c), found)


def two_columns(c: Column) -> Column:
    by_line = lambda x: t.let(interleaved(x), lambda rows: F.when(F.size(rows) > 0, rows).otherwise(by_benefit_marker(x)))
    return t.let(t.text_of(c), lambda x: F.when(F.length(t.strip(x)) < 50, none()).otherwise(by_line(x)))


def table_text(c: Column, starts: Sequence[str] = P.TABLE_STARTS, simple: Sequence[str] = P.TABLE_STARTS_SIMPLE, ends: Sequence[str] = P.SECTION_ENDS, form_text: Sequence[str] = P.FORM_TEXT, fragments: Sequence[str] = P.FRAGMENT_LINES) -> Column:
    """The table's part of a section: behind its column headers, before the next section, without form text."""
    body = t.let(c, lambda x: t.until_first_listed(F.coalesce(t.after_last_listed(x, starts), t.after_first_listed(x, simple), x), ends))
    lines = F.filter(F.split(t.remove_each(body, form_text), "\n"), lambda x: ~t.starts(t.strip(x), fragments))
    return F.array_join(lines, "\n")


def _no_entries() -> Column:
    return F.array().cast(f"array<{ENTRY}>")


def first_found(body: Column) -> Column:
    """Rows by columns, by delimiters, or as a single entry: the first that finds any."""
    rest = lambda x: t.let(by_delimiters(x), lambda rows: F.when(F.size(rows) > 0, rows).otherwise(single_entry(x)))
    return t.let(body, lambda x: t.let(two_columns(x), lambda rows: F.when(F.size(rows) > 0, rows).otherwise(rest(x))))


def parse_section(c: Column) -> Column:
    """array<ENTRY>: the rows of a recognised section, by the first parser that finds any.

    Differs and surplus go with the first row, or with an empty one if there is no other.
    """
    empty = F.lit("")

    def entries(x: Column) -> Column:
        told = F.struct(S.ocr_company_differs(x).alias("differs"), S.ocr_surplus_use(x).alias("surplus"), first_found(table_text(x)).alias("rows"))
        return t.let(told, join)

    def join(v: Column) -> Column:
        differs, surplus = v["differs"], v["surplus"]
        full = F.transform(v["rows"], lambda p, i: _entry(p, F.when(i == 0, differs).otherwise(empty), F.when(i == 0, surplus).otherwise(empty), "low"))
        lone = F.array(_entry(pair(empty, empty), differs, surplus, "low"))
        return F.when(F.size(v["rows"]) > 0, full).when((differs != "") | (surplus != ""), lone).otherwise(_no_entries())

    return t.let(S.strip_boilerplate(c), lambda x: F.when(x == "", _no_entries()).otherwise(entries(x)))


def parse_layout(pages: Column, linear: Column, raw: Column | None = None, parsed: Column | None = None, leading: Sequence[str] = P.LEADING_NOISE) -> Column:
    """array<ENTRY> from array<struct<page_num, has_two_columns, left, right, linear_text>> in page order.

    Left columns make the activity and right ones the benefit; too short ones fall back to the
    linear text, whose entries may be given as ``parsed``.
    """
    parsed = parse_section(linear) if parsed is None else parsed
    raw = linear if raw is None else raw
    left = F.transform(pages, lambda p: F.when(p["has_two_columns"], S.clean_column(p["left"], True)).otherwise(t.text_of(p["linear_text"])))
    right = F.transform(pages, lambda p: F.when(p["has_two_columns"], S.clean_column(p["right"], False)).otherwise(""))
    full = lambda x: t.strip(t.remove_each(t.strip(F.array_join(F.filter(x, lambda y: y != ""), "\n")), leading, "m"))
    told = F.struct(full(left).alias("a"), full(right).alias("b"), S.ocr_company_differs(raw).alias("differs"), S.ocr_surplus_use(raw).alias("surplus"))

    def choose(v: Column) -> Column:
        a, b = v["a"], v["b"]
        weak = ((a == "") & (b == "")) | ((a != "") & (F.length(a) < 50)) | ((b != "") & (F.length(b) < 20))
        kept = F.transform(parsed, lambda e, i: F.when((i == 0) & (v["surplus"] != ""), e.withField("surplus_use", v["surplus"])).otherwise(e))
        return F.when(weak, kept).otherwise(F.array(_entry(pair(a, b), v["differs"], v["surplus"], "medium")))

    return F.when(F.coalesce(F.size(pages), F.lit(0)) <= 0, _no_entries()).otherwise(t.let(told, choose))


# ---------------------------------------------------------------- tests on rows


def _both(p: Column) -> Column:
    return F.concat(t.text_of(p["activity"]), F.lit(" "), t.text_of(p["benefit"]))


def is_referential(rows: Column, patterns: Sequence[str] = P.REFERRING, under: int = 300) -> Column:
    """Some row only refers to an attachment."""
    return F.coalesce(F.exists(rows, lambda p: t.any_match(_both(p), patterns) & (F.length(t.strip(_both(p))) < under)), F.lit(False))


def is_other_section(rows: Column, patterns: Sequence[str] = P.OTHER_SECTION) -> Column:
    return F.coalesce(F.exists(rows, lambda p: t.any_match(_both(p), patterns)), F.lit(False))


def check_content(rows: Column, text: Column, other: Sequence[str] = P.OTHER_FORM, marks: Sequence[str] = P.CONTENT_MARKS) -> Column:
    """struct<valid, reason>: no content of another form, and some mark of this one in a long text."""
    whole = F.concat(t.text_of(text), F.lit(" "), F.coalesce(F.array_join(F.transform(rows, _both), " "), F.lit("")))
    reason = F.when(t.any_match(whole, other), "other form's content").when((t.count_matching(whole, marks) < 1) & (F.length(whole) > 100), "no content of this section")
    return F.struct(reason.isNull().alias("valid"), reason.alias("reason"))


# ---------------------------------------------------------------- de-duplication


def dedupe(rows: Column, prefix: int | None = None) -> Column:
    """The first of each (activity, benefit), compared in lower case; rows without either go.

    ``prefix`` compares so many characters only.
    """
    keys = F.transform(rows, lambda p: F.struct(C.dedupe_key(p["activity"], prefix), C.dedupe_key(p["benefit"], prefix)))
    return F.filter(rows, lambda p, i: (F.array_position(keys, F.get(keys, i)) == i + 1) & ((t.text_of(p["activity"]) != "") | (t.text_of(p["benefit"]) != "")))


def dedupe_by_activity(rows: Column, prefix: int = DEFAULT.key_prefix) -> Column:
    """The first of each activity; rows without one stay if they have a benefit."""
    keys = F.transform(rows, lambda p: F.substring(t.strip(F.lower(t.text_of(p["activity"]))), 1, prefix))
    return F.filter(rows, lambda p, i: F.when(F.get(keys, i) == "", t.strip(t.text_of(p["benefit"])) != "").otherwise(F.array_position(keys, F.get(keys, i)) == i + 1))


def dedupe_rows(df: DataFrame, doc: Sequence[str], activity: Column, benefit: Column, pos: str, prefix: int | None = None) -> DataFrame:
    """The same over a relation with a row an activity: the lowest ``pos`` of each key stays.

    Keys are hashed for the shuffle and the first row's position is found by aggregation, so
    that a key of any size costs a row a task; rows come back by a join on position.
    """
    key = F.sha2(F.concat(C.dedupe_key(activity, prefix), F.lit("\x00"), C.dedupe_key(benefit, prefix)).cast("binary"), 256)
    full = df.where((t.text_of(activity) != "") | (t.text_of(benefit) != ""))
    first = full.select(*doc, F.col(pos), key.alias("__key")).groupBy(*doc, "__key").agg(F.min(pos).alias(pos)).drop("__key")
    return full.join(first, [*doc, pos], "left_semi")


# ---------------------------------------------------------------- words of a layout

WORD = "struct<text:string,left:int,top:int,width:int,height:int>"


def lines_of_words(words: Column, gap: int = DEFAULT.line_gap) -> Column:
    """Text of a word list: by (top, left); a word lower than its line's first by more than ``gap`` begins a line."""
    order = F.array_sort(F.transform(words, lambda w: F.struct(w["top"].alias("top"), w["left"].alias("left"), w["text"].alias("text"))))
    start = F.struct(F.lit(None).cast("int").alias("anchor"), F.array().cast("array<string>").alias("line"), F.array().cast("array<string>").alias("lines"))

    def step(acc: Column, w: Column) -> Column:
        new = acc["anchor"].isNull() | (F.abs(w["top"] - acc["anchor"]) > gap)
        done = F.when(new & (F.size(acc["line"]) > 0), F.concat(acc["lines"], F.array(F.array_join(acc["line"], " ")))).otherwise(acc["lines"])
        return F.struct(F.when(new, w["top"]).otherwise(acc["anchor"]).alias("anchor"), F.when(new, F.array(w["text"])).otherwise(F.concat(acc["line"], F.array(w["text"]))).alias("line"), done.alias("lines"))

    finish = lambda acc: F.array_join(F.when(F.size(acc["line"]) > 0, F.concat(acc["lines"], F.array(F.array_join(acc["line"], " ")))).otherwise(acc["lines"]), "\n")
    return F.coalesce(F.aggregate(order, start, step, finish), F.lit(""))


def layout(words: DataFrame, o: Options = DEFAULT) -> DataFrame:
    """words(doc_id, page_num, page_width, text, left, top, width, height, conf) -> a row a page:
    has_two_columns, column_boundary, left, right, linear_text.

    A page has two columns if both halves hold more than a set share of its characters.
    """
    good = words.where((F.col("conf") >= o.word_confidence) & (t.strip(t.text_of(F.col("text"))) != ""))
    is_left = F.col("left") + F.col("width") / 2 < F.col("page_width") / 2
    w = F.struct("text", "left", "top", "width", "height")
    out = good.groupBy("doc_id", "page_num").agg(
        F.collect_list(F.when(is_left, w)).alias("l"),
        F.collect_list(F.when(~is_left, w)).alias("r"),
        F.sum(F.when(is_left, F.length("text")).otherwise(0)).alias("nl"),
        F.sum(F.length("text")).alias("n"),
        F.max("page_width").alias("page_width"),
    )
    share = F.col("nl") / F.col("n")
    linear = F.array_join(F.transform(F.array_sort(F.transform(F.concat("l", "r"), lambda x: F.struct(x["top"], x["left"], x["text"].alias("text")))), lambda x: x["text"]), " ")
    return out.select("doc_id", "page_num", ((share > o.column_share) & (share < 1 - o.column_share)).alias("has_two_columns"), F.floor(F.col("page_width") / 2).cast("int").alias("column_boundary"), lines_of_words(F.col("l"), o.line_gap).alias("left"), lines_of_words(F.col("r"), o.line_gap).alias("right"), linear.alias("linear_text"))


def numbered(df: DataFrame, doc: Sequence[str], order: Sequence[str], name: str = "pos") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*doc).orderBy(*order)))
