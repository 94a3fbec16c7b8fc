"""Scores of texts and of activity-benefit pairs, as expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import cleaning as C
from . import patterns as P
from . import text as t


def _penalty(n: Column) -> Column:
    return F.when(n == 0, 50).when(n < 20, 30).when(n < 50, 10).otherwise(0)


def completeness(activity: Column, benefit: Column) -> Column:
    """100, less for each field that is empty, very short or short."""
    a, b = F.length(t.strip(t.text_of(activity))), F.length(t.strip(t.text_of(benefit)))
    return F.greatest(F.lit(0.0), F.lit(100.0) - _penalty(a) - _penalty(b))


def _pair(activity: Column, benefit: Column) -> Column:
    return F.concat(t.text_of(activity), F.lit(" "), t.text_of(benefit))


def coherence(activity: Column, benefit: Column, instructions: Sequence[str] = P.INSTRUCTIONS) -> Column:
    """100, less for instruction patterns, few words and repeated words."""

    def by_words(w: Column) -> Column:
        n = F.size(w)
        few = F.when(n < 5, 30).when(n < 10, 15).otherwise(0)
        return few + F.when((n > 5) & (F.size(F.array_distinct(w)) / n < 0.3), 20).otherwise(0)

    score = lambda both: F.greatest(F.lit(0.0), F.lit(100.0) - 20 * t.count_matching(both, instructions) - t.let(t.words(both), by_words))
    return t.let(_pair(activity, benefit), score)


def noise(activity: Column, benefit: Column, artifacts: Sequence[str] = P.ARTIFACTS, weights: Mapping[str, int] = P.ARTIFACT_WEIGHT) -> Column:
    """100, less for artifacts, special characters and characters beyond ASCII."""

    def score(both: Column) -> Column:
        found = sum((F.when(both.contains(a), 15 * weights.get(a, 1)).otherwise(0) for a in artifacts), F.lit(0))
        odd = t.let(C.special_ratio(both), lambda special: F.when(special > 0.2, 30).when(special > 0.1, 15).otherwise(0))
        # Only texts with some bytes beyond ASCII are searched for them.
        beyond = F.when(F.octet_length(both) > F.length(both), F.regexp_count(both, F.lit(r"[^\x00-\x7F]"))).otherwise(0)
        return F.greatest(F.lit(0.0), F.lit(100.0) - found - odd - F.when(beyond > F.length(both) * 0.1, 20).otherwise(0))

    return t.let(_pair(activity, benefit), score)


def overall(complete: Column, coherent: Column, quiet: Column) -> Column:
    return complete * 0.4 + coherent * 0.35 + quiet * 0.25


def _known_words(low: Column, common: Sequence[str]) -> Column:
    """How many of the words occur as whole words: one split instead of a search for each."""
    return F.size(F.array_intersect(F.split(low, r"(?U)\W+"), F.array(*[F.lit(w) for w in common])))


def ocr_quality(c: Column, common: Sequence[str] = P.COMMON_WORDS) -> Column:
    """very_low, low or medium, by vowels, common words, special characters and consonant runs."""
    c = t.text_of(c)
    low = F.lower(c)
    among = lambda characters: F.length(low) - F.length(F.translate(low, characters, ""))
    vowels, letters = among("aeiou"), among("abcdefghijklmnopqrstuvwxyz")
    share = vowels / letters
    special = F.regexp_count(c, F.lit(P.ODD_CHARACTERS)) / F.length(c)
    runs = F.regexp_count(low, F.lit("[bcdfghjklmnpqrstvwxyz]{6,}"))

    def band(m: Column) -> Column:
        share, known, special, runs = m["share"], m["known"], m["special"], m["runs"]
        return (
            F.when((share < 0.15) | (share > 0.65) | (known < 3) | (special > 0.1) | (runs > 3), "very_low")
            .when((share < 0.25) | (share > 0.55) | (known < 6) | (special > 0.05) | (runs > 1), "low")
            .when(known >= 10, "medium")
            .otherwise("low")
        )

    measured = F.struct(share.alias("share"), _known_words(low, common).alias("known"), special.alias("special"), runs.alias("runs"))
    return F.when((F.length(t.strip(c)) < 50) | (letters == 0), "very_low").otherwise(t.let(measured, band))


def likely_handwritten(c: Column, common: Sequence[str] = P.FORM_WORDS, odd: Sequence[str] = P.ODD_RUNS) -> Column:
    """Many fragments with few common words, or few for the length, or many odd runs."""
    c = t.text_of(c)
    low = F.lower(c)
    expected = F.length(c) / 100
    runs = sum((F.regexp_count(low, F.lit(p)) for p in odd), F.lit(0))
    short = t.let(t.words(c), lambda w: F.when(F.size(w) > 0, F.size(F.filter(w, lambda x: F.length(x) <= 2)) / F.size(w)))
    flag = lambda m: ((m["short"] > 0.4) & (m["known"] < 5)) | ((expected > 2) & (m["known"] < expected * 0.3)) | (runs > 5)
    measured = F.struct(short.alias("short"), _known_words(low, common).alias("known"))
    return F.when((F.length(t.strip(c)) < 50), False).otherwise(t.let(measured, lambda m: m["short"].isNotNull() & flag(m)))


def validate_pair(activity: Column, benefit: Column, min_length: int = 20, artifacts: Sequence[str] = P.ARTIFACTS, instructions: Sequence[str] = P.INSTRUCTIONS, placeholders: Sequence[str] = P.PLACEHOLDERS) -> Column:
    """struct<is_valid, quality_score, issues, suggestions, activity_length, benefit_length>."""
    a, b = t.strip(t.text_of(activity)), t.strip(t.text_of(benefit))
    both = F.concat(a, F.lit(" "), b)
    short = lambda name, x: F.when(F.length(x) < min_length, F.concat(F.lit(f"{name} too short ("), F.length(x).cast("string"), F.lit(f" chars, min {min_length})")))
    artifact = F.coalesce(*[F.when(both.contains(x), F.lit(f"OCR artifact detected: '{x}'")) for x in artifacts], F.lit(None).cast("string"))
    told = [F.when(t.matches(x, p), f"{name} appears to be form instruction text") for p in instructions for name, x in (("Activity", a), ("Benefit", b))]
    special = C.special_ratio(both)
    missing = F.when((a == "") & (b == ""), "Both activity and benefit are empty").when(a == "", "Activity is empty").when(b == "", "Benefit is empty")
    issues = F.array_compact(F.array(short("Activity", a), short("Benefit", b), artifact, *told, F.when(C.is_placeholder(both, placeholders), "Placeholder or example text detected"), F.when(special > 0.15, F.concat(F.lit("High special character ratio ("), F.format_number(special * 100, 1), F.lit("%)"))), missing))
    suggestions = F.array_compact(
        F.array(
            F.when(F.length(a) < min_length, "Activity description should be more detailed"),
            F.when(F.length(b) < min_length, "Benefit description should explain community impact"),
            F.when(artifact.isNotNull(), "Manual review recommended for OCR quality"),
            F.when(special > 0.15, "Text may contain OCR noise"),
            F.when((b == "") & (a != ""), "Consider adding community benefit description"),
        )
    )
    return F.struct(
        (F.size(issues) == 0).alias("is_valid"),
        F.bround(pair_score(a, b, issues), 2).alias("quality_score"),
        issues.alias("issues"),
        suggestions.alias("suggestions"),
        F.length(a).alias("activity_length"),
        F.length(b).alias("benefit_length"),
    )


def pair_score(activity: Column, benefit: Column, issues: Column) -> Column:
    """1, less for issues and very short fields, more for long ones, between 0 and 1."""
    long = lambda x: F.when(F.length(x) > 100, 0.1).when(F.length(x) < 20, -0.2).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - 0.15 * F.size(issues) + long(activity) + long(benefit)))


def quality_label(score: Column, bands: Sequence[tuple[int, str]] = P.QUALITY_BANDS) -> Column:
    out = F.lit(bands[-1][1])
    for least, name in reversed(bands[:-1]):
        out = F.when(score >= least, name).otherwise(out)
    return out


def error_category(error: Column, activities: Column, artifacts: Sequence[str] = P.ARTIFACTS, wrong: Sequence[str] = P.WRONG_MARKERS, benefit_field: str = "benefit") -> Column:
    """The most severe category over a row's activities: array<struct<activity, benefit>>.

    A text of over 10 characters that doesn't end in ``.!?"'`` counts as cut off.
    """
    a, b = (lambda x: t.text_of(x["activity"])), (lambda x: t.text_of(x[benefit_field]))
    both = lambda x: F.concat(a(x), b(x))
    cut = lambda s: (s != "") & (s.rlike(r"(\.\.\.|-)\z") | ((F.length(s) > 10) & ~s.rlike(r"(?s)[.!?\"']\z")))
    return (
        F.when(F.coalesce(error, F.lit("")) != "", "processing_error")
        .when(F.coalesce(F.size(activities), F.lit(0)) <= 0, "missing_data")
        .when(F.exists(activities, lambda x: t.contains_any(F.lower(both(x)), wrong)), "wrong_section")
        .when(F.exists(activities, lambda x: t.contains_any(both(x), artifacts)), "ocr_errors")
        .when(F.exists(activities, lambda x: cut(a(x)) | cut(b(x))), "truncated")
        .when(F.exists(activities, lambda x: (a(x) == "") != (b(x) == "")), "partial_extraction")
        .otherwise("success")
    )
