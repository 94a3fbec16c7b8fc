"""Reports: one-row aggregates come to the driver and are formatted there."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame

from ..functions.text import title
from . import metrics as M
from . import quality as Q

TYPES = ("electronic", "scanned", "hybrid", "unknown")
BANDS = ("excellent", "good", "fair", "poor")


def collect_metrics(results: DataFrame, truth: DataFrame | None = None, benefit_field: str = "description") -> dict:
    """All figures of a report.  Every frame collected here has a row, or a row a type, status, category or count."""
    scored = Q.score_results(results, benefit_field).cache()
    try:
        rows = M.flat(scored)
        one = lambda df: df.first().asDict()
        pairs = lambda df: {r[0]: r[1] for r in df.collect()}
        rates = M.success_rates(rows).collect()
        out = {
            "documents": one(M.batch_summary(rows)),
            "counts_by_type": pairs(M.counts(rows, "document_type")),
            "counts_by_status": pairs(M.counts(rows, "extraction_status")),
            "success_by_type": {r.document_type: round(r.rate, 4) for r in rates if not r.is_total},
            "success_rate": next((round(r.rate, 4) for r in rates if r.is_total and r.rate is not None), 0.0),
            "activities": one(M.count_statistics(rows)),
            "activity_distribution": dict(sorted(pairs(M.count_distribution(rows)).items())),
            "times": one(M.time_statistics(rows)),
            "mean_time_by_type": pairs(M.mean_time_by(rows)),
            "quality": one(Q.quality_report(scored)),
            "quality_by_type": pairs(Q.quality_by_type(scored)),
            "errors": pairs(Q.error_counts(scored)),
        }
        if truth is not None:
            out["page_accuracy"] = one(M.tolerance_accuracy(rows, truth))
        return out
    finally:
        scored.unpersist()


def recommendations(m: dict) -> list[str]:
    n = m["documents"]["total"]
    rules = [
        (m["success_rate"] < 0.7, "Low success rate (under 70%): review failed documents for common extraction issues"),
        (0.7 <= m["success_rate"] < 0.9, "Moderate success rate: review failed documents for common issues"),
        *[(s < 50, f"Poor quality for {kind} documents: consider a specialised extraction") for kind, s in sorted(m["quality_by_type"].items(), key=str)],
        (bool(n) and m["activities"]["zero_documents"] / n > 0.2, "Many extractions without activities (over 20%): review section detection patterns"),
        (m["errors"].get("ocr_errors", 0) > n * 0.1, "High rate of recognition errors: review recognition settings and image quality"),
        (m["errors"].get("wrong_section", 0) > 0, "Wrong sections detected: improve section patterns"),
        (m["times"]["mean"] > 30, "Slow processing: consider more parallelism or lighter extraction"),
    ]
    return [text for holds, text in rules if holds] or ["The pipeline performs well; keep watching the quality metrics"]


def summary(m: dict, form: str = "markdown", version: str = "1.0.0", now: datetime | None = None) -> str:
    """The report as markdown or plain text; whole also for no results."""
    when = (now or datetime.now()).strftime("%Y-%m-%d %H:%M:%S")
    n = m["documents"]["total"]
    q, a, x = m["quality"], m["activities"], m["times"]
    if form == "text":
        return "\n".join(["Document extraction report", f"Generated: {when}", f"Documents: {n}", f"Success rate: {m['success_rate'] * 100:.1f}%", f"Activities: {a['total']}", f"Quality score: {q['mean_quality_score']:.1f}/100"])
    share = lambda k: f"{k} ({k / max(n, 1) * 100:.1f}%)"
    table = lambda head, rows: ["| " + " | ".join(head) + " |", "|" + "---|" * len(head), *("| " + " | ".join(map(str, r)) + " |" for r in rows), ""]
    parts = [
        ["# Document extraction report", "", f"**Generated**: {when}", f"**Pipeline version**: {version}", f"**Documents**: {n}", ""],
        ["## Summary", "", f"- Success rate: {m['success_rate'] * 100:.1f}%", f"- Activities: {a['total']}", f"- Mean quality score: {q['mean_quality_score']:.1f}/100", f"- Flagged for review: {q['flagged_count']}", ""],
        ["## Documents", "", *table(("Type", "Count", "Success rate"), [(title(k), m["counts_by_type"][k], f"{m['success_by_type'].get(k, 0) * 100:.1f}%") for k in TYPES if m["counts_by_type"].get(k)])],
        ["### Status", "", *(f"- {title(k)}: {share(c)}" for k, c in m["counts_by_status"].items()), ""],
        ["## Activities", "", f"- Mean per document: {a['mean']:.2f}", f"- Median: {a['median']}", f"- Range: {a['least']} - {a['most']}", f"- Documents with none: {a['zero_documents']}", "", *table(("Activities", "Documents"), m["activity_distribution"].items())],
        ["## Quality", "", *table(("Level", "Count"), [(title(b), share(q[b])) for b in BANDS]), *(f"- {title(str(k))}: {s:.1f}/100" for k, s in m["quality_by_type"].items()), ""],
        ["## Errors", "", *table(("Category", "Count"), [(title(k.replace("_", " ")), c) for k, c in sorted(m["errors"].items(), key=lambda e: (-e[1], e[0]))])],
        ["## Times", "", f"- Mean: {x['mean']:.2f}s", f"- Median: {x['median']:.2f}s", f"- 95th percentile: {x['p95']:.2f}s", f"- Total: {x['total']:.1f}s", *(f"- {title(str(k))}: {v:.2f}s (mean)" for k, v in m["mean_time_by_type"].items()), ""] if x["mean"] > 0 else [],
        ["## Recommendations", "", *(f"- {r}" for r in recommendations(m)), ""],
    ]
    return "\n".join(line for part in parts for line in part)


def as_json(m: dict, version: str = "1.0.0") -> str:
    return json.dumps({"pipeline_version": version, **m, "recommendations": recommendations(m)}, ensure_ascii=False, indent=2, default=str)


def comparison(old: dict, new: dict, old_name: str = "Baseline", new_name: str = "New") -> str:
    """Changes overall and by type, and what to do."""
    rows = [
        ("Success rate", f"{old['success_rate'] * 100:.1f}%", f"{new['success_rate'] * 100:.1f}%", f"{(new['success_rate'] - old['success_rate']) * 100:+.1f}%"),
        ("Quality score", *(f"{m['quality']['mean_quality_score']:.1f}" for m in (old, new)), f"{new['quality']['mean_quality_score'] - old['quality']['mean_quality_score']:+.1f}"),
        ("Activities", *(str(m["activities"]["total"]) for m in (old, new)), f"{new['activities']['total'] - old['activities']['total']:+d}"),
        ("Mean time (s)", *(f"{m['times']['mean']:.2f}" for m in (old, new)), f"{new['times']['mean'] - old['times']['mean']:+.2f}"),
    ]
    for kind in sorted({*old["success_by_type"], *new["success_by_type"]}, key=str):
        a, b = old["success_by_type"].get(kind, 0) * 100, new["success_by_type"].get(kind, 0) * 100
        rows.append((f"Success, {kind}", f"{a:.1f}%", f"{b:.1f}%", f"{b - a:+.1f}%"))
    said = {"adopt": f"{new_name} succeeds more often at the same or better quality: consider adopting it.", "trade-off": f"{new_name} succeeds more often at lower quality: weigh the trade-off.", "reject": f"{old_name} performs better: {new_name} isn't recommended.", "similar": "Results are similar: decide by other factors."}
    head = ["# Comparison of extraction runs", "", f"| Metric | {old_name} | {new_name} | Change |", "|---|---|---|---|"]
    return "\n".join([*head, *("| " + " | ".join(r) + " |" for r in rows), "", said[decide(old, new)]])


def decide(old: dict, new: dict) -> str:
    a, b = old["success_rate"], new["success_rate"]
    if b > a:
        return "adopt" if new["quality"]["mean_quality_score"] >= old["quality"]["mean_quality_score"] else "trade-off"
    return "reject" if b < a else "similar"
