"""Evaluation commands: reports, samples, accuracy, statistics, and the batch driver."""

from __future__ import annotations

import argparse
import logging
import shutil
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..operators import metrics as M
from ..operators import reports as R
from ..operators import sampling as T
from ..sources import pdf as PDF
from ..sources import results as IO
from . import extract as X


def logger(folder: str | None = None) -> logging.Logger:
    log = logging.getLogger("foliospark")
    if not log.handlers:
        log.setLevel(logging.INFO)
        log.addHandler(logging.StreamHandler())
        if folder:
            Path(folder).mkdir(parents=True, exist_ok=True)
            log.addHandler(logging.FileHandler(f"{folder}/extraction.log", encoding="utf-8"))
    return log


def dated_folder(base: str, now: datetime | None = None) -> str:
    return f"{base.rstrip('/')}/{(now or datetime.now()).strftime('%Y-%m-%d_%H%M%S')}"


def dated_name(path: str, now: datetime | None = None) -> str:
    """A date before the file name, unless it begins with a year."""
    p = Path(path)
    return str(p if p.stem.startswith(("19", "20")) else p.with_name(f"{(now or datetime.now()).strftime('%Y-%m-%d')}_{p.name}"))


def save_text(text: str, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(text, encoding="utf-8")


def report(results: DataFrame, path: str | None = None, form: str = "auto", truth: DataFrame | None = None) -> str:
    """By the path's suffix: .json, .md or .txt."""
    m = R.collect_metrics(results, truth)
    if form == "auto":
        form = {".json": "json", ".txt": "text"}.get(Path(path or "").suffix, "markdown")
    text = R.as_json(m) if form == "json" else R.summary(m, form)
    if path:
        save_text(text, dated_name(path))
    return text


def sample(results: DataFrame, path: str, size: int = 50, seed: int = 0, stratify_by: str = "document_type") -> DataFrame:
    from pyspark.sql import functions as F

    is_error = F.coalesce("extraction_status", F.lit("")) != "success" if stratify_by == "document_type" else None
    rows = results.withColumn("__id", F.coalesce("extraction_metadata.source_file", F.lit("")))
    sheet = T.worksheet(T.stratified_sample(rows, size, stratify_by, ["__id"], is_error, seed))
    IO.write_worksheet(sheet, path)
    return sheet


def copy_sample(rows: DataFrame, folder: str, target: str) -> list[str]:
    """Copies the files that a sample names (``extraction_metadata.source_file``) out of a local folder; gives the names that aren't there."""
    Path(target).mkdir(parents=True, exist_ok=True)
    missing = []
    # A sample is as large as was asked for, so its names come to the driver.
    for r in rows.selectExpr("extraction_metadata.source_file AS name").distinct().orderBy("name").collect():
        found = Path(folder, Path(r["name"] or "").name)
        if r["name"] and found.is_file():
            shutil.copy2(found, target)
        else:
            missing.append(r["name"])
    return missing


def accuracy(sheet: DataFrame, k: int = 3) -> dict:
    """Of a completed worksheet."""
    out = M.match_accuracy(sheet, [f"is_match_{i}" for i in range(1, k + 1)]).first().asDict()
    return out | {"ratings": {r.rating: r.documents for r in M.ratings(sheet).collect()}}


def statistics(results: DataFrame) -> dict:
    m = R.collect_metrics(results)
    return {k: m[k] for k in ("documents", "activities", "quality", "errors")}


def batch(spark: SparkSession, folder: str, out: str, log_dir: str | None = None, dated: bool = True) -> dict:
    """PDF files of a folder -> result documents, failed list and summary.  No files: zeros, and nothing is written."""
    log = logger(log_dir)
    files = PDF.scan_folder(spark, folder)
    if not files.take(1):
        log.info("no files in %s", folder)
        return dict.fromkeys(("total", "success", "errors", "no_data"), 0)
    target = dated_folder(out) if dated else out
    pages = PDF.page_texts(files)
    pages.write.mode("overwrite").parquet(f"{target}/pages")
    pages = spark.read.parquet(f"{target}/pages")
    texts = pages.where("error is null").drop("error")
    # Recognition costs seconds a page, so what it finds is written and read again.
    wanted = X.pages_to_recognise(texts)
    wanted.write.mode("overwrite").parquet(f"{target}/to_recognise")
    wanted = spark.read.parquet(f"{target}/to_recognise")
    PDF.recognise(files, wanted).write.mode("overwrite").parquet(f"{target}/recognised")
    PDF.layout_words(files, wanted).write.mode("overwrite").parquet(f"{target}/words")
    recognised, words = spark.read.parquet(f"{target}/recognised"), spark.read.parquet(f"{target}/words")
    failed = recognised.where("error is not null").count()
    if failed:
        log.warning("%s pages could not be recognised", failed)
    tables = PDF.page_tables(files) if PDF.executor_capabilities(spark).first()["pdf_text"] else None
    broken = pages.where("error is not null").selectExpr("doc_id", "error", "cast(null as string) as traceback")
    results = X.run(texts, tables, words, docs=files.select("doc_id"), recognised=recognised, failures=broken, extracted_at=datetime.now().isoformat(timespec="seconds"))
    results.write.mode("overwrite").parquet(f"{target}/results")
    results = spark.read.parquet(f"{target}/results")
    IO.write_results(results.drop("status_detail"), f"{target}/json")
    IO.write_failed(results, f"{target}/failed")
    summary = M.batch_summary(M.flat(results)).first().asDict()
    log.info("finished: %s", summary)
    return summary


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="foliospark")
    ap.add_argument("--input", required=True)
    ap.add_argument("--accuracy", action="store_true")
    ap.add_argument("--create-sample", type=int)
    ap.add_argument("--stats", action="store_true")
    ap.add_argument("--json", action="store_true")
    ap.add_argument("--extract", action="store_true")
    ap.add_argument("--output")
    ap.add_argument("--sample-percent", type=float)
    ap.add_argument("--seed", type=int, default=0)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if a.extract:
        print(batch(spark, a.input, a.output or "output"))
        return
    if a.accuracy:
        print(accuracy(IO.read_worksheet(spark, a.input)))
        return
    results = IO.read_results(spark, a.input, a.sample_percent, a.seed)
    if a.create_sample:
        sample(results, a.output or "sample", a.create_sample, a.seed)
    elif a.stats:
        print(statistics(results))
    else:
        print(report(results, a.output, "json" if a.json else "auto"))


if __name__ == "__main__":
    main()
