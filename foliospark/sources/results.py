"""Result documents: schema, reading, writing, file names, worksheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..options import DEFAULT, Options

def schema() -> T.StructType:
    """The result document.  Never inferred: all-null and all-empty fields would get wrong types."""
    s, i, d = T.StringType(), T.IntegerType(), T.DoubleType()
    struct = lambda **f: T.StructType([T.StructField(k, v) for k, v in f.items()])
    activity = struct(activity=s, description=s)
    meta = struct(source_file=s, cic36_page=i, cic36_pages_found=T.ArrayType(i), location_confidence=s, extraction_method=s, pages_searched=T.ArrayType(i), extracted_at=s, document_page_count=i, avg_chars_per_page=d, ocr_confidence=s, error=s, traceback=s, processing_time=d)
    return struct(company_number=s, incorporation_date=s, document_type=s, extraction_status=s, section_a=struct(beneficiaries=s), section_b=struct(activities=T.ArrayType(activity), company_differs=s, surplus_use=s), extraction_metadata=meta)


def read_results(spark: SparkSession, path: str, percent: float | None = None, seed: int = 0) -> DataFrame:
    """Result files of a folder (not below it); summaries are left out, unreadable files skipped, top-level lists flattened."""
    from ..operators.sampling import percent_sample

    raw = spark.read.schema(T.StructType([*schema().fields, T.StructField("_corrupt_record", T.StringType())])).json(path, multiLine=True, mode="PERMISSIVE", pathGlobFilter="*.json")
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1)
    out = raw.withColumn("file_name", name).where(~F.col("file_name").startswith("batch_summary") & F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    return out if percent is None else percent_sample(out, percent, ["file_name"], seed)


def read_one(spark: SparkSession, path: str) -> DataFrame:
    """One document; no row if it can't be read."""
    return read_results(spark, path)


def write_results(results: DataFrame, path: str, pretty: bool = False) -> None:
    """JSON lines, or with ``pretty`` one indented file a document, named after its source file.

    The indented form is for export: each task writes its rows through Spark's text sink.
    """
    if not pretty:
        results.write.mode("overwrite").json(path, ignoreNullFields=False)
        return
    stem = file_stem(F.col("extraction_metadata.source_file"))
    results.select(F.to_json(F.struct(*results.columns), {"pretty": "true", "ignoreNullFields": "false"}).alias("value"), stem.alias("document")).write.mode("overwrite").partitionBy("document").text(path)


def write_failed(results: DataFrame, path: str) -> None:
    failed = results.where(F.coalesce("extraction_status", F.lit("")) != "success")
    failed.select(F.coalesce("extraction_metadata.source_file", F.lit(""))).toDF("value").write.mode("overwrite").text(path)


def file_stem(path: Column) -> Column:
    """File name without its last suffix."""
    name = F.regexp_extract(path, r"([^/\\]*)$", 1)
    return F.regexp_replace(name, r"(?s)(?<=.)\.[^.]+$", "")


def parse_file_name(path: Column, o: Options = DEFAULT) -> Column:
    """struct<company_number, incorporation_date, format>: number_newinc_date is modern, a leading number partial, else legacy."""
    stem = file_stem(path)
    modern = r"^([A-Z]{0,2}\d+)_newinc_(\d{4}-\d{2}-\d{2})$"
    number, date = F.regexp_extract(stem, modern, 1), F.regexp_extract(stem, modern, 2)
    partial = F.regexp_extract(stem, o.company_number, 1)
    is_modern, is_partial = number != "", partial != ""
    null = F.lit(None).cast("string")
    return F.struct(
        F.when(is_modern, number).when(is_partial, partial).otherwise(null).alias("company_number"),
        F.when(is_modern, date).otherwise(null).alias("incorporation_date"),
        F.when(is_modern, "modern").when(is_partial, "partial").otherwise("legacy").alias("format"),
    )


def status(success: Column, error: Column) -> Column:
    return F.when(success, "success").when(F.coalesce(error, F.lit("")) != "", "error").otherwise("no_data")


def field(top: Column, activities: Column, name: str) -> Column:
    """The document's own value, else the first activity's that has one."""
    first = F.get(F.filter(activities, lambda a: F.coalesce(a[name], F.lit("")) != ""), F.lit(0))
    return F.coalesce(F.nullif(top, F.lit("")), first[name], F.lit(""))


def read_worksheet(spark: SparkSession, path: str) -> DataFrame:
    """A completed worksheet as CSV with headers; rows without any filled cell go."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    filled = F.exists(F.array(*[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in df.columns]), lambda x: x != "")
    return df.where(filled)


def write_worksheet(sheet: DataFrame, path: str) -> None:
    sheet.write.mode("overwrite").csv(path, header=True, escape='"')
