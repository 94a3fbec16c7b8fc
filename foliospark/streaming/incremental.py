"""Incremental extraction: page relations arrive as files, results go out with a running summary.

One input row is one document, with all its pages in an array, so every stage before the sink
is stateless.  The checkpoint makes a restart go on where the last run ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as t
from ..operators import metrics as M
from ..operators import pages as P
from ..options import DEFAULT, Options

INPUT = "doc_id string, pages array<struct<page_num:int,text:string>>"


def read(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(INPUT).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def classify_rows(docs: DataFrame, o: Options = DEFAULT) -> DataFrame:
    """The page rollup without a shuffle: from the document's own array."""
    sizes = F.transform("pages", lambda p: F.length(t.strip(t.text_of(p["text"]))))
    n = F.size("pages")
    image = F.size(F.filter(sizes, lambda s: s < o.page_chars))
    total = F.aggregate(sizes, F.lit(0), lambda a, s: a + s)
    return docs.select("doc_id", "pages", n.alias("page_count"), total.cast("long").alias("total_chars"), P.document_type(n - image, image).alias("document_type"))


def start(stream: DataFrame, out: str, checkpoint: str, extract=None) -> StreamingQuery:
    """Each batch writes its results (``extract``: pages relation -> results) and refreshes the summary."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = classify_rows(batch).drop("pages") if extract is None else extract(batch.select("doc_id", F.explode("pages").alias("p")).select("doc_id", "p.*"))
        rows.write.mode("overwrite").parquet(f"{out}/results/batch={batch_id}")
        # Each batch adds its own counts; the summary is made of those, not of all results again.
        done = spark.read.parquet(f"{out}/results/batch={batch_id}")
        own = done.groupBy("document_type").agg(F.count("*").alias("documents")) if extract is None else M.batch_summary(M.flat(done))
        own.coalesce(1).write.mode("overwrite").parquet(f"{out}/counts/batch={batch_id}")
        counts = spark.read.parquet(f"{out}/counts").drop("batch")
        if extract is None:
            summary = counts.groupBy("document_type").agg(F.sum("documents").alias("documents"))
        else:
            summary = M.united_summary(counts)
        summary.coalesce(1).write.mode("overwrite").parquet(f"{out}/summary")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
