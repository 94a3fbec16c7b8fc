"""Optional adapters at the edge: PDF text, tables and recognition.  All other code starts from page text.

The libraries are looked for where they are used, on the executors; without them a page row
carries an error instead of a text, and the job goes on.
"""

from __future__ import annotations

import importlib.util
import io
import shutil
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..options import DEFAULT, Options

PAGES = "doc_id string, page_num int, text string, error string"
#: Recognised pages, with the time that each took.
RECOGNISED = f"{PAGES}, seconds double"
TABLES = "doc_id string, page_num int, strategy int, table_idx int, cells array<array<string>>"
LAYOUT_WORDS = "doc_id string, page_num int, page_width int, text string, left int, top int, width int, height int, conf int, line_num int, block_num int"
#: Table strategies, each used only where the ones before found nothing.
STRATEGIES = (None, {"vertical_strategy": "lines", "horizontal_strategy": "lines", "snap_tolerance": 5, "intersection_tolerance": 15}, {"vertical_strategy": "text", "horizontal_strategy": "text"})


def scan_folder(spark: SparkSession, folder: str) -> DataFrame:
    """PDF files of a folder, not below it, each once."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{pdf,PDF}").option("recursiveFileLookup", "false").load(folder)
    # One glob lists a file once; contents aren't shuffled.
    return files.withColumn("doc_id", F.regexp_extract("path", r"([^/]+)$", 1))


def capabilities() -> dict[str, bool]:
    """Which libraries and programs are here."""
    have = lambda m: importlib.util.find_spec(m) is not None
    out = {"pdf_text": have("pdfplumber"), "pdf2image": have("pdf2image"), "pytesseract": have("pytesseract"), "tesseract": bool(shutil.which("tesseract")), "poppler": bool(shutil.which("pdftoppm"))}
    return out | {"available": all(out[k] for k in ("pdf2image", "pytesseract", "tesseract", "poppler"))}


def executor_capabilities(spark: SparkSession) -> DataFrame:
    """The same as one executor sees it."""

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _ in batches:
            yield pd.DataFrame([capabilities()])

    return spark.range(1, numPartitions=1).mapInPandas(probe, ", ".join(f"{k} boolean" for k in capabilities()))


def page_texts(files: DataFrame) -> DataFrame:
    """A row a page with its text layer; a file that can't be opened is one row with an error."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, content in zip(b["doc_id"], b["content"], strict=True):
                try:
                    import pdfplumber

                    with pdfplumber.open(io.BytesIO(content)) as pdf:
                        rows += [(doc_id, n, page.extract_text() or "", None) for n, page in enumerate(pdf.pages, 1)]
                except Exception as e:  # a broken file mustn't fail the job
                    rows.append((doc_id, None, "", f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["doc_id", "page_num", "text", "error"]).astype({"page_num": "Int32"})

    return files.select("doc_id", "content").mapInPandas(read, PAGES)


def page_tables(files: DataFrame) -> DataFrame:
    """Tables of each page by the first strategy that finds any."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, content in zip(b["doc_id"], b["content"], strict=True):
                try:
                    import pdfplumber

                    with pdfplumber.open(io.BytesIO(content)) as pdf:
                        for n, page in enumerate(pdf.pages, 1):
                            for k, settings in enumerate(STRATEGIES):
                                try:
                                    tables = page.extract_tables(settings) if settings else page.extract_tables()
                                except Exception:  # the next strategy may do
                                    tables = []
                                if tables:
                                    rows += [(doc_id, n, k, i, x) for i, x in enumerate(tables)]
                                    break
                except Exception:
                    continue
            yield pd.DataFrame(rows, columns=["doc_id", "page_num", "strategy", "table_idx", "cells"])

    return files.select("doc_id", "content").mapInPandas(read, TABLES)


def recognise(files: DataFrame, pages: DataFrame, o: Options = DEFAULT, preprocess: bool = False, enhanced: bool = False) -> DataFrame:
    """Recognised text of the pages asked for (doc_id, page_num); a short text is tried again at other resolutions.

    enhanced: once, at a high resolution, as one block of a sharpened grey image of double contrast.
    """
    wanted = files.select("doc_id", "content").join(pages.select("doc_id", "page_num").distinct(), "doc_id")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, content, n in zip(b["doc_id"], b["content"], b["page_num"], strict=True):
                began = time.perf_counter()
                try:
                    import pytesseract
                    from pdf2image import convert_from_bytes

                    def text_at(dpi: int, content=content, n=int(n)) -> str:
                        image = convert_from_bytes(content, first_page=n, last_page=n, dpi=dpi)[0]
                        if enhanced:
                            return pytesseract.image_to_string(enhance(image), config="--oem 3 --psm 6")
                        return pytesseract.image_to_string(prepare(image) if preprocess else image)

                    text, error = text_at(o.enhanced_dpi) if enhanced else best_text(text_at, o), None
                except Exception as e:
                    text, error = "", f"{type(e).__name__}: {e}"
                rows.append((doc_id, int(n), text, error, time.perf_counter() - began))
            yield pd.DataFrame(rows, columns=["doc_id", "page_num", "text", "error", "seconds"])

    return wanted.mapInPandas(read, RECOGNISED)


def layout_words(files: DataFrame, pages: DataFrame, o: Options = DEFAULT) -> DataFrame:
    """Words with their boxes on the pages asked for (doc_id, page_num), read from the prepared image; a page that fails has none."""
    wanted = files.select("doc_id", "content").join(pages.select("doc_id", "page_num").distinct(), "doc_id")
    names = [x.split()[0] for x in LAYOUT_WORDS.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, content, n in zip(b["doc_id"], b["content"], b["page_num"], strict=True):
                try:
                    import pytesseract
                    from pdf2image import convert_from_bytes

                    image = prepare(convert_from_bytes(content, first_page=int(n), last_page=int(n), dpi=o.dpi)[0])
                    data = pytesseract.image_to_data(image, config="--psm 6", output_type=pytesseract.Output.DICT)
                    rows += [(doc_id, int(n), image.width, *w) for w in words_of(data)]
                except Exception:
                    continue
            yield pd.DataFrame(rows, columns=names)

    return wanted.mapInPandas(read, LAYOUT_WORDS)


def words_of(data: dict) -> list[tuple]:
    """Words that aren't blank from columns of recognised boxes: text, left, top, width, height, conf, line_num, block_num."""
    boxes = zip(*(data[k] for k in ("text", "left", "top", "width", "height", "conf", "line_num", "block_num")), strict=True)
    return [(text.strip(), *map(int, at), int(float(conf)), int(line), int(block)) for text, *at, conf, line, block in boxes if text.strip()]


def best_text(text_at, o: Options = DEFAULT) -> str:
    """Text at the usual resolution; if it is short, the first retry that gives more."""
    text = text_at(o.dpi)
    if len(text.strip()) >= 50:
        return text
    for dpi in o.retry_dpis if o.dpi == 200 else (200, 150, 250):
        try:
            again = text_at(dpi)
        except Exception:
            continue
        if len(again.strip()) > len(text.strip()):
            return again
    return text


def prepare(image):
    """Grey, adaptive threshold and median blur; the image itself without the library."""
    if importlib.util.find_spec("cv2") is None:
        return image
    import cv2
    import numpy as np
    from PIL import Image

    grey = cv2.cvtColor(np.array(image), cv2.COLOR_RGB2GRAY)
    sharp = cv2.adaptiveThreshold(grey, 255, cv2.ADAPTIVE_THRESH_GAUSSIAN_C, cv2.THRESH_BINARY, 11, 2)
    return Image.fromarray(cv2.medianBlur(sharp, 3))


def enhance(image):
    """Grey, double contrast, sharpened; the image itself without the library."""
    if importlib.util.find_spec("PIL") is None:
        return image
    from PIL import ImageEnhance, ImageFilter

    return ImageEnhance.Contrast(image.convert("L")).enhance(2.0).filter(ImageFilter.SHARPEN)
