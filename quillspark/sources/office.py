"""Office documents: one row for each file, parsed in tasks from their bytes."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text

TYPES = ["txt", "docx", "pptx", "pdf"]
#: Pages with less text than this go to the reader of images.
OCR_BELOW = 50
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"


def _joined(node: ET.Element, tag: str) -> str:
    return "".join(t.text or "" for t in node.iter(tag))


def docx_text(data: bytes) -> str:
    """Paragraphs that aren't blank, then the cells of the tables that aren't, row by row."""
    body = ET.fromstring(zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml")).find(f"{_W}body")
    if body is None:
        return ""
    paragraphs = [_joined(p, f"{_W}t") for p in body.findall(f"{_W}p")]
    cells = ["\n".join(_joined(p, f"{_W}t") for p in c.findall(f"{_W}p")) for t in body.findall(f"{_W}tbl") for c in t.iter(f"{_W}tc")]
    return "\n".join(x for x in paragraphs + cells if x.strip())


def pptx_text(data: bytes) -> str:
    """The texts of the shapes, slide after slide."""
    z = zipfile.ZipFile(io.BytesIO(data))
    slides = sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[0]))
    out = []
    for n in slides:
        for shape in ET.fromstring(z.read(n)).iter("{http://schemas.openxmlformats.org/presentationml/2006/main}txBody"):
            out.append("\n".join(_joined(p, f"{_A}t") for p in shape.findall(f"{_A}p")))
    return "\n".join(x for x in out if x.strip())


def read_office(spark: SparkSession, folder: str, pdf: Callable[[bytes], str] | None = None, ocr: Callable[[bytes, str], str] | None = None) -> DataFrame:
    """doc_id, file_name, page_content, doc_type, file_format, created_at, is_ocr, relative_path, error.

    txt, docx and pptx are read here; `pdf` and `ocr` are given by the caller. A file that fails has its error and
    no text. Text of less than ``OCR_BELOW`` characters is read by `ocr`, if given."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    files = files.withColumn("ext", text.extension(F.col("path"))).where(F.col("ext").isin(TYPES))

    def parse(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        readers = {"txt": lambda b: b.decode("utf-8", "replace"), "docx": docx_text, "pptx": pptx_text, "pdf": pdf or (lambda b: "")}
        for frame in it:
            out = []
            for path, at, ext, data in zip(frame["path"], frame["at"], frame["ext"], frame["content"], strict=True):
                got, error, seen = "", None, False
                try:
                    got = readers[ext](bytes(data))
                except Exception as e:  # noqa: BLE001
                    error = f"{type(e).__name__}: {e}"
                if ocr is not None and ext == "pdf" and len(got.strip()) < OCR_BELOW:
                    seen = True
                    try:
                        got = ocr(bytes(data), ext)
                    except Exception as e:  # noqa: BLE001
                        error = f"{type(e).__name__}: {e}"
                out.append((path, at, ext, got, seen, error))
            yield pd.DataFrame(out, columns=["path", "at", "ext", "raw", "is_ocr", "error"])

    x = files.select("path", F.unix_seconds("modificationTime").alias("at"), "ext", "content").mapInPandas(parse, "path string, at long, ext string, raw string, is_ocr boolean, error string")
    root = re.sub(r"^file:/*", "/", folder).rstrip("/")
    rel = F.regexp_replace(F.regexp_replace("path", "^file:/*", "/"), f"^{re.escape(root)}/", "")
    x = x.withColumn("relative_path", rel).withColumn("page_content", text.clean_text(F.col("raw")))
    x = x.where((F.col("page_content") != "") | F.col("error").isNotNull())
    return x.select(F.md5("relative_path").alias("doc_id"), text.basename(F.col("relative_path")).alias("file_name"), "page_content", text.doc_type(F.col("relative_path")).alias("doc_type"), F.col("ext").alias("file_format"), dates.epoch_to_iso(F.col("at")).alias("created_at"), "is_ocr", "relative_path", "error")
