"""Page texts by a pluggable extractor, word boxes, image listings, sheet bounds of bilevel images."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import forms

# A line of a listing, the size of a page and a word with its box in markup.
LISTED = r"^\s*(\d+)\s+\d+\s+image\s+(\d+)\s+(\d+)\s.*?\s(\d+)\s+(\d+)\s+\S+\s+\S+\s*$"
PAGE_SIZE = r'<page width="([\d.]+)" height="([\d.]+)">'
WORD_BOX = r'<word xMin="([\d.]+)" yMin="([\d.]+)" xMax="([\d.]+)" yMax="([\d.]+)">([^<]*)</word>'


def texts(files: DataFrame, extract: Callable[[bytes], str]) -> DataFrame:
    """(path, text) from binary files; what the extractor can't read is an error row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    rows.append((path, extract(bytes(content)).strip(), None))
                except Exception as error:  # the row says so
                    rows.append((path, None, str(error)))
            yield pd.DataFrame(rows, columns=["path", "text", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, text string, error string")


def listed_images(listings: DataFrame, key: str, text: str) -> DataFrame:
    """Width, height and dpi of pages with exactly one image; others have 0, 0 and 0.0."""
    lines = listings.select(key, F.explode(F.split(text, "\n")).alias("line")).where(F.col("line").rlike(LISTED))
    number = lambda k: F.regexp_extract("line", LISTED, k).cast("int")
    rows = lines.select(key, number(1).alias("page"), number(2).alias("w"), number(3).alias("h"), number(4).cast("double").alias("dpi"))
    one = F.col("n") == 1
    per = rows.groupBy(key, "page").agg(F.count(F.lit(1)).alias("n"), F.first("w").alias("w"), F.first("h").alias("h"), F.first("dpi").alias("dpi"))
    return per.select(key, "page", F.when(one, F.col("w")).otherwise(0).alias("width"), F.when(one, F.col("h")).otherwise(0).alias("height"), F.when(one, F.col("dpi")).otherwise(0.0).alias("dpi"))


def word_boxes(pages: DataFrame, key: str, markup: str) -> DataFrame:
    """(key, n, text, box) of each word in a page's markup, numbered from 0, in fractions of the page; a page without a size has no words."""
    size = [F.regexp_extract(markup, PAGE_SIZE, i).try_cast("double") for i in (1, 2)]
    sized = pages.select(key, markup, size[0].alias("_w"), size[1].alias("_h")).where("_w > 0 AND _h > 0")
    parts = F.arrays_zip(*(F.regexp_extract_all(F.col(markup), F.lit(WORD_BOX), F.lit(i)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1", "text"), 1)))
    words = sized.select(key, "_w", "_h", F.posexplode(parts).alias("n", "p"))
    side = lambda name, whole: F.col(f"p.{name}").try_cast("double") / F.col(whole)
    return words.select(key, "n", F.col("p.text").alias("text"), S.box(side("x0", "_w"), side("y0", "_h"), side("x1", "_w"), side("y1", "_h")).alias("box"))


def bounds_of(image: np.ndarray, bright: int = 128) -> tuple[int, int, int, int] | None:
    """The box of rows and columns more than half of which is bright; none for a dark image."""
    lit = image >= bright
    rows, columns = np.flatnonzero(lit.mean(axis=1) > 0.5), np.flatnonzero(lit.mean(axis=0) > 0.5)
    return (int(columns[0]), int(rows[0]), int(columns[-1]) + 1, int(rows[-1]) + 1) if len(rows) and len(columns) else None


def read_pgm(content: bytes) -> np.ndarray:
    """A binary greyscale image: P5, width, height, 255, pixels."""
    parts = content.split(None, 4)
    if parts[0] != b"P5" or parts[3] != b"255":
        raise ValueError("not an 8-bit P5 image")
    w, h = int(parts[1]), int(parts[2])
    return np.frombuffer(content[len(content) - w * h :], np.uint8).reshape(h, w)


def sheet_bounds(files: DataFrame) -> DataFrame:
    """The sheet's box in each image, null where there is none or the image can't be read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    box = bounds_of(read_pgm(bytes(content)))
                except (ValueError, IndexError):
                    box = None
                rows.append((path, *(box or (None,) * 4)))
            yield pd.DataFrame(rows, columns=["path", "l", "t", "r", "b"]).astype({c: "Int64" for c in "ltrb"})

    return files.select("path", "content").mapInPandas(run, "path string, l long, t long, r long, b long")


def eligible(form_class: Column, part: Column, is_oversize: Column) -> Column:
    """Completion faces that bear data and aren't oversize."""
    return form_class.isin(*forms.COMPLETIONS) & part.isin("face", "sec_ii", "sec_iii", "continuation") & ~F.coalesce(is_oversize, F.lit(False))


def search_items(text: Column) -> Column:
    """k=v pairs as a map; a pair without = is left out, the last of equal keys wins."""
    pairs = F.filter(F.split(text, ";"), lambda p: p.contains("="))
    entries = F.transform(pairs, lambda p: F.struct(F.trim(F.substring_index(p, "=", 1)).alias("k"), S.clean(F.regexp_replace(p, "^[^=]*=", "")).alias("v")))
    last = F.aggregate(entries, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")), lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e["k"]), F.create_map(e["k"], e["v"])))
    return last
