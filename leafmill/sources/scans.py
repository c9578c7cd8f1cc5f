"""Sources: manifests, sheets, caches, model responses and page texts as DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

MANIFEST = "record_id string, profile_type string, meta map<string,string>, files array<struct<name:string,pages:int,bytes:bigint,document_type:string,uploaded_on:string>>, fetched_at string"
RESPONSES = "key string, body string, input_tokens bigint, output_tokens bigint, stop_reason string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a declared schema; blank lines give no row."""
    return spark.read.schema(schema).json(path)


def read_sheet(spark: SparkSession, paths: list[str] | str, latin1: bool = False) -> DataFrame:
    """CSV sheets as text, by header; sheets with other columns are united with nulls."""
    out = None
    for path in [paths] if isinstance(paths, str) else paths:
        one = spark.read.option("header", True).option("inferSchema", False).option("multiLine", True).option("escape", '"').option("encoding", "ISO-8859-1" if latin1 else "UTF-8").csv(path)
        one = one.select(*(F.trim(F.col(f"`{c}`")).alias(c.lstrip("﻿").strip()) for c in one.columns))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def read_binary(spark: SparkSession, path: str, magic: bytes | None = None) -> DataFrame:
    """Local copies of downloads with their content hash; those without the magic bytes or of no length go."""
    files = spark.read.format("binaryFile").load(path)
    if magic:
        files = files.where(F.hex(F.substring("content", 1, len(magic))) == magic.hex().upper())
    return files.where(F.octet_length("content") == F.col("length")).withColumn("doc_hash", F.substring(F.sha2("content", 256), 1, 16))


def explode_manifest(manifest: DataFrame) -> DataFrame:
    """Record, file (from 0) and page (from 1); files without pages have none. Adds page_id."""
    files = manifest.select("record_id", F.posexplode("files").alias("file_index", "file"))
    # sequence(1, 0) counts downwards: files without pages are filtered first
    pages = files.where(F.col("file.pages") >= 1).select("record_id", "file_index", F.col("file.pages").alias("pages"), F.explode(F.sequence(F.lit(1), F.col("file.pages"))).alias("page"))
    return pages.withColumn("page_id", S.page_id("record_id", "file_index", "page"))


def latest(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the last by ``order``, which must end in a tie key."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def resume(wanted: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """What isn't there yet."""
    return wanted.join(done.select(*key), key, "left_anti")


def split_pages(files: DataFrame, text: Column, pages: Column, feed: str = "\f") -> DataFrame:
    """A row per page of each file; pages that the text lacks are empty, text past the last page is left out."""
    parts = F.split(text, feed, -1)
    n = F.greatest(pages, F.lit(0))
    return files.select("*", F.posexplode(F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), lambda i: F.coalesce(F.get(parts, i - 1), F.lit("")))).alias("page0", "page_text")).withColumn("page", F.col("page0") + 1).drop("page0")


def cached(rows: DataFrame, version: str, version_col: str = "version") -> DataFrame:
    """Rows of the current detector only; an empty result is still a row."""
    return rows.where(F.col(version_col) == version)


def answered(requests: DataFrame, responses: DataFrame, key: str, provider: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Every request with its response; a miss goes to ``provider`` and else becomes an error row, never none."""
    joined = requests.join(responses.withColumn("_hit", F.lit(True)), key, "left")
    if provider is not None:
        missing = joined.where("_hit IS NULL").select(*requests.columns)
        found = provider(missing).withColumn("_hit", F.lit(True))
        joined = joined.where("_hit").unionByName(missing.join(found, key, "left"), allowMissingColumns=True)
    return joined.withColumn("error", F.when(F.col("_hit").isNull(), F.lit("no response"))).withColumn("cached", F.coalesce("_hit", F.lit(False))).drop("_hit")


def block_children(blocks: DataFrame, kind: str) -> DataFrame:
    """Texts of each block's children in the order of their ids; ids of no block are skipped."""
    links = blocks.where(F.col("kind") == kind).select("id", F.posexplode("child_ids").alias("place", "child"))
    texts = blocks.select(F.col("id").alias("child"), F.col("text").alias("child_text"))
    got = links.join(texts, "child").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("place", "child_text"))).alias("parts"))
    return got.select("id", F.array_join(F.transform("parts", lambda p: p["child_text"]), " ").alias("joined"), F.size("parts").cast("long").alias("n_children"))
