"""Sinks: appends, overwrites, guards, sealed and nested outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Filled(RuntimeError):
    """A sheet that someone has filled in isn't overwritten."""


def append_jsonl(df: DataFrame, path: str) -> None:
    """K1, K3"""
    df.write.mode("append").json(path)


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """K2"""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def cache_put(responses: DataFrame, path: str) -> None:
    """K3: what was cut off isn't stored."""
    responses.where("stop_reason IS NULL OR stop_reason <> 'max_tokens'").write.mode("append").parquet(path)


def filled_rows(sheet: DataFrame, columns: list[str]) -> int:
    missing = [c for c in columns if c not in sheet.columns]
    if missing:
        raise KeyError(f"columns {missing} aren't in the sheet")
    some = F.lit(False)
    for c in columns:
        some = some | (F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "")
    return sheet.where(some).count()


def refuse_if_filled(sheet: DataFrame, columns: list[str]) -> None:
    """K4"""
    n = filled_rows(sheet, columns)
    if n:
        raise Filled(f"{n} rows are filled in")


def extend(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """K5: the old rows untouched, then those of ``new`` that aren't among them."""
    return old.unionByName(new.join(old.select(*key), key, "left_anti"))


def sealed(df: DataFrame, columns: list[str]) -> DataFrame:
    """K7: each row with a SHA-256 of its columns as JSON, sorted by name."""
    return df.withColumn("seal", F.sha2(F.to_json(F.struct(*(F.col(c) for c in sorted(columns)))).cast("binary"), 256))


def broken_seals(df: DataFrame, columns: list[str]) -> DataFrame:
    return sealed(df.withColumnRenamed("seal", "_was"), columns).where("seal <> _was").drop("_was")


def write_template(df: DataFrame, path: str, key: list[str]) -> None:
    """K6: one JSON document per key; only partitions that ``df`` has are replaced."""
    body = df.select(*key, F.to_json(F.struct(*df.columns)).alias("value"))
    body.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*key).text(path)


def write_sheet(df: DataFrame, path: str) -> None:
    """K9: quotes are doubled, as ``read_sheet`` reads them."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
