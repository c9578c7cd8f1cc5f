"""Search, nested exports, byte-bounded batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S


def token_score(text: Column, token: str) -> Column:
    """2 for a whole word, 1 within one, else 0."""
    return F.when(F.array_contains(S.query_tokens(text), token), 2).when(F.contains(F.lower(text), F.lit(token)), 1).otherwise(0)


def search(rows: DataFrame, text: str, query: str) -> DataFrame:
    """Rows that every token hits, with their score. The query's tokens are few, so they become columns, no join."""
    tokens = [t for t in "".join(c if c.isascii() and c.isalnum() else " " for c in query.lower()).split() if t]
    if not tokens:
        return rows.withColumn("score", F.lit(0))
    scores = [token_score(F.col(text), t) for t in tokens]
    hit = F.lit(True)
    for s in scores:
        hit = hit & (s > 0)
    return rows.where(hit).withColumn("score", sum(scores[1:], scores[0]))


def group_order(group: Column, known: list[str]) -> Column:
    """Known groups in their order, others after them by name."""
    place = F.array_position(F.array(*map(F.lit, known)), group)
    return F.struct(F.when(place > 0, place).otherwise(len(known) + 1).alias("p"), group.alias("g"))


def bundle(documents: DataFrame, values: DataFrame, key: str, order: Column, known: list[str]) -> DataFrame:
    """K8: one nested JSON document per key with its values in stable order; a document without values has none."""
    rows = values.select(key, F.struct(group_order(F.col("group"), known).alias("place"), order.alias("ordinal"), "group", "field", "value").alias("v"))
    nested = rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("v")), lambda v: F.struct(v["group"].alias("group"), v["field"].alias("field"), v["value"].alias("value"))).alias("values"))
    out = documents.join(nested, key, "left")
    return out.withColumn("values", F.coalesce("values", F.array().cast(nested.schema["values"].dataType)))


def chunks(requests: DataFrame, group: str, order: str, size: str, most_bytes: int, most_rows: int) -> DataFrame:
    """Numbers of batches within bytes and rows, filled in order; an oversize request goes alone.

    The running sum starts anew with each batch, which no frame expresses; a group is one submission's requests.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        out, batch, rows, total = [], 0, 0, 0
        for n in pdf[size].tolist():
            if rows and (total + n > most_bytes or rows >= most_rows):
                batch, rows, total = batch + 1, 0, 0
            out.append(batch)
            rows, total = rows + 1, total + n
        return pdf.assign(batch=out)

    return requests.groupBy(group).applyInPandas(run, T.StructType([*requests.schema.fields, T.StructField("batch", T.LongType())]))


def attachments(documents: DataFrame) -> DataFrame:
    """P25: (record_id, file_index, page, face, fields) of each page that isn't its document's face, with the fields that agreed for it.

    ``documents`` has record_id, file_index, face, pages and evidence, a map from page to fields; a page without any has none.
    """
    rows = documents.select("record_id", "file_index", "face", "evidence", F.explode("pages").alias("page")).where("page <> face")
    fields = F.coalesce(F.try_element_at("evidence", F.col("page")), F.array().cast("array<string>"))
    return rows.select("record_id", "file_index", "page", "face", fields.alias("fields"))


def evidence_text(fields: Column, face: Column, page: Column, on_face: Column, on_page: Column) -> Column:
    """For each field but the stamps, the printed box on either page, cut at 40 characters, ? where it isn't known."""
    spot = lambda number, found, f: F.concat(F.lit("p"), number.cast("string"), F.lit(" <- "), F.left(F.coalesce(F.try_element_at(found, f), F.lit("?")), F.lit(40)))
    shown = F.filter(fields, lambda f: f != "received_stamps")
    return F.array_join(F.transform(shown, lambda f: F.concat(f, F.lit(": "), spot(face, on_face, f), F.lit(" | "), spot(page, on_page, f))), "; ")


def stamps_text(number: Column, stamps: Column) -> Column:
    """A page's stamps in one line, none where it has none."""
    text = F.array_join(F.transform(stamps, lambda s: F.concat_ws(" ", s["office"], s["date"])), "; ")
    return F.concat(F.lit("p"), number.cast("string"), F.lit(": "), F.coalesce(F.nullif(text, F.lit("")), F.lit("none")))
