"""Operator 9: line deduplication with a log-template tree. DataFrame functions only.

The tree has a fixed depth: token count, then the leading tokens, a token with a digit standing for any
token. A leaf holds templates. A line's templates are its tokens with variable fields (tokens with a digit)
generalised, and, for long lines, the same with either half left open: a line that differs from another
in one half only still meets it in the other. A template that recurs in enough documents is
boilerplate: its first occurrence stays, later ones are dropped.

With ``whole``, lines also meet as they are, numbers and all: those too short for a template in as many
documents as a template needs, long ones from the second document on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

DEPTH, MIN_TOKENS, MIN_DOCS, HALF_TOKENS = 3, 8, 3, 24
#: For ``whole``: a line of so many tokens goes from so many documents on.
LONG_TOKENS, LONG_DOCS = 20, 2


def _generalised(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), F.lit("<*>")).otherwise(t))


def line_keys(docs: DataFrame, id_col: str, text_col: str, depth: int = DEPTH, min_tokens: int = MIN_TOKENS, half_tokens: int = HALF_TOKENS, whole: bool = False) -> DataFrame:
    """(id, text_hash, line, template) for each template of each line with enough tokens, and with ``whole`` for each short or long line as it is; a long one's ends in a mark."""
    text = common.text_of(text_col)
    lines = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n", -1)).alias("line", "words"))
    lines = lines.withColumn("tokens", F.filter(F.split("words", r"[\x20\x09-\x0D]+"), lambda t: t != ""))
    lines = lines.where(F.size("tokens") >= (1 if whole else min_tokens)).withColumn("n", F.size("tokens"))
    if whole:
        exact = F.unhex(F.md5(F.concat_ws("\n", F.lit("exact"), F.concat_ws(" ", "tokens"))))
        lines = lines.withColumn("exact", F.when(F.col("n") >= LONG_TOKENS, F.concat(exact, F.lit(b"L"))).when(F.col("n") < min_tokens, exact))
    lines = lines.withColumn("tokens", F.when(F.col("words").rlike("[0-9]"), _generalised(F.col("tokens"))).otherwise(F.col("tokens"))).drop("words")
    leaf = F.concat_ws(" ", F.col("n").cast("string"), F.slice("tokens", 1, depth))

    def template(kind: str, body: Column) -> Column:
        return F.unhex(F.md5(F.concat_ws("\n", F.lit(kind), leaf, F.concat_ws(" ", body))))

    rest, middle = F.col("n") - depth, (F.col("n") - depth) / 2
    middle = middle.cast("int")
    first, second = F.slice("tokens", depth + 1, middle), F.slice("tokens", F.lit(depth + 1) + middle, rest - middle)
    line = template("whole", F.slice("tokens", depth + 1, rest))
    keys = F.when(F.col("n") >= half_tokens, F.array(line, template("first", first), template("second", second))).otherwise(F.array(line))
    if whole:
        none = F.array().cast("array<binary>")
        keys = F.concat(F.when(F.col("n") >= min_tokens, keys).otherwise(none), F.when(F.col("exact").isNotNull(), F.array("exact")).otherwise(none))
    return lines.select("id", "text_hash", "line", F.explode(keys).alias("template"))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, **tree) -> DataFrame:
    """(id, text_hash, lines): the places of the lines to drop in each document that has any."""
    keys = common.materialise(line_keys(docs, id_col, text_col, **tree), "line-keys")
    place = F.struct(F.col("id").isNull().alias("unknown"), "id", "text_hash", "line").alias("place")
    # first once for each document, then over documents: a hot template is summed up before each shuffle
    per_doc = keys.groupBy("template", "id", "text_hash").agg(F.min("line").alias("line"))
    recurring = per_doc.groupBy("template").agg(F.count(F.lit(1)).alias("n_docs"), F.min(place).alias("first"))
    recurring = recurring.where(F.col("n_docs") >= F.when(F.length("template") > 16, LONG_DOCS).otherwise(min_docs))
    recurring = common.materialise(recurring, "templates")
    hits = keys.join(recurring, "template").where(place != F.col("first"))
    return hits.groupBy("id", "text_hash").agg(F.collect_set("line").alias("lines"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, **tree) -> DataFrame:
    """All columns of ``docs`` with the text without its recurring lines, and n_lines, n_dropped.

    Lines end at a newline; those with fewer than ``min_tokens`` tokens are dropped only with ``whole``. A template recurs from
    ``min_docs`` documents on. With ``whole``, equal lines too short for one do so as well, and equal lines of LONG_TOKENS tokens from LONG_DOCS on. Documents are compared as
    (id, text): rows repeated in full count as one document and are treated alike; a null text has no lines
    to drop and stays null; a null id sorts last. Of a recurring template the occurrence in the smallest id
    stays, so no passage is lost altogether. A document of which nothing would be left is a copy, not one that hosts
    boilerplate: it stays whole, for deduplication of documents to judge. Columns of the table are kept as they are; the two new ones come last, with
    underscores after a name that the table has already. ``lines`` of one document is bounded by its text.
    """
    drops = repeated_lines(docs, id_col, text_col, min_docs, **tree)
    drops = common.materialise(drops.select(F.col("id").alias("__lm_id"), F.col("text_hash").alias("__lm_hash"), F.col("lines").alias("__lm_lines")), "line-drops")
    same = docs[id_col].eqNullSafe(F.col("__lm_id")) & (F.xxhash64(common.text_of(docs[text_col])) == F.col("__lm_hash"))
    out = docs.join(drops.hint("merge"), same, "left")  # one plan at every size
    lines = F.split(F.col(text_col), "\n", -1)
    out = out.withColumn("__lm_kept", F.when(F.col("__lm_lines").isNotNull(), F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("__lm_lines", i)), "\n")))
    cut = F.coalesce(F.col("__lm_kept").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    n_lines, n_dropped = common.free("n_lines", docs.columns), common.free("n_dropped", docs.columns)
    out = out.withColumn(n_lines, F.coalesce(F.size(lines), F.lit(0)).cast("long")).withColumn(n_dropped, F.when(cut, F.size("__lm_lines")).otherwise(F.lit(0)).cast("long"))
    return out.withColumn(text_col, F.when(cut, F.col("__lm_kept")).otherwise(F.col(text_col))).select(*docs.columns, n_lines, n_dropped)


def without_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", **how) -> DataFrame:
    """``line_dedup`` with the columns of ``docs`` alone; the length, if there is such a column, follows the text where it changed."""
    out = line_dedup(docs, id_col, text_col, **how)
    changed = F.col(out.columns[-1]) > 0
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.when(changed, F.length(text_col).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col)))
    return out.select(*docs.columns)
