"""The corpus pipeline: toxic documents go, recurring lines go, near copies go, sources are mixed, the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is stored before the next stage reads
it; all but the last return the columns of documents. ``run`` stores them in the folder of ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from leafmill.llm import common, jaccard, linededup, mixing, packing, toxicity

#: Working tables of the last stage: its result is stored when the next one starts, so they go then.
_behind: list[str] = []


def stage(run):
    @functools.wraps(run)
    def wrapped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.release(spark, _behind)
        since = len(common.tables())
        out = run(spark, docs, sf_dir)
        _behind[:] = common.tables(since)
        return out

    return wrapped


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents predicted toxic go.

    A null or empty text is scored as an empty one, a text of any length as a whole; equal texts share a score, so
    repeated rows go or stay together; without labels of both kinds all scores are equal. An empty table stays
    empty, and every column, score and predicted included, is kept as it is.
    """
    return toxicity.without_toxic(docs, common.table(spark, sf_dir, "labels"))


@stage
def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: later occurrences of recurring lines go from the texts; n_chars, if there, follows. No document goes.

    A null text stays null and an empty one empty; of documents that tie the one with the smallest id, then hash, keeps
    the line; rows repeated in full are treated alike; a null id comes last. Other columns are kept, whatever their names.
    """
    return linededup.without_lines(docs)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of each group of linked documents the one with the smallest id stays.

    Null, empty and blank texts are linked with nothing; a null id comes after all others; of rows repeated with id and
    text one stays. Ids are of any type that has an order. Other columns are kept, whatever their names.
    """
    return jaccard.keep_one(docs)


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: each document as often as the mix takes it, from not at all to twice. Reruns agree.

    Null and empty texts have no words and are taken by chance; a null source is a source; rows repeated in full are
    mixed as rows of their own. An empty table stays empty. Other columns are kept, whatever their names.
    """
    return mixing.mixed(docs)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: the mix as sequences of at most 2048 tokens, a row a piece.

    A null or empty text is its end mark alone; a very long one is cut; repeated rows and null ids are packed as rows of
    their own; an empty table gives no rows; columns other than doc_id and text aren't read.
    """
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_recurring_lines), ("jaccard_join", drop_near_copies), ("mix_sources", mix), ("best_fit_packing", pack)]
#: No SQL: scores come from a trained model and packing from a search. Tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is stored and read again, and the tables that a stage worked with go."""
    docs = common.table(spark, sf_dir, "documents")
    kept = []
    for name, apply in STAGES:
        path = f"{common.shared_dir(spark)}/leafmill-pipeline/{name}-{spark.sparkContext.applicationId}-{common.uuid.uuid4().hex}"
        out = apply(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        kept.append(path)
    common.release(spark, _behind)
    for path in kept[:-1]:
        common.delete(spark, path)
    return docs
