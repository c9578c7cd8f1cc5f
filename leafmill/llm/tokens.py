"""Operator 1: token counts with a whole-token shortcut.

The vocabulary is a merge-based one with an identity normaliser: a space becomes the marker U+2581, one
marker is put in front, and no vocabulary string holds a marker after another character. A merge can
therefore never join a character with the marker after it, so a text's tokens are those of its
pre-tokens (a run of markers with what follows), one after another. ``whole_tokens`` proves, before any text
is read, which vocabulary strings the library gives back as one token; such a pre-token costs one token
without any merging. Only the others are merged, each distinct one once per worker's cache.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import common

MARK = "▁"
#: Distinct pre-tokens a worker remembers before it starts afresh.
CACHE = 400_000


@lru_cache(maxsize=2)
def _model(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    plain = [p for i, p in enumerate(pieces) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    if any(MARK in p.lstrip(MARK) for p in plain) or model.encode("a ﬁ  b ", out_type=str) != model.encode("a ﬁ", out_type=str) + model.encode(" b", out_type=str) + [MARK]:
        raise ValueError("this vocabulary joins tokens across spaces: pre-tokens can't be counted apart")
    return model, plain


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings, without their leading marker, that the library encodes alone as that one token."""
    model, plain = _model(path)
    words = [p[1:].replace(MARK, " ") for p in plain if p[0] == MARK and len(p) > 1]
    return frozenset(w for w, got in zip(words, model.encode(words, out_type=str), strict=True) if got == [MARK + w.replace(" ", MARK)])


class _Counter:
    def __init__(self, path: str):
        self.model = _model(path)[0]
        self.whole = dict.fromkeys(whole_tokens(path), 1)
        self.cost = dict(self.whole)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if MARK in text:
            text = text.replace(MARK, " ")
        seen = Counter(text.split(" "))
        if "" in seen:  # runs of spaces, or one at an end: a pre-token keeps all but one of its markers
            seen = Counter(x[1:] for x in re.findall(r" +[^ ]*", " " + text))
        cost = self.cost
        new = [x for x in seen if x not in cost]
        if new:
            if len(cost) > CACHE:
                cost = self.cost = dict(self.whole)
                new = [x for x in seen if x not in cost]
            # an empty rest is a lone marker, which the library leaves out for an empty text but not inside one
            cost.update((x, len(ids) if x else 1) for x, ids in zip(new, self.model.encode(new, num_threads=1), strict=True))
        return sum(n * cost[x] for x, n in seen.items())


@lru_cache(maxsize=2)
def _counter(path: str) -> _Counter:
    return _Counter(path)


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens, over_limit.

    A null text counts as empty (0 bytes, 0 tokens); null ids and repeated rows stay as they are; other
    columns are not read; an empty table gives an empty result. No shuffle: a map over the scan.
    """
    common.arrow_limits(docs.sparkSession)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches):
        counter = _counter(model_path)
        for batch in batches:
            texts = batch.column(1)
            counts = pa.array([counter.count(x) for x in texts.to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.cast(pc.binary_length(texts), pa.int64()), counts, pc.greater(counts, limit)], names=schema.names)

    return docs.select(id_col, common.text_of(text_col)).mapInArrow(run, schema)
