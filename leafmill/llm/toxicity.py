"""Operator 6: toxicity by weak supervision.

From labelled rows a lexicon is mined: words and word beginnings that go with the label. Its entries are dealt out to
many voters; others vote on how much of the lexicon a text has, or on patterns of its characters. A generative
label model estimates each voter's rates of voting and of being right, and how voters hang together beyond
the label, from their votes alone; its posterior labels train the linear classifier that scores every text.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Bounds of what fitting looks at: labelled rows mined, rows voted on, lexicon entries.
LABELLED, VOTED, LEXICON = 20_000, 20_000, 6_000
LISTS, LEAST_DOCS, EVIDENCE, PREFIXES, CACHE = 12, 3, 6.0, (4, 5, 6), 400_000
_CLEAR = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else 32 for c in range(256))
PATTERNS = ("shout", "symbols", "capitals")


def words_of(text: str) -> set[bytes]:
    return set(text.lower().encode().translate(_CLEAR).split())


def entries_of(word: bytes) -> list[bytes]:
    """The word, and its beginnings with a mark that no word has."""
    return [word] + [b"^" + word[:k] for k in PREFIXES if len(word) > k]


def patterns_of(text: str) -> list[int]:
    n = len(text) + 1
    marks = sum(text.count(c) for c in "#$%&*")
    return [k for k, found in enumerate((text.count("!") * 50 > n, marks * 25 > n, n > 40 and text.isupper())) if found]


def originals(labelled: DataFrame) -> DataFrame:
    """(id) of one row for each group of copies: a word that only the copies of one text have tells nothing."""

    def run(batches):
        for batch in batches:
            keys = []
            for text in batch.column(1).to_pylist():
                w = text.lower().encode().translate(_CLEAR).split()
                keys.append(min((zlib.crc32(b" ".join(w[i : i + 4])) for i in range(max(1, len(w) - 3))), default=0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64())], names=["id", "sketch"])

    kind = labelled.schema["id"].dataType.simpleString()
    return labelled.select("id", "text").mapInArrow(run, f"id {kind}, sketch long").groupBy("sketch").agg(F.min("id").alias("id")).select("id")


def mine(docs: DataFrame, known: DataFrame, id_col: str, text_col: str, size: int) -> list[tuple[bytes, float]]:
    """The ``size`` entries that tell the labels apart best, with their log-odds: most for label 1, some for label 0."""
    labelled = docs.select(F.col(id_col).alias("id"), common.text_of(text_col).alias("text")).join(F.broadcast(known), "id")
    known = common.materialise(known.join(originals(labelled), "id", "left_semi"), "toxic-originals")
    labelled = docs.select(F.col(id_col).alias("id"), common.text_of(text_col).alias("text")).join(F.broadcast(known), "id")

    def run(batches):
        ones, zeros, n = Counter(), Counter(), [0, 0]
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = {e for w in words_of(text) for e in entries_of(w)}
                (ones if label else zeros).update(found)
                n[label] += 1
            if len(ones) + len(zeros) > 500_000:
                yield from rows(ones, zeros)
                ones, zeros = Counter(), Counter()
        ones[b""], zeros[b""] = n[1], n[0]
        yield from rows(ones, zeros)

    def rows(ones, zeros):
        keys = list(ones.keys() | zeros.keys())
        for at in range(0, len(keys), 50_000):
            part = keys[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([ones[k] for k in part], pa.int64()), pa.array([zeros[k] for k in part], pa.int64())], names=["entry", "ones", "zeros"])

    counts = labelled.select("text", "label").mapInArrow(run, "entry binary, ones long, zeros long").groupBy("entry").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    counts = common.materialise(counts, "toxic-counts")
    totals = counts.where(F.length("entry") == 0).first()
    n1, n0 = (totals.ones, totals.zeros) if totals else (0, 0)
    if not n1 or not n0:
        return []
    odds = F.log((F.col("ones") + 0.3) / (n1 - F.col("ones") + 0.3)) - F.log((F.col("zeros") + 0.3) / (n0 - F.col("zeros") + 0.3))
    # how far the share of label 1 among an entry's documents is from that among all, in standard errors: words are
    # many, so chance alone makes some look telling
    n, p = F.col("ones") + F.col("zeros"), n1 / (n1 + n0)
    z = (F.col("ones") - n * p) / F.sqrt(n * p * (1 - p))
    ranked = counts.where((F.length("entry") > 0) & (n >= LEAST_DOCS)).select("entry", odds.alias("odds"), z.alias("z"))
    ranked = ranked.where(F.abs("z") > EVIDENCE).orderBy(F.col("z").desc(), "entry")
    good, bad = ranked.limit(size).collect(), ranked.where("z < 0").orderBy("z", "entry").limit(size // 10).collect()
    return list(dict([(bytes(r.entry), r.odds) for r in good if r.z > 0] + [(bytes(r.entry), r.odds) for r in bad]).items())


class Finder:
    """Places in the lexicon of what a text has. Words once looked up are remembered up to a bound."""

    def __init__(self, entries: list[bytes]):
        self.place = {e: i for i, e in enumerate(entries)}
        self.known: dict[bytes, tuple[int, ...]] = {}

    def find(self, text: str) -> list[int]:
        known, place, out = self.known, self.place, set()
        if len(known) > CACHE:
            known.clear()
        for w in words_of(text):
            got = known.get(w)
            if got is None:
                got = known[w] = tuple(place[e] for e in entries_of(w) if e in place)
            if got:
                out.update(got)
        return sorted(out)


def votes_of(found: list[list[int]], patterns: list[list[int]], odds: np.ndarray) -> np.ndarray:
    """Rows of votes: 1 toxic, -1 clean, 0 abstains. A list's voter says toxic if the text has any of its entries."""
    strong = np.flatnonzero(odds > 2.0)
    lists = np.full(len(odds), -1)
    lists[strong] = np.arange(len(strong)) % LISTS  # entries are sorted by evidence: each list gets some of each
    clean = odds < 0
    out = np.zeros((len(found), LISTS + 4 + len(PATTERNS)), np.int8)
    for i, (places, marks) in enumerate(zip(found, patterns, strict=True)):
        here = np.array(places, np.int64)
        hits = lists[here][lists[here] >= 0] if len(here) else here
        out[i, hits] = 1
        n = len(hits)
        out[i, LISTS : LISTS + 3] = (1 if n >= 2 else -1, 1 if n >= 4 else -1, 1 if n >= 1 else -1)
        out[i, LISTS + 3] = -1 if len(here) and clean[here].any() else 0
        for k in marks:
            out[i, LISTS + 4 + k] = -1
    return out


class LabelModel:
    """Votes given the unseen label, by expectation maximisation; voters that agree beyond it share their weight."""

    def __init__(self, votes: np.ndarray, prior: float, rounds: int = 30):
        n, m = votes.shape
        seen = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
        self.weights = np.ones(m)
        # where to start: a text with more toxic than clean votes among those that vote at all
        q = np.clip(0.5 + 0.4 * np.sign(votes.sum(axis=1)), 0.05, 0.95)
        self.prior = min(max(prior, 1e-3), 1 - 1e-3)
        for step in range(rounds):
            self.rates = np.stack([(np.tensordot(c, seen, axes=(0, 0)) + 0.5) / (c.sum() + 1.5) for c in (1 - q, q)])
            if step:
                self.correlations = self._correlations(votes, q)
                together = np.maximum(self.correlations, 0)
                np.fill_diagonal(together, 0)
                self.weights = 1 / (1 + together.sum(axis=1))
            q = self._posterior(seen)
        self.accuracy = (seen[:, :, 2] * q[:, None] + seen[:, :, 0] * (1 - q)[:, None]).sum(axis=0) / np.maximum(1, (votes != 0).sum(axis=0))
        self.posterior = q

    def _posterior(self, seen: np.ndarray) -> np.ndarray:
        ratio = np.log(self.rates[1]) - np.log(self.rates[0])
        logit = math.log(self.prior / (1 - self.prior)) + np.einsum("nmv,mv,m->n", seen, ratio, self.weights)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def _correlations(self, votes: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Of what is left of the votes when what the label explains is taken out."""
        mean1, mean0 = (r[:, 2] - r[:, 0] for r in (self.rates[1], self.rates[0]))
        rest = votes - np.outer(q, mean1) - np.outer(1 - q, mean0)
        cov = rest.T @ rest / len(votes)
        scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        return cov / np.outer(scale, scale)


def train_linear(found: list[list[int]], target: np.ndarray, n: int, rounds: int = 300, ridge: float = 2e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on posterior labels over what of the lexicon a text has."""
    row = np.repeat(np.arange(len(found)), [len(f) for f in found])
    col = np.array([i for f in found for i in f], np.int64)
    w, b, gw, gb = np.zeros(n), 0.0, np.full(n, 1e-8), 1e-8
    for _ in range(rounds):
        logit = np.bincount(row, weights=w[col], minlength=len(found)) + b
        rest = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target
        dw = np.bincount(col, weights=rest[row], minlength=n) / len(found) + ridge * w
        db = rest.mean()
        gw, gb = gw + dw**2, gb + db**2
        w, b = w - 0.5 * dw / np.sqrt(gw), b - 0.5 * db / math.sqrt(gb)
    return w, float(b)


class Toxicity:
    """Entries with weights; picklable and of bounded size, so it travels with the tasks."""

    def __init__(self, entries: list[bytes], weights: np.ndarray, bias: float):
        self.entries, self.weights, self.bias = entries, weights, bias

    def scorer(self):
        finder, weights = Finder(self.entries), self.weights

        def score(text: str) -> float:
            places = finder.find(text)
            logit = self.bias + (float(weights[places].sum()) if places else 0.0)
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))

        return score


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", labelled: int = LABELLED, voted: int = VOTED, lexicon: int = LEXICON) -> Toxicity:
    """Learns from a sample by hash of ``labelled`` labelled and ``voted`` other rows at most, none of the held-out fold."""
    common.arrow_limits(docs.sparkSession)
    learnt = labels.where(~common.held_out(id_col) & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    known = common.materialise(learnt.orderBy(F.xxhash64(F.lit(6), "id"), "id").limit(labelled), "toxic-labels")
    prior = known.agg(F.avg("label")).first()[0]
    lex = mine(docs, known, id_col, text_col, lexicon)
    if not lex:
        p = 0.0 if prior is None else prior
        return Toxicity([], np.zeros(0), math.log((p + 1e-3) / (1 - p + 1e-3)))
    entries, odds = [e for e, _ in lex], np.array([o for _, o in lex])
    share = min(1.0, voted / max(1, docs.count()))
    pool = docs.where(~common.held_out(id_col) & (common.spread(id_col, 1 << 20, 7) < int(share * (1 << 20)))).select(F.col(id_col).alias("id"), common.text_of(text_col).alias("text"))

    def look(batches):
        finder = Finder(entries)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([finder.find(t) for t in texts], pa.list_(pa.int32())), pa.array([patterns_of(t) for t in texts], pa.list_(pa.int32()))], names=["id", "found", "patterns"])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = pool.mapInArrow(look, f"id {id_type}, found array<int>, patterns array<int>").orderBy(F.xxhash64(F.lit(8), "id"), "id").limit(2 * voted).collect()
    if not rows:
        return Toxicity(entries, np.zeros(len(entries)), math.log((prior + 1e-3) / (1 - prior + 1e-3)))
    found = [r.found for r in rows]
    model = LabelModel(votes_of(found, [r.patterns for r in rows], odds), prior)
    return Toxicity(entries, *train_linear(found, model.posterior, len(entries)))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = 0.5, keep: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted; with ``keep`` all columns of ``docs`` as they are, then score and
    predicted, with underscores after a name that ``docs`` has already.

    A null text is scored as an empty one; a null id is held out; repeated rows get the same score. Labels that are null
    or neither 0 nor 1 teach nothing; of several labels of a document the largest holds. Without labels of both
    kinds every score is their smoothed share. Scoring is a map over the scan.
    """
    model = fit(docs, labels, id_col, text_col, label_col)

    def run(batches):
        score = model.scorer()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("__lm_text")).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([score(t) for t in texts], pa.float64())], names=[*batch.schema.names[:-1], "__lm_score"])

    base = docs if keep else docs.select(id_col)
    columns = [docs[c] for c in base.columns]
    schema = T.StructType([*base.schema.fields, T.StructField("__lm_score", T.DoubleType())])
    out = docs.select(*columns, common.text_of(docs[text_col]).alias("__lm_text")).mapInArrow(run, schema)
    predicted = (F.col("__lm_score") >= threshold).cast("int")
    if keep:
        score = common.free("score", docs.columns)
        return out.select(*docs.columns, F.col("__lm_score").alias(score), predicted.alias(common.free("predicted", docs.columns)))
    return out.select(id_col, common.held_out(id_col).alias("held_out"), F.col("__lm_score").alias("score"), predicted.alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with its columns; ``how`` as for ``toxicity_scores``."""
    scored = toxicity_scores(docs, labels, keep=True, **how)
    return scored.where(F.col(scored.columns[-1]) == 0).select(*docs.columns)
