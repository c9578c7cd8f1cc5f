"""Operator 5: URL filters by rules, then by words in host and path.

Rules decide first. For every other URL, each name of the host and each piece of the path is split into words
by a unigram Viterbi search, whose word counts come from the pages' titles and URLs and from the topic
words below; a multinomial naive Bayes model then scores the words. Its blocked class starts from URLs that
have a topic word, its allowed class from the others, so words that keep such company count as well.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

# The rules of the query (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# Words of sites that training data leaves out.
TOPICS = (
    "adult ads adserver bet bets betting bingo casino casinos clickbait cracked escort escorts gambling hentai jackpot "
    "keygen loans malware nude payday pharmacy phishing pills poker porn roulette sex sexy slots spam spyware torrent "
    "torrents track tracker tracking viagra warez win xxx"
).split()
#: Bounds of the models: words with counts for splitting, tokens with counts for scoring, those of topics first.
WORDS, TOKENS, LONGEST, CACHE = 30_000, 50_000, 20, 200_000


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path as the contract has them; both empty for a null URL or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    return common.ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def match_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does. A rule fits its host and all subdomains."""
    rule = verdict = None
    for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return (rule, verdict) if rules else (F.lit(None).cast("string"), F.lit(None).cast("string"))


class Splitter:
    """Unigram Viterbi over a name's characters; an unknown run of n characters costs as much as a rare word for each."""

    def __init__(self, counts: dict[str, int]):
        total = sum(counts.values()) + 1
        self.cost = {w: math.log(total / n) for w, n in counts.items()}
        self.unknown = math.log(total) + 2.0
        self.known: dict[str, list[str]] = {}

    def split(self, name: str) -> list[str]:
        got = self.known.get(name)
        if got is None:
            if len(self.known) > CACHE:
                self.known.clear()
            got = self.known[name] = self._split(name)
        return got

    def _split(self, name: str) -> list[str]:
        best, back = [0.0] + [math.inf] * len(name), [0] * (len(name) + 1)
        for end in range(1, len(name) + 1):
            for start in range(max(0, end - LONGEST), end):
                word = name[start:end]
                cost = best[start] + self.cost.get(word, self.unknown * len(word))
                if cost < best[end]:
                    best[end], back[end] = cost, start
        out, end = [], len(name)
        while end:
            out.append(name[back[end] : end])
            end = back[end]
        return out[::-1]


def tokens(host: str, path: str, splitter: Splitter) -> list[str]:
    """Words of the host without its top-level name, marked as such, and of the path; numbers as one token."""
    out = [("h:" + w) for name in re.split(r"[^a-z0-9]+", host.rpartition(".")[0]) if name for w in splitter.split(name)]
    for piece in re.split(r"[^a-z0-9]+", path.lower()):
        if piece:
            out += ["p:#"] if piece.isdigit() else [("p:" + w) for w in splitter.split(piece)]
    return out


class Bayes:
    """Multinomial naive Bayes with add-one smoothing over the tokens of two classes."""

    def __init__(self, counts: dict[str, tuple[int, int]], urls: tuple[int, int]):
        size = len(counts) + 1
        blocked, allowed = (sum(c[k] for c in counts.values()) + size for k in (0, 1))
        self.odds = {t: math.log((b + 1) / blocked) - math.log((a + 1) / allowed) for t, (b, a) in counts.items()}
        self.prior = math.log((urls[0] + 1) / (urls[1] + 1))

    def score(self, found: list[str]) -> float:
        return self.prior + sum(self.odds.get(t, 0.0) for t in found)


def word_counts(pages: DataFrame, parts: DataFrame, html_col: str, size: int = WORDS) -> dict[str, int]:
    """Counts of words over all titles and all hyphen- or dot-separated names; topic words count as common ones."""
    titles = pages.select(F.lower(F.regexp_extract(F.coalesce(F.col(html_col), F.lit("")), r"(?is)<title>([^<]*)</title>", 1)).alias("x"))
    names = parts.select(F.concat_ws(" ", "host", F.lower("path")).alias("x"))
    words = titles.unionAll(names).select(F.explode(F.split("x", r"[^a-z]+")).alias("w")).where(F.length("w").between(2, LONGEST))
    rows = words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy(F.col("n").desc(), "w").limit(size).collect()
    counts = {r.w: r.n for r in rows}
    middle = sorted(counts.values())[-max(1, len(counts) // 10)] if counts else 10
    return counts | {w: max(counts.get(w, 0), middle) for w in TOPICS}


def fit(pages: DataFrame, url_col: str, html_col: str) -> tuple[dict[str, int], Bayes]:
    host, path = url_parts(F.col(url_col))
    parts = pages.select(host.alias("host"), path.alias("path"))
    counts = word_counts(pages, parts, html_col)

    def run(batches):
        splitter, topics = Splitter(counts), {"h:" + w for w in TOPICS} | {"p:" + w for w in TOPICS}
        blocked, allowed, n = Counter(), Counter(), [0, 0]

        def out():
            keys = list(blocked.keys() | allowed.keys())
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([blocked[k] for k in keys], pa.int64()), pa.array([allowed[k] for k in keys], pa.int64())], names=["token", "blocked", "allowed"])

        for batch in batches:
            for h, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = tokens(h, p, splitter)
                if not found:
                    continue
                bad = not topics.isdisjoint(found)
                (blocked if bad else allowed).update(found)
                n[not bad] += 1
            if len(blocked) + len(allowed) > 300_000:
                yield out()
                blocked.clear()
                allowed.clear()
        blocked[""], allowed[""] = n
        yield out()

    seen = parts.mapInArrow(run, "token string, blocked long, allowed long").groupBy("token").agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a"))
    rows = seen.orderBy(F.length("token") > 0, ~F.substring("token", 3, LONGEST).isin(*TOPICS), (F.col("a") + F.col("b")).desc(), "token").limit(TOKENS).collect()
    found = {r.token: (r.b, r.a) for r in rows}
    return counts, Bayes({t: c for t, c in found.items() if t}, found.get("", (0, 0)))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, score (log-odds to block; the method's alone).

    A null URL and one without ``://`` have empty host and path, which no rule fits and which has no tokens: it is
    allowed. Repeated rows are judged alike; an empty table gives an empty result. Counts come from all
    pages; the models have a bounded number of entries. Judging is a map over the scan.
    """
    common.arrow_limits(pages.sparkSession, rows=10_000)
    counts, bayes = fit(pages, url_col, html_col)
    host, path = url_parts(F.col(url_col))
    rule, verdict = match_rules(F.col("host"), F.col("path"), rules)
    parts = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    schema = T.StructType([*parts.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches):
        splitter = Splitter(counts)
        for batch in batches:
            scores = [bayes.score(found) if (found := tokens(h, p, splitter)) else None for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=schema.names)

    scored = parts.mapInArrow(run, schema)
    own = F.when(F.col("score") > 0, "block").otherwise("allow")
    return scored.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "score")
