"""Operator 10: improbable-feature digests.

Every 64-byte window of a text has an entropy, and an entropy has a rank: how often windows of the corpus have
it, the rarest first. Of each 64 neighbouring windows the one with the lowest rank gets a vote; windows
with enough votes are the text's features. Each feature sets five bits of a 2048-bit Bloom filter, and a
filter that has 160 features is followed by the next in the chain. Two chains are alike by the bits their filters
have in common, less what chance would give, against what they could have in common.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from . import common

WINDOW, NEIGHBOURS, VOTES = 64, 64, 8
BITS, HASHES, FEATURES = 2048, 5, 160
#: Entropies are kept as 0 to LEVELS; windows below LEAST (runs of few bytes) are no features while others are.
LEVELS, LEAST, CHANCE = 1000, 100, 0.1
_UNIT = 1 << 20
#: count * log2(count) as whole numbers: sums don't depend on their order.
_G = np.array([0] + [round(c * np.log2(c) * _UNIT) for c in range(1, WINDOW + 1)], np.int64)
_STEP = np.diff(_G)
_ODD = (np.random.default_rng(64).integers(0, 2**63, 8).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_BLOCK = 1 << 16
#: Ids drawn, by hash, for each boundary between ranges, on average.
SAMPLE = 16


def _near_counts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each byte is among the 63 before it, and among the 63 after it."""
    n, reach = len(x), WINDOW - 1
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for at in range(0, n, _BLOCK):
        lo, hi = max(0, at - reach), min(n, at + _BLOCK + reach)
        y = x[lo:hi]
        b, a = np.zeros(len(y), np.uint8), np.zeros(len(y), np.uint8)
        for k in range(1, min(reach, len(y) - 1) + 1):
            same = (y[k:] == y[:-k]).view(np.uint8)
            b[k:] += same
            a[:-k] += same
        end = min(n, at + _BLOCK)
        before[at:end], after[at:end] = b[at - lo : end - lo], a[at - lo : end - lo]
    return before, after


def window_entropies(x: np.ndarray) -> np.ndarray:
    """The entropy level of the window that starts at each place; none for fewer than 64 bytes."""
    if len(x) < WINDOW:
        return np.zeros(0, np.int64)
    before, after = _near_counts(x)
    first = _G[np.bincount(x[:WINDOW], minlength=256)].sum()
    moves = _STEP[before[WINDOW:]] - _STEP[after[: len(x) - WINDOW]]
    total = np.concatenate([[first], first + np.cumsum(moves)])
    top = 6 * WINDOW * _UNIT
    return (top - total) * LEVELS // top


def text_levels(texts: list[bytes]) -> tuple[np.ndarray, list[slice]]:
    """The levels of all windows of the texts laid end to end, and which of them lie within each text."""
    levels, parts, at = window_entropies(np.frombuffer(b"".join(texts), np.uint8)), [], 0
    for text in texts:
        parts.append(slice(at, max(at, at + len(text) - WINDOW + 1)))
        at += len(text)
    return levels, parts


def entropy_ranks(docs: DataFrame, text_col: str = "text") -> tuple[list[int], int, int]:
    """The rank of each entropy level over every window of every whole text, rarest first; the bytes and the number of texts.

    Whole numbers of windows are summed up, so the ranks depend on the texts alone, not on how the table lies in files.
    """
    common.arrow_limits(docs.sparkSession)

    def run(batches):
        seen, size, rows = np.zeros(LEVELS + 1, np.int64), 0, 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            size, rows = size + sum(map(len, texts)), rows + len(texts)
            levels, parts = text_levels(texts)
            inside = np.zeros(len(levels), bool)
            for part in parts:
                inside[part] = True
            seen += np.bincount(levels[inside], minlength=LEVELS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(LEVELS + 1), [-1, -2])), pa.array(np.append(seen, [size, rows]))], names=["level", "n"])

    got = docs.select(common.text_of(text_col).cast("binary")).mapInArrow(run, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()
    counts = {r.level: r.n for r in got}
    # levels that stand for runs of few bytes come last: they say little, however rare they are
    order = sorted(range(LEVELS + 1), key=lambda v: (v < LEAST, counts.get(v, 0), v))
    ranks = [0] * (LEVELS + 1)
    for rank, level in enumerate(order):
        ranks[level] = rank
    return ranks, counts.get(-1, 0), counts.get(-2, 0)


def _features(x: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Places of the windows with enough votes; ``ranks`` has one number for each window."""
    n = len(ranks)
    if n <= NEIGHBOURS:
        return np.array([int(np.argmin(ranks))])
    key = (ranks << np.int64(40)) | np.arange(n)
    pad = -n % NEIGHBOURS
    blocks = np.append(key, np.full(pad, np.iinfo(np.int64).max)).reshape(-1, NEIGHBOURS)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    best = np.minimum(behind[: n - NEIGHBOURS + 1], ahead[NEIGHBOURS - 1 : n])
    place, votes = np.unique(best & ((1 << 40) - 1), return_counts=True)
    chosen = place[votes >= VOTES]
    return chosen if len(chosen) else place[[int(np.argmax(votes))]]


def _hashes(x: np.ndarray, places: np.ndarray) -> np.ndarray:
    rows = np.lib.stride_tricks.sliding_window_view(x, WINDOW)[places]
    mixed = np.ascontiguousarray(rows).view("<u8")
    h = ((mixed ^ (mixed >> np.uint64(29))) * _ODD).sum(axis=1, dtype=np.uint64)
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(odd)
    return h ^ (h >> np.uint64(31))


def _chain(x: np.ndarray, levels: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The text's Bloom filters as rows of 256 bytes; ``levels`` are its windows' entropies."""
    if not len(x):
        return np.zeros((0, BITS // 8), np.uint8)
    if len(x) < WINDOW:  # the whole text is the feature
        h = np.array([int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "little")], np.uint64)
    else:
        h = _hashes(x, _features(x, ranks[levels]))
        _, first = np.unique(h, return_index=True)
        h = h[np.sort(first)]
    bits = np.zeros((-(-len(h) // FEATURES), BITS), np.uint8)
    row = np.arange(len(h)) // FEATURES
    for k in range(HASHES):
        bits[row, ((h >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = 1
    return np.packbits(bits, axis=1)


def chains(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """The chain of each text; entropies are found over all of them at once."""
    levels, parts = text_levels(texts)
    return [_chain(np.frombuffer(text, np.uint8), levels[part], ranks) for text, part in zip(texts, parts, strict=True)]


def write(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, BITS // 8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: for each filter of the shorter chain its best overlap with one of the other, on average."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    a, b = a.view("<u8"), b.view("<u8")
    in_a, in_b = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (a, b))
    total = 0.0
    for row, n in zip(a, in_a, strict=True):
        both = np.bitwise_count(row & b).sum(axis=1, dtype=np.int64)
        most, chance = np.minimum(n, in_b), n * in_b / BITS
        cut = chance + CHANCE * (most - chance)
        total += float(np.max(np.where(both > cut, (both - cut) / np.maximum(most - cut, 1e-9), 0.0)))
    return min(1.0, total / len(a))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: list[int] | None = None) -> DataFrame:
    """(id, fingerprint) per row: a map over the scan. Null counts as empty, whose fingerprint is an empty string."""
    ranks = entropy_ranks(docs, text_col)[0] if ranks is None else ranks
    common.arrow_limits(docs.sparkSession)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("fingerprint", T.StringType())])

    def run(batches):
        rank = np.array(ranks, np.int64)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([write(c) for c in chains(batch.column(1).to_pylist(), rank)])], names=schema.names)

    return docs.select(id_col, common.text_of(text_col).cast("binary")).mapInArrow(run, schema)


def neighbour_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_mb: float = 24) -> DataFrame:
    """One row per row of ``docs``: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is that with the next larger id, after the last one the first; a null id comes after all others,
    equal ids are ordered by a hash of their text, and repeated rows follow one another. Ids may be of any type that
    has an order. A single document is its own next one; a null text counts as empty; other columns aren't read, and an
    empty table gives no rows. Whole texts move once, compressed, into ranges of
    (id, hash) of about ``part_mb``, rows that repeat within a batch as one with their number; the first document of each
    range also goes to the range before it, so no task sees more than its range. The driver gets a boundary and a
    first id for each range and SAMPLE ids a range to find them, never one for each document.
    """
    import zstandard

    spark = docs.sparkSession
    ranks, size, n_rows = entropy_ranks(docs, text_col)
    rows = docs.select(F.col(id_col).alias("id"), common.text_of(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    parts = max(1, min(50_000, int(size / (part_mb * 2**20)) + 1))
    bounds: list[tuple] = []
    if parts > 1:
        share = min(1.0, SAMPLE * parts / n_rows)
        drawn = rows.where(common.spread(F.struct("id", "h"), 1 << 30, 10) < int(share * 2**30)).select(F.col("id").isNull().alias("unknown"), "id", "h").distinct()
        keys = sorted((r.unknown, not r.unknown and r.id, r.h) for r in drawn.collect())
        bounds = sorted({keys[k * len(keys) // parts] for k in range(1, parts)}) if keys else []
    kinds = f"part int, halo boolean, unknown boolean, id {docs.schema[id_col].dataType.simpleString()}, h long"

    def ranges(batches):
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            part = [bisect.bisect_right(bounds, (i is None, i is not None and i, h)) for i, h in zip(ids, hashes, strict=True)]
            yield batch, pa.array(part, pa.int32()), pa.array(np.zeros(len(part), bool)), batch.column(0).is_null()

    def places(batches):
        for batch, part, no, unknown in ranges(batches):
            yield pa.RecordBatch.from_arrays([part, no, unknown, batch.column(0), batch.column(1)], names=["part", "halo", "unknown", "id", "h"])

    firsts = rows.select("id", "h").mapInArrow(places, kinds).groupBy("part").agg(F.min(F.struct("unknown", "id", "h")).alias("first")).orderBy("part").collect()
    goes: dict[tuple, list[int]] = {}
    for n, r in enumerate(firsts):
        goes.setdefault((r.first.id, r.first.h), []).append(firsts[n - 1].part)

    def deal(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        names = ["part", "halo", "unknown", "id", "h", "packed", "times"]
        for batch, part, no, unknown in ranges(batches):
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            times = Counter(keys)
            once = {k: n for n, k in enumerate(keys)}
            at = pa.array(sorted(once.values()), pa.int64())
            texts = [pack(x) for x in batch.column(2).take(at).to_pylist()]
            own = [*(c.take(at) for c in (part, no, unknown, batch.column(0), batch.column(1))), pa.array(texts, pa.binary()), pa.array([times[keys[n]] for n in at.to_pylist()], pa.int64())]
            yield pa.RecordBatch.from_arrays(own, names=names)
            more = [(p, n) for n, k in enumerate(keys[n] for n in at.to_pylist()) if k in goes for p in goes[k]]
            if more:
                copies = pa.array([n for _, n in more], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in more], pa.int32()), pa.array([True] * len(more)), *(c.take(copies) for c in own[2:])], names=names)

    def compare(batches):
        rank, unpack, kind = np.array(ranks, np.int64), zstandard.ZstdDecompressor().decompress, to_arrow_type(id_type)

        def documents():
            for batch in batches:
                for part, halo, i, packed, times in zip(*(batch.column(n).to_pylist() for n in (0, 1, 3, 5, 6)), strict=True):
                    for _ in range(1 if halo else times):
                        yield part, halo, i, packed

        def groups():
            """Runs of documents that follow one another, the last one only as the next of the one before."""
            held, weight, closed = [], 0, None
            for part, halo, i, packed in documents():
                if part == closed:
                    continue  # a repeated first row: one is enough
                if held and held[-1][0] != part:
                    raise RuntimeError("a range has no following document")
                text = unpack(packed).decode()
                held.append((part, i, text))
                weight += len(text)
                if halo:
                    closed = part
                    yield held
                    held, weight = [], 0
                elif weight > 1 << 19 and len(held) > 1:
                    yield held
                    held, weight = held[-1:], len(text)
            if len(held) > 1 or held and closed != held[0][0]:
                raise RuntimeError("a range has no following document")

        for held in groups():
            texts = [t for _, _, t in held]
            edited = [(t[: len(t) - len(t) // 2] + u[: len(t) // 2]).encode() for t, u in zip(texts, texts[1:], strict=False)]
            got = chains([t.encode() for t in texts] + edited, rank)
            own, new = got[: len(texts)], got[len(texts) :]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for _, i, _ in held[:-1]], kind),
                    pa.array([len(t) for t in texts[:-1]], pa.int64()),
                    pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
                    pa.array([write(c) for c in own[:-1]]),
                    pa.array([write(c) for c in new]),
                    pa.array([likeness(a, b) for a, b in zip(own, new, strict=False)], pa.float64()),
                    pa.array([likeness(a, b) for a, b in zip(own, own[1:], strict=False)], pa.float64()),
                ],
                names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    common.arrow_limits(spark)
    id_type = docs.schema[id_col].dataType
    dealt = rows.select("id", "h", F.col("text").cast("binary")).mapInArrow(deal, kinds + ", packed binary, times long")
    dealt = dealt.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "halo", "unknown", "id", "h")
    out = dealt.mapInArrow(compare, f"id {id_type.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return out.withColumnRenamed("id", id_col)
