"""Operator 2: exact Jaccard join of shingle sets in their metric space.

Jaccard distance is a metric. Two sets within ``reach`` of each other share one of their first
shingles in an order of all shingles, the common ones last; each such shingle is a first region. How far back in a set
the shingle stands bounds the size of a partner, so most sets are in a region for a few partners only. In the first
round a few sets of each region become pivots, which settles groups of near copies: sets that links have joined aren't
compared again. A region that is then too large for one task is split by more pivots: a set belongs to its nearest
pivot's Voronoi region, or to the far part if none is near; by the triangle inequality, whatever lies within reach of a
region's set lies within a window around its pivot, so sets in that window are copied into the region, and two home sets
meet in one region only. Regions are split in the same way until what is at home in them fits a task, where
it is joined in memory with the copies, or until a split no longer halves them: then blocks of them meet.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import materialise
from .components import components

SHINGLE, PERCENT, NEAR = 5, 80, 0.4
#: Pivots of each region in the first round, which settles groups of near copies; the least number of pivots that split
#: a region; sets and shingles that are at home in a region which is joined in memory.
FIRST, PIVOTS, CELL, WEIGHT = 2, 8, 512, 2_000_000
#: Shingles put last in the order: the HOT most common ones of those met HOT_LEAST times; any order gives the same links.
HOT, HOT_LEAST = 500_000, 6
#: Bits of a hash that name a first region (names that meet by chance cost comparisons, no link); prefix shingles that are
#: counted by one group; words of a bitmap of 64 rows each that may be broadcast, beyond which keys are joined by a shuffle.
REGION_BITS, PART, WORDS = 40, 1_000_000, 1_000_000
_CHUNK = 2_000_000
_ODD = (np.random.default_rng(5).integers(0, 2**63, 64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)


class _Words(dict):
    """Word hashes, remembered up to a bound of entries and of bytes."""

    def __missing__(self, word):
        import xxhash

        got = xxhash.xxh3_64_intdigest(word)
        if len(word) > 64:
            return got  # long ones are rare and would fill the memory
        if len(self) > 800_000:
            self.clear()
        self[word] = got
        return got


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes, known: _Words, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; of the whole sequence if it is shorter."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.array(list(map(known.__getitem__, words)), np.uint64)
    k = min(width, len(w))
    total = np.full(len(w) - k + 1, k, np.uint64)
    for j in range(k):  # words' hashes are well mixed, so a weighted sum is
        total += w[j : len(w) - k + 1 + j] * _ODD[j]
    return np.unique(_mix(total))


def common_shingles(docs: DataFrame, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """(hash, how common) of shingles that many texts of one stretch of the scan share, summed up over all texts."""

    def run(batches):
        known, seen, held, size = _Words(), set(), [], 0

        def out():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            keep = counts > 1
            return pa.RecordBatch.from_arrays([pa.array(values[keep].view(np.int64)), pa.array(counts[keep])], names=["h", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                got = shingles(text, known)
                key = hashlib.blake2b(got.tobytes(), digest_size=8).digest()
                if key in seen:
                    continue
                seen.add(key)
                held.append(got)
                size += len(got)
                if size > _CHUNK:
                    yield out()
                    seen, held, size = set(), [], 0
        if held:
            yield out()

    counts = docs.select(common.text_of(text_col).cast("binary")).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= HOT_LEAST).orderBy(F.col("n").desc(), "h").limit(HOT).toArrow()
    h, n = top.column("h").to_numpy().astype(np.int64).view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


def prefix(found: np.ndarray, hot: np.ndarray, weight: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first shingles of a set: two sets alike enough share at least one of theirs."""
    return cold_and_hot(found, hot, weight, percent)[0]


def cold_and_hot(found: np.ndarray, hot: np.ndarray, weight: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The first shingles of a set, and how many of them come before the common ones."""
    n = len(found)
    if not n:
        return found, 0
    size = n - -(-percent * n // 100) + 1
    if not len(hot):
        return found[:size], size
    at = np.minimum(np.searchsorted(hot, found), len(hot) - 1)
    is_hot = hot[at] == found
    cold = found[~is_hot]
    if len(cold) >= size:
        return cold[:size], size
    rest = found[is_hot]
    return np.concatenate([cold, rest[np.lexsort((rest, weight[at[is_hot]]))][: size - len(cold)]]), len(cold)


def sketch(found: np.ndarray) -> bytes:
    """How many of the set's hashes fall into each of about n/4 bins: what two sets share is at most the sum of the lesser counts."""
    bins = 64
    while 4 * bins < len(found):
        bins *= 2
    counts = np.bincount((found & np.uint64(bins - 1)).astype(np.int64), minlength=bins)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else b""


def most_shared(a: bytes, b: bytes, na: int, nb: int) -> int:
    """No two sets with these sketches share more."""
    if not a or not b:
        return min(na, nb)
    x, y = (np.frombuffer(v, np.uint8).astype(np.int64) for v in (a, b))
    m = min(len(x), len(y))
    return int(np.minimum(x.reshape(-1, m).sum(axis=0), y.reshape(-1, m).sum(axis=0)).sum())


def document_sets(docs: DataFrame, id_col: str, text_col: str, percent: int = PERCENT) -> DataFrame:
    """(id, row, n, digest, sketch, prefix, cold, packed), stored; ``packed`` is the compressed text.

    ``prefix`` names the first shingles by REGION_BITS of their hashes; the first ``cold`` aren't among the common ones.
    The last four are null where the same set came before in the task, so a hot group of copies has one a task.
    """
    common.arrow_limits(docs.sparkSession)
    hot, weight = common_shingles(docs, text_col)

    def run(batches):
        import zstandard

        known, pack, seen = _Words(), zstandard.ZstdCompressor(level=3).compress, set()
        for batch in batches:
            ns, digests, sketches, prefixes, colds, packed = [], [], [], [], [], []
            for text in batch.column(1).to_pylist():
                found = shingles(text, known)
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                new = len(found) > 0 and digest not in seen
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(digest)
                ns.append(len(found))
                digests.append(digest)
                sketches.append(sketch(found) if new else None)
                first, cold = cold_and_hot(found, hot, weight, percent) if new else (None, None)
                prefixes.append((first >> np.uint64(64 - REGION_BITS)).view(np.int64) if new else None)
                colds.append(cold)
                packed.append(pack(text) if new else None)
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (ns, digests, sketches, prefixes, colds, packed), kinds)], names=["id", "n", "digest", "sketch", "prefix", "cold", "packed"])

    kind = docs.schema[id_col].dataType.simpleString()
    sets = docs.select(F.col(id_col).alias("id"), common.text_of(text_col).cast("binary").alias("text")).mapInArrow(run, f"id {kind}, n long, digest binary, sketch binary, prefix array<long>, cold long, packed binary")
    return materialise(sets.withColumn("row", F.monotonically_increasing_id()), "shingle-sets")


def packed_columns(*columns: np.ndarray) -> bytes:
    """Whole numbers of up to 64 bits, the bytes of each place together and compressed on their own: high ones are alike."""
    import zstandard

    pack, out = zstandard.ZstdCompressor(level=1).compress, []
    for column in columns:
        for place in column.astype("<u8").view(np.uint8).reshape(-1, 8).T:
            out.append(pack(place.tobytes()) if place.any() else b"")
    return np.array([len(x) for x in out], "<u4").tobytes() + b"".join(out)


def unpacked_columns(data: bytes, size: int, columns: int) -> list[np.ndarray]:
    """``columns`` columns of ``size`` numbers, as ``packed_columns`` was given them."""
    import zstandard

    unpack, at, out = zstandard.ZstdDecompressor().decompress, 32 * columns, []
    ends = at + np.cumsum(np.frombuffer(data, "<u4", 8 * columns).astype(np.int64))
    for k in range(columns):
        bytes_of = np.zeros((8, size), np.uint8)
        for j, end in enumerate(ends[8 * k : 8 * k + 8].tolist()):
            if end > at:
                bytes_of[j] = np.frombuffer(unpack(data[at:end]), np.uint8)
            at = end
        out.append(np.ascontiguousarray(bytes_of.T).view("<u8").reshape(-1))
    return out


def shared_prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(region, row, i): the i-th first shingle of a row, if another row has it too and one has it early.

    Most first shingles stand in one row only. So each task sorts its own and sends them, a block for each range of
    hashes, as steps from one to the next with row and place: 5 or 6 bytes a shingle, once. What counts as common is
    met often for certain, is not counted and never meets in one group; of any other shingle a group gets few rows.
    """
    spark = sets.sparkSession
    total = sets.agg(F.sum("cold")).first()[0] or 0
    parts = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // PART + 1)

    def deal(batches):
        held, size = [], 0

        def out():
            v, row, code = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(v, kind="stable")
            v, row, code, base = v[order], row[order], code[order], row.min()
            part = (v * np.uint64(parts)) >> np.uint64(REGION_BITS)
            cuts = np.flatnonzero(np.diff(part, prepend=part[:1] + np.uint64(1)))
            blocks = [slice(*x) for x in zip(cuts.tolist(), [*cuts[1:].tolist(), len(v)], strict=True)]
            data = [packed_columns(np.diff(v[x], prepend=np.uint64(0)), row[x] - base, code[x]) for x in blocks]
            columns = (part[cuts].astype(np.int64), np.full(len(cuts), base, np.int64), [x.stop - x.start for x in blocks])
            return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in columns), pa.array(data, pa.binary())], names=["part", "base", "size", "data"])

        for batch in batches:
            row, n, cold = (batch.column(k).to_numpy() for k in range(3))
            lengths = np.diff(batch.column(3).offsets.to_numpy())
            v = batch.column(3).flatten().to_numpy().view(np.uint64)
            i = np.arange(len(v)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            early = (100 + percent) * (np.repeat(n, lengths) - i) // percent >= 2 * np.repeat(n, lengths)
            keep = i < np.repeat(cold, lengths)
            if keep.any():
                held.append((v[keep], np.repeat(row, lengths)[keep], (2 * i + early)[keep]))
                size += int(keep.sum())
            if size > _CHUNK:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    def meet(key, pdf):
        import pandas as pd

        v, row, code = [], [], []
        for base, size, data in zip(pdf["base"].tolist(), pdf["size"].tolist(), pdf["data"], strict=True):
            steps, rows, codes = unpacked_columns(bytes(data), size, 3)
            v.append(np.cumsum(steps))
            row.append(rows.astype(np.int64) + base)
            code.append(codes.astype(np.int64))
        v, row, code = map(np.concatenate, (v, row, code))
        order = np.argsort(v, kind="stable")
        v, row, code = v[order], row[order], code[order]
        starts = np.flatnonzero(np.diff(v, prepend=v[:1] + np.uint64(1)))
        counts = np.diff(starts, append=len(v))
        keep = np.repeat((counts > 1) & (np.maximum.reduceat(code & 1, starts) > 0), counts)
        return pd.DataFrame({"region": v[keep].astype(np.int64), "row": row[keep], "i": code[keep] >> 1})

    blocks = sets.where("cold > 0").select("row", "n", "cold", "prefix").mapInArrow(deal, "part long, base long, size long, data binary")
    rows = blocks.groupBy("part").applyInPandas(meet, "region long, row long, i long")
    common_ones = sets.where("size(prefix) > cold").select("row", "cold", F.posexplode("prefix").alias("i", "region")).where("i >= cold")
    return rows.unionByName(common_ones.select("region", "row", F.col("i").cast("long")))


def among(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``sets`` whose node is in ``nodes``. Nodes are row numbers, so a bitmap of them is small, and no text is shuffled."""
    here = F.expr("cast(node & 63 AS int)")
    bits = nodes.select(F.expr("shiftright(node, 6)").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), here).alias("bit"))
    words = materialise(bits.groupBy("word").agg(F.bit_or("bit").alias("bits")), "words")
    how = "broadcast" if words.count() <= WORDS else "merge"
    rows = sets.withColumn("word", F.expr("shiftright(node, 6)")).join(words.hint(how), "word")
    return rows.where(F.call_function("shiftright", F.col("bits"), here).bitwiseAND(F.lit(1).cast("long")) == 1).select(*sets.columns)


def _both(pairs: DataFrame, sets: DataFrame, what: str) -> DataFrame:
    """(a, b, upto, na, nb, x, y): each pair with ``what`` of its two sets. The sets are joined once, not once a side."""
    ends = pairs.select("a", "b", "upto", F.explode(F.array("a", "b")).alias("node")).join(sets.select("node", "n", F.col(what).alias("x")), "node")
    first = lambda c, end: F.first(F.when(F.col("node") == F.col(end), F.col(c)), True)
    return ends.groupBy("a", "b").agg(F.first("upto").alias("upto"), first("n", "a").alias("na"), first("n", "b").alias("nb"), first("x", "a").alias("x"), first("x", "b").alias("y")).select("a", "b", "upto", "na", "nb", "x", "y")


def _bounds(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, upto, na, nb, most) for each pair of nodes (a, b, upto), from their sketches."""

    def run(batches):
        for batch in batches:
            na, nb, x, y = (c.to_pylist() for c in batch.columns[3:])
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(list(map(most_shared, x, y, na, nb)), pa.int64())], names=["a", "b", "upto", "na", "nb", "most"])

    return _both(pairs, sets, "sketch").mapInArrow(run, "a long, b long, upto double, na long, nb long, most long")


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, both): the exact size of the intersection for each pair of nodes."""

    def run(batches):
        import zstandard

        known, unpack, held = _Words(), zstandard.ZstdDecompressor().decompress, OrderedDict()

        def set_of(node, packed):
            got = held.get(node)
            if got is None:
                got = held[node] = shingles(unpack(packed), known)
                if len(held) > 64:
                    held.popitem(last=False)
            else:
                held.move_to_end(node)
            return got

        for batch in batches:
            a, b, ta, tb = (batch.column(k).to_pylist() for k in (0, 1, 5, 6))
            both = [len(np.intersect1d(set_of(b[i], tb[i]), set_of(a[i], ta[i]), assume_unique=True)) for i in range(len(a))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both, pa.int64())], names=["a", "b", "both"])

    return _both(pairs, sets, "packed").mapInArrow(run, "a long, b long, both long")


def distances(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, low, high, linked) of pairs (a, b, upto): exact where the sketches leave open that the distance is at most ``upto``."""
    bounds = materialise(_bounds(pairs, sets), "bounds")
    least = 1 - F.col("most") / (F.col("na") + F.col("nb") - F.col("most"))
    unsettled = bounds.where(least <= F.col("upto") + 1e-9)
    exact = _overlaps(unsettled, among(sets, unsettled.select(F.explode(F.array("a", "b")).alias("node"))))
    rows = bounds.join(exact, ["a", "b"], "left")
    either = F.col("na") + F.col("nb") - F.coalesce("both", "most")
    far = 1 - F.coalesce("both", "most") / either
    linked = F.coalesce(F.col("both") * 100 >= either * percent, F.lit(False))
    out = materialise(rows.select("a", "b", far.alias("low"), F.when(F.col("both").isNotNull(), far).otherwise(1.0).alias("high"), linked.alias("linked")), "distances")
    common.discard(bounds)
    return out


def block_links(texts: list[bytes], comps: list[int], left: list[bool], right: list[bool], percent: int, known: _Words) -> list[tuple[int, int]]:
    """Links between the left and the right sets that join components; all intersections at once, by products of matrices."""
    sets = [shingles(t, known) for t in texts]
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[token] > 1
    rows, token = rows[keep], np.unique(token[keep], return_inverse=True)[1]
    a, b = np.flatnonzero(left), np.flatnonzero(right)
    both = np.zeros((len(a), len(b)), np.float32)
    order = np.argsort(token, kind="stable")
    rows, token = rows[order], token[order]
    for at in range(0, int(token[-1]) + 1 if len(token) else 0, 4096):
        part = slice(*np.searchsorted(token, [at, at + 4096]))
        has = np.zeros((len(sets), 4096), np.float32)
        has[rows[part], token[part] - at] = 1
        both += has[a] @ has[b].T
    sizes = np.array([len(x) for x in sets])
    either = sizes[a][:, None] + sizes[b][None] - both
    parent = {c: c for c in comps}

    def find(c):
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    out = []
    for i, j in zip(*np.nonzero(both * 100 >= either * percent), strict=True):
        x, y = find(comps[a[i]]), find(comps[b[j]])
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((int(a[i]), int(b[j])))
    return out


def joined_regions(level: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the links within regions that aren't split further, joined in memory.

    Home sets are dealt to blocks of at most about CELL sets and WEIGHT shingles, copies to blocks of their own: each two
    home blocks meet in one task, and each home block meets each block of copies. A region whose home sets fit
    one block, as nearly all do, is so joined without a pair of blocks but with its copies.
    """
    size = F.greatest(F.count(F.lit(1)) / CELL, F.sum("n") / WEIGHT)
    per = level.groupBy("region").pivot("home", [True, False]).agg(F.ceil(size).cast("long")).select("region", F.col("true").alias("own"), F.coalesce("false", F.lit(0).cast("long")).alias("copies"))
    rows = level.select("region", "node", "comp", "home").join(per, "region").withColumn("block", F.when(F.col("home"), common.spread("node", F.col("own"))).otherwise(F.col("own") + common.spread("node", F.greatest("copies", F.lit(1)))))
    last = F.when(F.col("home"), F.col("own") + F.col("copies")).otherwise(F.col("own")) - 1
    # stored first: a small table is broadcast, by Spark's own limit, and the texts of all sets stay where they are
    rows = materialise(rows.select("region", "node", "comp", "block", last.alias("last")), "dealt")
    rows = rows.join(sets.select("node", "packed"), "node").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    rows = rows.select("region", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "comp", "packed")

    def run(key, pdf):
        import pandas as pd
        import zstandard

        unpack, known = zstandard.ZstdDecompressor().decompress, _Words()
        got = []
        if pdf["comp"].nunique() > 1:
            pdf = pdf.sort_values("node")
            block, node = pdf["block"], pdf["node"].tolist()
            got = block_links([unpack(bytes(x)) for x in pdf["packed"]], pdf["comp"].tolist(), (block == key[1]).tolist(), (block == key[2]).tolist(), percent, known)
        return pd.DataFrame([(node[x], node[y]) for x, y in got] if got else [], columns=["a", "b"], dtype="int64")

    return rows.groupBy("region", "i", "j").applyInPandas(run, "a long, b long").where("a <> b").distinct()


def with_components(level: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return level.withColumn("comp", F.col("node"))
    return level.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def with_links(new: DataFrame, comps: DataFrame | None) -> DataFrame:
    """A component's members and its name are as good as the links that made it."""
    return new if comps is None else new.unionByName(comps.where("node <> comp").select(F.col("comp").alias("a"), F.col("node").alias("b")))


def alive_regions(after: DataFrame, cell: int) -> DataFrame:
    """Regions that still hold two components and a home, with the number of sets at home there; copies that may meet a home of another component.

    ``split``: whether they are to be split again, being too large for one task and by that no worse than half of the
    region they come from.
    """
    at_home = lambda c: F.when(F.col("home"), F.col(c))
    alive = after.groupBy("region").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min(at_home("comp")).alias("home_lo"), F.max(at_home("comp")).alias("home_hi"), F.count(at_home("comp")).alias("homes"), F.max("was").alias("limit"))
    alive = alive.where("lo < hi AND homes > 0").select("region", "home_lo", "home_hi", "homes", ((F.col("homes") > cell) & (2 * F.col("homes") <= F.col("limit"))).alias("split"))
    return after.join(alive, "region").where("home OR comp <> home_lo OR comp <> home_hi").drop("home_lo", "home_hi")


def first_regions(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(region, node, n, most), stored: the regions of shared first shingles. A partner in the region has at most ``most`` shingles.

    A set whose first shingle in common with another is its i-th has n - i left to share, which bounds the other's size.
    Of two sets that link in a region the smaller one stands early enough there to be met by sets of its own size.
    Counts and bounds of a region are sums joined back to its rows, so the rows of a hot shingle are never in one task.
    """
    most, wide = F.expr(f"({100 + percent} * (n - i)) div {percent} - n"), 100 / percent
    # a shingle that only one row has, or that none has early, starts no region
    rows = shared_prefixes(sets, percent).join(nodes, "row").withColumn("most", most).select("region", "node", "n", "most")
    early = F.col("most") >= F.col("n")
    # Sets alike enough are of like size: their bands, a step of 100 / percent each, are the same or next to each
    # other, so a set goes to its band's region, and to the next one's if a partner there isn't too large.
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(wide)) + 1e-9)
    bands = F.when(F.col("most") >= F.floor(F.pow(F.lit(wide), band + 1)) - 1, F.array(band, band + 1)).otherwise(F.array(band))
    kept = rows = materialise(rows.withColumn("band", F.explode(bands)).distinct(), "region-rows")
    common.sweep(sets.sparkSession)
    bounds = rows.groupBy("region", "band").agg(F.min(F.when(early, F.col("n"))).alias("least_early"), F.max(F.when(early, F.col("most"))).alias("most_early"))
    rows = rows.join(bounds, ["region", "band"]).where("most >= least_early AND n <= most_early").drop("least_early", "most_early")
    # Shingles that the same sets have start one region: its name is made of its members, and where two names met by
    # chance, their sets would be joined as one region, no link lost.
    of = {"c": F.count(F.lit(1)), "lo": F.min("node"), "hi": F.max("node"), "s": F.bit_xor(F.xxhash64("node"))}
    names = rows.groupBy("region", "band").agg(*(v.alias(k) for k, v in of.items())).where("c > 1").select("region", "band", F.xxhash64(*of).alias("name"))
    out = materialise(rows.join(names, ["region", "band"]).groupBy(F.col("name").alias("region"), "node", "n").agg(F.max("most").alias("most")), "first-regions")
    common.discard(kept)
    return out


def links(sets: DataFrame, nodes: DataFrame, percent: int = PERCENT, pivots: int = PIVOTS, cell: int = CELL, near: float = NEAR, told: list | None = None) -> DataFrame | None:
    """(node, comp) of each set that has a link; None where nothing is linked.

    ``sets`` as ``document_sets`` gives them; ``nodes``: (row, n, node), the node being the first row with the same set.
    ``told`` is given a dict of counts for each round.
    """
    spark = sets.sparkSession
    common.ship(spark)
    reach = 1 - percent / 100
    start = first_regions(sets, nodes, percent)
    common.sweep(spark)
    level = start.withColumns({"low": F.lit(0.0), "high": F.lit(1.0), "home": F.lit(True), "was": F.lit(2**62), "comp": F.col("node")})
    level = materialise(alive_regions(level, cell), "regions")
    common.discard(start)
    # what is compared later is stored once more; the first row with a set has its text and is its node
    near_sets = sets.where("packed IS NOT NULL").select(F.col("row").alias("node"), "n", "sketch", "packed")
    near_sets = materialise(among(near_sets, level.select("node")), "region-sets")
    common.sweep(spark)
    comps, number = None, 0
    while not level.isEmpty():
        number += 1
        now = level
        count = {"rows": level.count(), "windows": level.where("NOT home").count(), "split": level.where("split").select("region").distinct().count()} if told is not None else {}
        new = None
        if number > 1:  # the first round's few pivots have settled groups of near copies
            whole = now.where("NOT split")
            if not whole.isEmpty():
                new = materialise(joined_regions(whole, near_sets, percent), "region-links")
            now = now.where("split")
        if number == 1 or not now.isEmpty():
            tests = pivot_tests(now, F.lit(FIRST) if number == 1 else F.greatest(F.lit(pivots), F.least(F.ceil(2 * F.col("homes") / cell), F.ceil(F.sqrt("homes"))).cast("int")), number, number > 1, near, reach)
            # a small table of pairs is broadcast, by Spark's own limit, and no text is shuffled for it
            pairs = materialise(tests.where(F.col("apart") <= F.col("upto") + 1e-9).groupBy("a", "b").agg(F.max("upto").alias("upto")), "pairs")
            got = distances(pairs, near_sets, percent)
            found = got.where("linked").select("a", "b")
            new = found if new is None else new.unionByName(found)
            count |= {"tests": tests.count(), "pairs": pairs.count()} if told is not None else {}
        else:
            tests = pairs = got = None
        if new is not None and not new.isEmpty():
            before, comps = comps, materialise(components(with_links(new, comps)), "components")
            common.discard(before)
        common.discard(new)
        if told is not None:
            told.append(count)
        before = level
        if tests is None:
            level = spark.createDataFrame([], level.schema)
        else:
            # an interval for each set's distance to each pivot of a region that is split, else to one pivot
            spans = tests.where("NOT retired" if number > 1 else "NOT retired AND main").join(got.drop("linked"), ["a", "b"], "left")
            spans = spans.select("region", "node", "n", "most", "home", "homes", "p", F.greatest("apart", "low").alias("low"), F.coalesce("high", F.lit(1.0)).alias("high"))
            after = voronoi(spans, comps, near, reach, number) if number > 1 else with_components(spans.drop("homes", "p").withColumn("was", F.lit(2**62)), comps)
            level = materialise(alive_regions(after, cell), "regions")
        common.discard(before, tests, pairs, got)
        common.sweep(spark)
    common.discard(level, near_sets)
    return comps


def pivot_tests(now: DataFrame, k, number: int, split: bool, near: float, reach: float) -> DataFrame:
    """(region, node, n, most, home, homes, retired, main, p, apart, upto, a, b), stored: each set with each pivot of its region.

    ``apart``: no distance is below what the sizes and the last pivot say; ``upto``: up to what it is asked for, null where
    it isn't. Pivots are of different components: the least set by hash in each of a few salts of components,
    summed up before any shuffle. The hash is the same in all regions, so regions with the same sets share pivots.
    """
    now = now.withColumn("k", k)
    choice = F.struct(F.xxhash64(F.lit(number), "node").alias("order"), "node", "n", "most", "comp", "low", "high", "home")
    salted = now.groupBy("region", "k", common.spread("comp", F.col("k") * 4, number).alias("salt")).agg(F.min(choice).alias("pivot"))
    chosen = salted.groupBy("region", "k").agg(F.array_sort(F.collect_list("pivot")).alias("found"))
    chosen = chosen.select("region", F.slice("found", F.lit(1), F.col("k")).alias("pivots"))
    tests = now.join(chosen, "region").withColumns({"retired": F.exists("pivots", lambda p: p["node"] == F.col("node")), "first": F.col("pivots")[0]["node"]}).withColumn("of", F.explode("pivots"))
    tests = tests.withColumns({"p": F.col("of.node"), "main": F.col("first") == F.col("of.node")}).where("node <> p")
    least = 1 - F.least("n", "of.n") / F.greatest("n", "of.n")
    apart = F.greatest(least, F.col("low") - F.col("of.high"), F.col("of.low") - F.col("high"))
    meets = (F.col("comp") != F.col("of.comp")) & (F.col("home") | F.col("of.home")) & (F.col("n") <= F.col("of.most")) & (F.col("of.n") <= F.col("most"))
    tests = tests.withColumns({"apart": apart, "upto": F.lit(near) if split else F.when(meets, F.lit(reach)), "a": F.least("node", "p"), "b": F.greatest("node", "p")})
    return materialise(tests.select("region", "node", "n", "most", "home", "homes", "retired", "main", "p", "apart", "upto", "a", "b"), "tests")


def voronoi(spans: DataFrame, comps: DataFrame | None, near: float, reach: float, number: int) -> DataFrame:
    """Rows of the regions' parts from (region, node, n, most, home, homes, p, low, high), a row a set and pivot.

    A set is at home with the pivot that is surely nearest, if that is within ``near``; else in the far part. With x at
    home at i and y at j, d(x, y) <= reach means d(y, i) <= near + reach and d(y, i) <= d(y, j) + 2 * reach. So y is
    copied to each such i before j; far sets are copied to all such i. A set that came here as a copy meets home sets
    only: it's copied wherever one may be, the far part included.
    """
    rows = spans.groupBy("region", "node", "n", "most", "home", "homes").agg(F.collect_list(F.struct("high", "p", "low")).alias("spans"))  # at most one for each pivot
    rows = with_components(rows, comps).withColumn("nearest", F.array_min("spans")).withColumn("own", F.when(F.col("nearest.high") <= near, F.col("nearest.p")))
    # one more entry stands for the far part
    entry = F.struct(F.lit(1.0).alias("high"), F.lit(None).cast("long").alias("p"), F.lit(0.0).alias("low"))
    each = rows.withColumn("s", F.explode(F.array_append("spans", entry)))
    far, own, none = F.col("s.p").isNull(), F.coalesce(F.col("own") == F.col("s.p"), F.lit(False)), F.col("own").isNull()
    near_own = none | (F.col("s.low") <= F.col("nearest.high") + 2 * reach + 1e-9)
    in_turn = none | ~F.col("home") | (F.col("s.p") < F.col("own"))
    copied = (F.col("s.low") <= near + reach + 1e-9) & near_own & in_turn
    each = each.where(F.when(far, none | ~F.col("home")).otherwise((F.col("home") & own) | copied))
    part = F.when(far, F.xxhash64("region", F.lit(number))).otherwise(F.xxhash64("region", "s.p", F.lit(number)))
    return each.select(part.alias("region"), "node", "comp", "n", "most", F.col("s.low").alias("low"), F.col("s.high").alias("high"), (F.col("home") & (own | far)).alias("home"), F.col("homes").alias("was"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, told: list | None = None) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, group_size.

    Documents link when 100 * intersection >= percent * union of their sets of 5-word shingles (64-bit hashes of
    them). A null or blank text has an empty set and is linked with nothing: its own id is its component. Equal sets
    are one node, whatever the number of copies. The component's id is the smallest id in it that isn't null.
    Repeated rows and equal ids are rows of their own; columns other than id and text aren't read.
    """
    sets = document_sets(docs, id_col, text_col, percent)
    filled = sets.where("n > 0")
    nodes = materialise(filled.groupBy("digest").agg(F.min("row").alias("node"), F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")), "nodes")
    comps = links(sets, filled.select("row", "n", "digest").join(nodes.select("digest", "node"), "digest").select("row", "n", "node"), percent, told=told)
    if comps is None:
        classes = nodes.select("digest", F.col("least").alias("component_id"), F.col("copies").alias("group_size"))
    else:
        labelled = materialise(nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "labelled")
        per = labelled.groupBy("comp").agg(F.min("least").alias("component_id"), F.sum("copies").alias("group_size"))
        classes = materialise(labelled.select("digest", "comp").join(per, "comp").drop("comp"), "classes")
    classes = classes.withColumnRenamed("digest", "of")
    out = sets.select("id", "n", "digest").join(classes, (F.col("n") > 0) & (F.col("digest") == F.col("of")), "left")
    alone = F.col("of").isNull()
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents of which one a group stays: that with the smallest id, and every document linked with nothing.

    Rows without words stay, an empty table stays empty. A null id comes after all others; ids may be of any type that
    has an order. Of rows repeated with id and text one stays. All columns of ``docs`` are kept. Texts move
    once, to meet the keys of the rows that stay; rows are told apart by id and a hash of the text.
    """
    of = {"__lm_unknown": F.col(id_col).isNull(), "__lm_id": F.coalesce(F.col(id_col).cast("string"), F.lit("")), "__lm_hash": F.xxhash64(common.text_of(text_col))}
    rows = docs.withColumns(of)
    key = F.struct("__lm_unknown", F.col(id_col).alias("__lm_own"), "__lm_hash")
    out = jaccard_components(rows.select(key.alias("key"), F.col(text_col).alias("text")), "key", "text", percent)
    kept = out.where(F.col("key").eqNullSafe(F.col("component_id"))).select("key.*")
    kept = materialise(kept.select("__lm_unknown", F.coalesce(F.col("__lm_own").cast("string"), F.lit("")).alias("__lm_id"), "__lm_hash").distinct(), "near-kept")
    return rows.join(kept.hint("merge"), list(of), "left_semi").dropDuplicates(list(of)).select(*docs.columns)
