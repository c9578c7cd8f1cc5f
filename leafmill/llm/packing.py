"""Operator 4: best-fit packing of token pieces, certified by dual feasible functions.

Pieces are packed chunk by chunk with best-fit decreasing. A dual feasible function u maps sizes so
that whatever fits into one bin sums to 1 at most; the sum over a chunk, rounded up, is then a lower bound on
its bins. A chunk that meets its bound is sealed as optimal. From a chunk with a gap only the least
filled bins are opened; their pieces are dealt anew, together with those of other chunks, and best-fit
decreasing runs again, until the gaps are gone or another exchange saves nothing.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

CHUNK, ROUNDS, CACHE = 20_000, 6, 800_000


_TAIL = b".,;:!?%$#*&|"


@lru_cache(maxsize=2)
def _encoder(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    vocabulary = tokenizer.get_vocab()
    closes = np.zeros(max(vocabulary.values()) + 1, bool)
    closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
    known: dict[bytes, bytes] = {}

    def ids(text: str) -> bytes:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def learn(words: list[bytes]) -> None:
        """Words of letters alone are one unit each, so many are encoded at once: a unit ends with a closing token."""
        texts = [w.decode() for w in words]
        plain = [n for n, t in enumerate(texts) if t.isalpha()]
        got = ids(" ".join([texts[n] for n in plain]))
        ends = (np.flatnonzero(closes[np.frombuffer(got, "<u4")]) + 1) * 4
        if len(ends) == len(plain):
            at = 0
            for n, end in zip(plain, ends.tolist(), strict=True):
                known[words[n]] = got[at:end]
                at = end
        for w, t in zip(words, texts, strict=True):
            if w not in known:
                known[w] = ids(t)

    def encode(text: bytes) -> bytes:
        """Ids as little-endian 32-bit numbers. No token spans ASCII white space, so each run between is encoded once."""
        if b"<|" in text:  # may hold a special token's string, which is told apart by case
            return ids(text.decode())
        parts = text.lower().split()
        new = set(parts).difference(known)
        if new:
            if len(known) > CACHE:
                known.clear()
                new = set(parts)
            # a run of punctuation after a letter is a unit of its own
            cut = {x: len(b) for x in new if (b := x.rstrip(_TAIL)) != x and b[-1:].isalpha()}
            need = new.difference(cut) | {x[:n] for x, n in cut.items()} | {x[n:] for x, n in cut.items()}
            learn(list(need.difference(known)))
            for x, n in cut.items():
                known[x] = known[x[:n]] + known[x[n:]]
        return b"".join([known[x] for x in parts])

    return encode


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Ids of each text, then id 0, cut into pieces of ``capacity``: id, piece, start, length, ids_crc32 (and the ids).

    A null or empty text is the single id 0. Only texts with more ids than ``capacity`` are cut.
    """
    common.arrow_limits(docs.sparkSession)
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()), *(T.StructField(x, T.LongType()) for x in ("start", "length", "ids_crc32"))]
    schema = T.StructType(fields + [T.StructField("ids", T.BinaryType())] * with_ids)
    wide = 4 * capacity

    def run(batches):
        encode = _encoder(tokenizer_path)
        for batch in batches:
            rows, places = [], []
            for n, text in enumerate(batch.column(1).to_pylist()):
                ids = encode(text) + b"\0\0\0\0"
                for k, at in enumerate(range(0, len(ids), wide)):
                    part = ids[at : at + wide]
                    places.append(n)
                    rows.append((k, at // 4, len(part) // 4, zlib.crc32(part), part))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: len(schema) - 1]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(places, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=False))], names=schema.names)

    return docs.select(id_col, common.text_of(text_col).cast("binary")).mapInArrow(run, schema)


def lower_bound(lengths: list[int], capacity: int) -> int:
    """No packing has fewer bins: the best of the volume and two families of dual feasible functions."""
    counts: dict[int, int] = {}
    for x in lengths:
        counts[x] = counts.get(x, 0) + 1
    best = -(-sum(x * n for x, n in counts.items()) // capacity)
    for k in range(1, 21):  # x stays where (k+1)x is whole, else floor((k+1)x)/k
        total = sum(n * (k * x if (k + 1) * x % capacity == 0 else (k + 1) * x // capacity * capacity) for x, n in counts.items())
        best = max(best, -(-total // (k * capacity)))
    for low in sorted({x for x in counts if 2 * x <= capacity}):  # 1 above capacity - low, 0 below low
        total = sum(n * (capacity if x > capacity - low else 0 if x < low else x) for x, n in counts.items())
        best = max(best, -(-total // capacity))
    return best


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of places in ``lengths``. ``mask`` has a bit for each free space that some bin has."""
    bins: list[list[int]] = []
    with_space: dict[int, list[int]] = {}
    mask = 0
    for at in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[at]
        fits = mask >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            found = with_space[space].pop()
            if not with_space[space]:
                mask &= ~(1 << space)
        else:
            found, space = len(bins), capacity
            bins.append([])
        bins[found].append(at)
        if space > size:
            with_space.setdefault(space - size, []).append(found)
            mask |= 1 << (space - size)
    return bins


def pack(pieces: DataFrame, capacity: int = 2048, key_cols: tuple[str, ...] = ("doc_id", "piece"), chunk: int = CHUNK, rounds: int = ROUNDS) -> DataFrame:
    """Adds sequence_id and offset to pieces with a ``length`` of 1 to ``capacity``.

    Equal pieces and repeated rows are packed as rows of their own. Full pieces fill a sequence alone and aren't
    shuffled. Other pieces are dealt by a hash of their place in the
    stored table into chunks of about ``chunk``, so neither a repeated row nor a null id is a hot key; only numbers move.
    Each round's table lies in the shared folder, so a lost executor costs one round at most.
    """
    common.ship(pieces.sparkSession)
    full = pieces.where(F.col("length") >= capacity).withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    level = pieces.where(F.col("length") < capacity)
    schema = T.StructType([*pieces.schema.fields, *(T.StructField(x, T.LongType()) for x in ("sequence_id", "offset")), T.StructField("open", T.BooleanType())])

    def settle(number: int, last: bool):
        def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["length", *key_cols], ascending=[False] + [True] * len(key_cols), kind="stable").reset_index(drop=True)
            lengths = pdf["length"].tolist()
            bins = best_fit_decreasing(lengths, capacity)
            gap = len(bins) - lower_bound(lengths, capacity)
            filled = sorted((sum(lengths[i] for i in b), n) for n, b in enumerate(bins))
            # a gap of g bins is closed by spreading g bins over others: open these and as many that have room again
            opened = set() if last or gap <= 0 else {n for f, n in filled[: 8 * gap + 8] if f < capacity}
            ids, offsets, opens = [0] * len(lengths), [0] * len(lengths), [False] * len(lengths)
            for n, b in enumerate(bins):
                place = 0
                for i in b:
                    ids[i], offsets[i], opens[i] = (number << 56) | (int(key[0]) << 24) | n, place, n in opened
                    place += lengths[i]
            return pdf.drop(columns=["chunk"]).assign(sequence_id=ids, offset=offsets, open=opens)[schema.names]

        return run

    out, left, before = full, level.count(), None
    for number in range(1, rounds + 1):
        if not left:
            break
        parts = -(-left // chunk)
        last = number == rounds or parts == 1 or (before is not None and left >= before)
        # level is a stored table, so a row's number is the same when a task runs again; equal rows are spread by it
        dealt = level.withColumn("chunk", common.spread(F.monotonically_increasing_id(), parts, number))
        level = common.materialise(dealt.groupBy("chunk").applyInPandas(settle(number, last), schema), "pack")
        out = out.unionByName(level.where(~F.col("open")).drop("open"))
        level = level.where("open").drop("open", "sequence_id", "offset")
        before, left = left, 0 if last else level.count()
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null ids and repeated rows are packed as rows of their own; an empty table gives an empty result; columns
    other than the id and the text are not read.
    """
    pieces = common.materialise(token_pieces(docs, tokenizer_path, capacity, id_col, text_col), "pieces")
    return pack(pieces, capacity, (id_col, "piece"))
