import zlib
from collections import defaultdict
from itertools import combinations

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafmill.llm import packing, queries, tokens

PIECE, WORD = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def library_count(texts):
    import sentencepiece

    return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=PIECE).encode(texts)]


def test_counts_match_the_library_on_odd_rows(odd, odd_rows):
    got = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.token_counts(odd, PIECE, limit=40).collect() if r.doc_id is not None)
    texts = [(r[0], r[1] or "") for r in odd_rows if r[0] is not None]
    want = sorted((False, i, len(t.encode()), n, n > 40) for (i, t), n in zip(texts, library_count([t for _, t in texts]), strict=True))
    assert got == want


def test_counts_match_the_library_on_the_table(spark, sf):
    t = pq.read_table(f"{sf}/documents.parquet").to_pylist()
    want = dict(zip((r["doc_id"] for r in t), library_count([r["text"] for r in t]), strict=True))
    got = {r.doc_id: r.n_tokens for r in queries.op1_token_counts(spark, sf).collect()}
    assert got == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" ▁ab\n\tthe é1,.<s>"), max_size=30))
def test_any_text_counts_as_the_library_does(text):
    assert tokens._counter(PIECE).count(text) == library_count([text])[0]


def test_whole_tokens_are_proven():
    import sentencepiece

    whole = tokens.whole_tokens(PIECE)
    assert len(whole) > 10_000
    assert all(len(x) == 1 for x in sentencepiece.SentencePieceProcessor(model_file=PIECE).encode(sorted(whole)[::97]))


def test_empty_tables(empty):
    assert tokens.token_counts(empty, PIECE).count() == 0
    assert packing.pack_documents(empty, WORD).count() == 0


def library_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD).encode(text, add_special_tokens=False).ids + [0]


def check_packing(rows, texts, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for i, text in texts.items():
        ids = b"".join(x.to_bytes(4, "little") for x in library_ids(text))
        want = [(k, at // 4, len(ids[at : at + 4 * capacity]) // 4, zlib.crc32(ids[at : at + 4 * capacity])) for k, at in enumerate(range(0, len(ids), 4 * capacity))]
        assert sorted(set(pieces[i])) == want, i
    return len(bins)


def test_packing_of_odd_rows(odd, odd_rows):
    rows = packing.pack_documents(odd, WORD, capacity=64).collect()
    check_packing(rows, {r[0]: r[1] or "" for r in odd_rows if r[0] is not None}, 64)
    assert sum(r.doc_id is None for r in rows) == 2


def test_packing_of_the_table_is_near_the_bound(spark, sf):
    rows = queries.op4_best_fit_packing(spark, sf).collect()
    t = pq.read_table(f"{sf}/documents.parquet").to_pylist()
    n = check_packing(rows, {r["doc_id"]: r["text"] for r in t[:200]}, 2048)
    assert n <= packing.lower_bound([r.length for r in rows], 2048) * 1.01 + 1


def test_exchange_closes_gaps(spark):
    pieces = spark.createDataFrame([(i, 0, n) for i, n in enumerate([60, 40, 35, 65, 50, 50, 30, 70, 45, 55, 20, 80] * 40)], "doc_id long, piece int, length long")
    rows = packing.pack(pieces, 100, chunk=60).collect()
    assert len(rows) == 480 and len({r.sequence_id for r in rows}) <= 255


@pytest.mark.parametrize("lengths", list(combinations([3, 4, 5, 6, 7, 5, 2], 5)))
def test_the_bound_never_exceeds_the_best_packing(lengths):
    best = len(lengths)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k, room in enumerate(rooms):
            if room >= lengths[i]:
                put(i + 1, rooms[:k] + [room - lengths[i]] + rooms[k + 1 :])
        put(i + 1, [*rooms, 10 - lengths[i]])

    put(0, [])
    assert packing.lower_bound(list(lengths), 10) <= best <= len(packing.best_fit_decreasing(list(lengths), 10))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"abTh é'.,!%#İß1٣ \n\u0301", "<|endoftext|>", "'s", "<|"]), max_size=30).map("".join))
def test_any_text_is_encoded_as_the_library_does(text):
    got = packing._encoder(WORD)(text.encode())
    assert [int.from_bytes(got[i : i + 4], "little") for i in range(0, len(got), 4)] == library_ids(text)[:-1]
