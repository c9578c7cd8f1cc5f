
import hashlib
from collections import defaultdict

import pyarrow.parquet as pq

from leafmill.llm import linededup, queries
from tests.llm.test_mixing_exact_lines import brute_lines

BLANK = "".join(map(chr, (9, 10, 11, 12, 13, 32)))


def brute_whole(rows):
    """Places to drop: those of the templates, equal short lines of 3 documents, equal long lines of 2."""
    docs = sorted({(r[0], r[1]) for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    found, words, out = defaultdict(dict), defaultdict(list), defaultdict(set)
    for doc in docs:
        for n, line in enumerate(doc[1].split("\n")):
            w = tuple("".join(" " if c in BLANK else c for c in line).split(" "))
            w = tuple(x for x in w if x)
            g = tuple("<*>" if any(c in "0123456789" for c in x) else x for x in w)
            half, keys = (len(w) - 3) // 2, []
            if 0 < len(w) < 8:
                keys.append((3, "exact", w))
            if len(w) >= 8:
                keys.append((3, len(w), g))
            if len(w) >= 20:
                keys.append((2, "exact", w))
            if len(w) >= 24:
                keys += [(3, len(w), g[:3], "first", g[3 : 3 + half]), (3, len(w), g[:3], "second", g[3 + half :])]
            for k in keys:
                found[k].setdefault(doc, n)
                words[doc].append((n, k))
    for doc, mine in words.items():
        for n, k in mine:
            if len(found[k]) >= k[0] and next(iter(found[k].items())) != (doc, n):
                out[doc].add(n)
    return {d: gone for d, gone in out.items() if any(x.strip(BLANK) for n, x in enumerate(d[1].split("\n")) if n not in gone)}


def test_short_lines_and_passages_of_two_documents_go(spark):
    passage, numbers = " ".join(f"p{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(30)), " ".join(["7"] * 25)
    own = [f"only {chr(97 + i)} has this" for i in range(4)]
    rows = [(i, f"{own[i]}\nReleased under the MIT License.\n\n{passage if i in (1, 3) else ''}\n{numbers.replace('7', str(i))}") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_dropped for r in linededup.line_dedup(docs, whole=True).collect()} == {0: 0, 1: 2, 2: 2, 3: 3}
    text = {r.doc_id: r.text.split("\n") for r in linededup.line_dedup(docs, whole=True).collect()}
    assert passage in text[1] and passage not in text[3] and all(own[i] in text[i] and "" in text[i] for i in range(4))


def test_whole_line_dedup_of_the_table(spark, sf):
    t = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    want, templates = brute_whole(t), brute_lines(t)
    rows = {r.doc_id: r for r in queries.op9_line_dedup_whole(spark, sf).collect()}
    assert len(rows) == len(t) and sum(map(len, want.values())) > sum(map(len, templates.values()))
    for d, text in t:
        gone = want.get((d, text), set())
        kept = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone)
        assert rows[d].n_dropped == len(gone) and rows[d].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest(), d
