import hashlib
import re
import zlib
from itertools import product

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from hypothesis import given, settings, strategies as st

from claimweave.llm import runs
from claimweave.llm.catalog import QUERIES

from .conftest import FOLDER


def longest_lyndon(word):
    """Least of all its proper suffixes, tried for every end."""
    out = []
    for i in range(len(word)):
        ends = [e for e in range(i + 1, len(word) + 1) if all(word[k:e] > word[i:e] for k in range(i + 1, e))]
        out.append(max(ends) - i)
    return out


def runs_by_comparison(words, least):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        equal = [words[i] == words[i + q] for i in range(len(words) - q)] + [False]
        start = None
        for i, same in enumerate(equal):
            if same and start is None:
                start = i
            elif not same and start is not None:
                length = i - start + q
                if length >= max(least, 2 * q):
                    found.setdefault((start, length), q)  # smaller periods come first
                start = None
    return sorted((s, n, q) for (s, n), q in found.items())


@given(st.lists(st.integers(0, 2), min_size=1, max_size=14))
@settings(max_examples=150, deadline=None)
def test_grouping_yields_the_lyndon_lengths(word):
    assert runs.lyndon_lengths(np.array(word)).tolist() == longest_lyndon(word)
    assert runs.lyndon_lengths(-np.array(word)).tolist() == longest_lyndon([-x for x in word])


def test_every_short_word_over_two_letters():
    for n in range(1, 9):
        for word in product([0, 1], repeat=n):
            assert runs.lyndon_lengths(np.array(word)).tolist() == longest_lyndon(list(word))


@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=4), st.sampled_from([4, 5, 12]))
@settings(max_examples=150, deadline=None)
def test_runs_of_batches_are_those_of_each_text(texts, least):
    words = [[b"w%d" % x for x in t] for t in texts]
    assert runs.batch_runs(words, least) == [runs_by_comparison(w, least) for w in words]


def test_periods_within_periods_and_long_texts():
    unit = [b"a", b"b", b"a", b"b", b"a", b"b", b"c"]
    words = unit * 3 + [b"x%d" % i for i in range(50)] + [b"y"] * 30
    assert runs.batch_runs([words], 4) == [runs_by_comparison(words, 4)]
    long = [b"w%d" % (i % 4001) for i in range(60_000)]
    assert runs.batch_runs([long], 12) == [[(0, 60_000, 4001)]]


def expected_row(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = runs_by_comparison(words, 12)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = min(((-size, s, q) for s, size, q in found), default=None)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    top = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    return (doc_id, len(found), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_equals_comparison_of_all_periods(spark):
    texts = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    found = {tuple(r) for r in QUERIES["op11_periodic_runs"](spark, FOLDER).collect()}
    short = [r for r in texts if len(r["text"] or "") < 4000]
    assert len(short) > 100 and any(expected_row(r["doc_id"], r["text"])[1] for r in short)
    assert {expected_row(r["doc_id"], r["text"]) for r in short} <= found and len(found) == len(texts)


def test_odd_rows(spark, documents, tmp_path):
    twelve = " ".join(["do", "re"] * 6)
    rows = [(None, twelve), (1, None), (2, ""), (3, " \t\n "), (4, twelve), (4, twelve), (4, "b " * 30), (5, "x y\v" * 40_000), (6, "ä ö " * 12)]
    for i in range(7, 40):
        rows.append((i, " ".join(f"{j % 9}" for j in range(i * 3))))
    docs = documents(rows)
    docs = docs.withColumns({c: docs["source"] for c in ("runs", "collapsed", "words", "n", "g", "a", "p", "h", "best")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()]
    want = [(i, t) for i, t in rows if i != 5]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((r for r in found if r[0] != 5), key=key) == sorted((expected_row(*r) for r in want), key=key)
    long = next(r for r in found if r[0] == 5)
    assert long[1:5] == (1, 0, 80_000, 2)


def test_empty_table(spark, documents):
    assert runs.digest(runs.periodic_runs(runs.with_planted_runs(documents([])))).collect() == []


def test_kept_words_of_overlapping_runs():
    words = [b"a", b"b"] * 8
    assert runs.kept_words(words, [(0, 16, 2)]) == [b"a", b"b"]
    assert runs.kept_words(words, []) == words
    assert pd.Series(runs.batch_runs([[], words, [b"a"]])).map(len).tolist() == [0, 1, 0]
