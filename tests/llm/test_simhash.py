import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from claimweave.llm import simhash
from claimweave.llm.catalog import QUERIES

from .conftest import FOLDER


def bits_by_majority(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of_all_pairs(codes, most=3):
    distinct = sorted(set(codes))
    root = {c: c for c in distinct}

    def top(c):
        while root[c] != c:
            c = root[c]
        return c

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= most:
                root[max(top(a), top(b))] = min(top(a), top(b))
    return {c: top(c) for c in distinct}


def expected(rows):
    codes = [(i, bits_by_majority(t)) for i, t in rows]
    part = components_of_all_pairs([c for i, c in codes if i is not None])
    least = {}
    for i, c in codes:
        if i is not None:
            least[part[c]] = min(i, least.get(part[c], i))
    return sorted(((i, f"{c:016x}", None if i is None else least[part[c]]) for i, c in codes), key=str)


def test_query_equals_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    found = sorted((tuple(r) for r in QUERIES["op12_simhash"](spark, FOLDER).collect()), key=str)
    assert found == expected(rows)
    assert len({c for _, _, c in found}) < len(found)


def ball(rng, n, far):
    """Codes around a few centres, at distances up to ``far``, and codes anywhere."""
    centres = [rng.getrandbits(64) for _ in range(3)]
    out = {c for c in centres} | {rng.getrandbits(64) for _ in range(n // 4)}
    while len(out) < n:
        c = rng.choice(centres)
        for _ in range(rng.randint(1, far)):
            c ^= 1 << rng.randrange(64)
        out.add(c)
    return sorted(out)


@pytest.mark.parametrize("far", [2, 5, 9])
def test_groups_of_one_task(far):
    rng = random.Random(far)
    codes = np.array(sorted(ball(rng, 700, far), key=gray), np.uint64)
    label = simhash.link_groups(codes, np.array([0]), 3)
    part = components_of_all_pairs(codes.tolist())
    assert same_partition([part[int(c)] for c in codes], label.tolist())
    # The same entries in three groups of their own.
    cut = np.array([0, 200, 201])
    label = simhash.link_groups(codes, cut, 3)
    for a, b in zip(cut, [*cut[1:], len(codes)]):
        part = components_of_all_pairs(codes[a:b].tolist())
        assert same_partition([part[int(c)] for c in codes[a:b]], label[a:b].tolist())


def gray(code):
    for shift in (1, 2, 4, 8, 16, 32):
        code ^= code >> shift
    return code


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


@pytest.mark.parametrize("pile", [7, 64, 1 << 16])
def test_groups_cut_into_slices_lose_no_link(spark, pile):
    codes = ball(random.Random(pile), 900, 7)
    signed = [(c - (1 << 64) if c >> 63 else c,) for c in codes]
    found = dict(tuple(r) for r in simhash.near_fingerprints(spark.createDataFrame(signed, "node long"), pile=pile).collect())
    part = components_of_all_pairs(codes)
    assert same_partition([part[c] for c in codes], [found.get(s, s) for (s,) in signed])


def test_gray_ranks_turn_one_bit_at_a_time(spark):
    codes = [i ^ (i >> 1) for i in range(300)]
    df = spark.createDataFrame([(c,) for c in codes], "c long")
    found = [r[0] for r in df.orderBy(simhash.gray_rank(df["c"])).collect()]
    assert found == codes


def test_odd_rows(spark, documents):
    long = "many words in a row " * 30_000
    rows = [(None, "a b c d"), (1, None), (2, ""), (9, " \t"), (3, "A b C d"), (4, "a B c d"), (4, "a b c d"), (4, "other"), (5, "one"), (6, "ONE two"), (7, long), (8, long + "x"), (None, None)]
    docs = documents(rows).withColumn("fingerprint", simhash.F.lit(1))
    found = sorted((tuple(r) for r in simhash.simhash_groups(docs).collect()), key=str)
    assert found == expected(rows)


def test_empty_table(spark, documents):
    assert simhash.simhash_groups(documents([])).collect() == []
