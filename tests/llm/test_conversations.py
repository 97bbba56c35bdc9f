import hashlib
import random
import re
import zlib
from collections import defaultdict

import pyarrow.parquet as pq
import pytest

from claimweave.llm import conversations
from claimweave.llm.catalog import QUERIES

from .conftest import FOLDER


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    leaves, saved, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        own = members[path]
        leaves[path] = sum(leaves[k] for k in kids[path]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        saved[path] = sum(saved[k] for k in kids[path]) + (len(own) - 1) * words
        ends = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(own), len(path), parent, len(own), len(kids[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def test_query_equals_walk_over_all_prefixes(spark):
    rows = pq.read_table(f"{FOLDER}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pydict()
    got = found(QUERIES["op13_conversation_trie"](spark, FOLDER))
    assert got == trie(rebuilt(zip(*rows.values())))
    assert any(r[3] > 1 and r[1] > 0 for r in got)


def planted(rng):
    """Conversations that branch at many places: long shared paths, stars, copies."""
    rows, turn = [], lambda: (rng.choice(["user", "assistant", None]), rng.choice(["a", "a b", "c", "", None]))
    lines = [[turn() for _ in range(rng.choice([1, 4, 60]))] for _ in range(4)]
    for c in range(160):
        line = rng.choice(lines)
        turns = line[: rng.randint(0, len(line))] + [turn() for _ in range(rng.randint(0, 4))]
        rows += [(c * 3, k, *t) for k, t in enumerate(turns)]
    return rows


@pytest.mark.parametrize("most", [5, 40, 100_000])
def test_large_components_are_split_over_the_cluster(spark, most):
    rows = planted(random.Random(most))
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = found(conversations.rebuilt_trie(df, most))
    assert got == trie(rebuilt(rows))


def test_plain_conversations(spark):
    rows = planted(random.Random(1))
    turns = conversations.with_root(conversations.numbered_turns(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")))
    own = defaultdict(list)
    for c, _, role, text in rows:
        own[c].append((role or "", text or ""))
    assert found(conversations.prefix_trie(turns)) == trie(own)


def test_subtree_sums_of_random_forests():
    rng = random.Random(3)
    for shape in (lambda i: i - 1, lambda i: 0, lambda i: rng.randrange(-1, i), lambda i: max(-1, i - rng.randint(1, 3))):
        n = 300
        parent = [-1 if i == 0 else shape(i) for i in range(n)]
        values = [(rng.randint(0, 9), 1) for _ in range(n)]
        want = [list(v) for v in values]
        for i in range(n - 1, 0, -1):
            if parent[i] >= 0:
                want[parent[i]] = [a + b for a, b in zip(want[parent[i]], want[i])]
        assert conversations.subtree_sums(parent, values) == want
    assert conversations.subtree_sums([], []) == []


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (0, None, None, None), (0, 1, "user", "x " * 200_000), (0, 1, "user", "x " * 200_000), (7, None, "user", "hi"), (7, -3, "user", "hi"), (7, -3, "user", "hi"), (27, 2, "", ""), (47, 0, None, "")]
    rows += [(61, k, "user", f"only {k}") for k in (2, 0, 1)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "conv_id long, turn int, role string, text string, d int, weight int, node int")
    assert found(conversations.rebuilt_trie(df)) == trie(rebuilt(rows))


def test_ids_end_in_many_batches():
    import pandas as pd

    parts = [pd.DataFrame({"node": [1, 1, 2], "depth": [0, 0, 3], "conv_id": [1, 4, 2]}), pd.DataFrame({"node": [2, 2], "depth": [3, 3], "conv_id": [10, 20]})]
    got = pd.concat(conversations._digests(iter(parts))).values.tolist()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == [[1, 0, digest("1,4")], [2, 3, digest("2,10,20")]]


def test_empty_table(spark):
    assert conversations.rebuilt_trie(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).collect() == []
