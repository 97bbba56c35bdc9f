import random

import numpy as np
import pytest

from claimweave.llm import decontaminate as dc


def distance(item, text):
    """Least edits from the item to a stretch of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_edit_distance_matches_the_full_table():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(0, 4, rng.integers(0, 15))
        assert dc.edit_distance(a, b)[0] == distance(a.tolist(), b.tolist())


def made(seed=1):
    rng = random.Random(seed)
    vocab = [f"{rng.choice('abcdefgh')}{i}" for i in range(900)]
    items = [" ".join(rng.choices(vocab, k=n)) for n in [1, 2, 3, 5, 8, *rng.choices(range(15, 60), k=25)]]
    docs, planted = [], []
    for d in range(250):
        words = rng.choices(vocab, k=rng.choice([30, 120, 400]))
        if d % 2:
            k = rng.randrange(5, len(items))
            passage = items[k].split()
            for _ in range(rng.randint(0, int(0.2 * len(passage)))):
                at = rng.randrange(len(passage))
                rng.choice([lambda: passage.pop(at), lambda: passage.insert(at, "new"), lambda: passage.__setitem__(at, "put")])()
            at = rng.randrange(len(words))
            words[at:at] = passage
            planted.append((d, k))
        docs.append((d, " ".join(words).title()))
    return items, docs, planted


def clean(text):
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def test_passages_against_brute_force(spark, documents):
    items, docs, planted = made()
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in dc.contaminated(documents(docs), bench).collect()}
    want = {}
    for d, t in docs:
        for i, x in enumerate(items):
            item = clean(x)
            edits = distance(item, clean(t))
            if edits <= int(0.2 * len(item) + 1e-9):
                want[d, i] = edits
    assert set(got) <= set(want) and all(got[k] >= want[k] for k in got)
    assert len(got) >= 0.98 * len(want)
    assert all(k in got for k, e in want.items() if e == 0)


@pytest.mark.parametrize("kind", ["replace", "insert", "remove", "mixed"])
@pytest.mark.parametrize("n", [15, 20, 55, 100, 300])
def test_recall_at_exactly_the_rate(kind, n):
    rng = random.Random(n)
    word = lambda: f"w{rng.randrange(10**9)}"
    items, texts = [], []
    for _ in range(100):
        item = [word() for _ in range(n)]
        passage = list(item)
        for at in sorted(rng.sample(range(n), n // 5), reverse=True):
            how = rng.choice(["replace", "insert", "remove"]) if kind == "mixed" else kind
            passage[at : at + 1] = {"replace": [word()], "insert": [word(), item[at]], "remove": []}[how]
        items.append(" ".join(item).encode())
        texts.append(" ".join([word() for _ in range(40)] + passage + [word() for _ in range(40)]).encode())
    bench = dc.Benchmark(list(range(100)), items, dc.RATE, dc.RECALL)
    found = {(t, i) for t, i, _, _ in bench.passages(texts)}
    assert found <= {(i, i) for i in range(100)} and len(found) >= 98


def test_blocks_nulls_and_empty_tables(spark, documents):
    schema = "item_id long, text string, row int"
    text = "one two three four five six seven eight"
    bench = spark.createDataFrame([(1, text, 0), (2, None, 0), (3, "", 0), (None, "Nine, ten! eleven", 0), (4, text, 0)], schema)
    docs = documents([(1, f"x {text.upper()}, y"), (2, None), (3, ""), (None, "nine ten eleven"), (1, text)])
    got = sorted(((r["doc_id"], r["item_id"]) for r in dc.contaminated(docs, bench).collect()), key=str)
    assert got == sorted([(1, 1), (1, 4), (1, 1), (1, 4), (None, None)], key=str)
    rows = docs.selectExpr("doc_id", "coalesce(text, '') as text", "1L as row")
    blocks = dc.find_passages(rows, bench, block=1).count()
    assert blocks == 5
    assert dc.contaminated(docs, spark.createDataFrame([], schema)).count() == 0
    assert dc.contaminated(documents([]), bench).count() == 0


def test_edits_counted_side_by_side_are_those_of_each_alone(monkeypatch):
    monkeypatch.setattr(dc, "SIDE_BY_SIDE", 40)  # several groups
    texts = [b"a b c d e f", b"x a b q d e f g", b"a", b"c d c d c d c d"]
    block = dc.Benchmark([1, 2, 3], [b"a b c d e f", b"c d", b"b c d e x f"], 0.2, 0.9)
    data, starts = dc.joined(texts)
    at, _, hashes = dc.words(data)
    bounds = np.searchsorted(at, starts)
    item, text = (x.ravel() for x in np.meshgrid(np.arange(3), np.arange(len(texts))))
    found = block.edits(item, hashes, bounds[text], bounds[text + 1])
    assert found.tolist() == [dc.edit_distance(block.words[i], hashes[bounds[t] : bounds[t + 1]])[0] for i, t in zip(item, text)]
    assert found[:3].tolist() == [0, 0, 1] and block.edits(item[:0], hashes, item[:0], item[:0]).tolist() == []
