import random
import re

import pytest

from claimweave.llm import components, jaccard

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, width, percent):
    sets = []
    for _, t in rows:
        w = re.findall("[^ \t-\r]+", (t or "").translate(LOWER))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    part = list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and None not in (rows[a][0], rows[b][0]) and 100 * common >= percent * len(sets[a] | sets[b]):
                part[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), None if d is None else least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    line = " ".join(rng.choices(vocab, k=30))
    rows = []
    for _ in range(60):
        base = rng.choices(vocab, k=rng.choice([1, 2, 3, 4, 5, 20, 60, 150]))
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append(" ".join(copy))
        if rng.random() < 0.3:
            rows[-1] += " " + line
    chain = rng.choices(vocab, k=100)
    for i in range(25):  # each like the next, the ends unlike
        chain[i * 4 % 100] = f"new{i}"
        rows.append(" ".join(chain))
    rows += [None, "", "  \t", "One two THREE four", "one TWO three  four", line, line]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows))


@pytest.mark.parametrize("width,percent,seed", [(4, 85, 1), (5, 80, 2), (3, 60, 3)])
def test_groups_match_brute_force(documents, width, percent, seed):
    rows = corpus(seed)
    rows += [(None, rows[0][1]), rows[5]]
    got = jaccard.near_groups(documents(rows), width, percent).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, width, percent)


def test_no_documents(documents):
    assert jaccard.near_groups(documents([])).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(1, 60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    found = components.components(spark.createDataFrame(path + star, "a long, b long")).collect()
    got = {r["node"]: r["component"] for r in found}
    assert got == {**{i: 1 for i in range(2, 61)}, **{1000 + i: 1000 for i in range(1, 50)}}


def test_lengthened_prefixes_lose_nothing(spark, documents, monkeypatch):
    """With every document held to be costly, all need several matches; the groups stay the same."""
    rows = corpus(7)
    plain = jaccard.prefixes
    monkeypatch.setattr(jaccard, "prefixes", lambda w: plain(w, cheap=1))
    got = jaccard.near_groups(documents(rows), 4, 85).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 4, 85)


@pytest.mark.parametrize("width", range(1, 7))
def test_chunks_of_few_words(width):
    for n in range(7):
        words = [b"w%d" % i for i in range(n)]
        for texts in ([b" ".join(words)], [b"", b" ".join(words)], [b" ".join(words[:1]), b" ".join(words[1:])]):
            sizes = [len(s) for s in jaccard.shingle_sets(texts, width)]
            assert sizes == [max(0, k - width + 1) or min(k, 1) for k in (len(t.split()) for t in texts)]


def test_short_text_ahead_of_a_long_one(documents):
    rows = [(1, "two words"), (2, " ".join(f"w{i % 5000}" for i in range(900_000))), (3, "Two words")]
    got = sorted(tuple(r) for r in jaccard.near_groups(documents(rows)).collect())
    assert got == [(1, 1, 1), (2, 5000, 2), (3, 1, 1)]
