import random

from claimweave.llm import wordpiece


def greedy(word, pieces):
    n, at = 0, 0
    longest = max(map(len, pieces))
    while at < len(word):
        size = next((k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in pieces), 0)
        if not size:
            return 1
        at += size
        n += 1
    return n


def test_automaton_matches_greedy_search():
    rng = random.Random(4)
    for _ in range(60):
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 25))}
        machine = wordpiece.Automaton(pieces)
        for _ in range(120):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
            assert machine.count(word) == greedy(word, pieces), (pieces, word)


def test_counts_with_the_public_vocabulary(documents):
    texts = ["Hello wonderful world", None, "", " \n ", "unwordlike ßé日本 𝔘", "same", "same", "x" * 3000]
    pieces = set(wordpiece.vocabulary(wordpiece.VOCABULARY))
    rows = list(enumerate(texts)) + [(None, "a b")]
    got = sorted(((r["doc_id"], r["n_words"], r["n_tokens"]) for r in wordpiece.count_tokens(documents(rows)).collect()), key=str)
    want = [(i, len((t or "").split()), sum(greedy("▁" + w, pieces) for w in (t or "").split())) for i, t in rows]
    assert got == sorted(want, key=str)


def test_no_documents(documents):
    assert wordpiece.count_tokens(documents([])).count() == 0
