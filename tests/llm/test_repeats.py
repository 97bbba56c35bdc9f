import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from claimweave.llm import repeats


def brute(texts, length):
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), int((np.diff(np.append(0, gone.astype(int))) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def first_stays(texts, length):
    seen, out = set(), []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            s = t[i : i + length]
            if s in seen:
                gone[i : i + length] = True
            seen.add(s)
        out.append(bytes(np.frombuffer(t, np.uint8)[~gone]))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, long = prose(30), prose(200)
    made = [prose(rng.randint(0, 60)) for _ in range(40)]
    made += [prose(20) + shared + prose(20) for _ in range(20)]
    made += [long, long, long[:-9] + "x", long[3:], "ab" * 200, "", None, "a" * 150, shared, long + shared + long]
    return made


@pytest.mark.parametrize("hot", [repeats.HOT_CONTEXTS, 4])
def test_no_copy_stays(documents, texts, hot):
    docs = documents(list(enumerate(texts)))
    found = repeats.digest(repeats.remove_repeats(docs, 60, 30, first_stays=False, hot=hot))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found.collect()}
    assert [got[i] for i in range(len(texts))] == brute([(t or "").encode() for t in texts], 60)


@pytest.mark.parametrize("hot", [repeats.HOT_CONTEXTS, 4])
def test_first_copy_stays(documents, texts, hot):
    """Equal texts count as a whole, by their first id: only different texts are put in one order here."""
    different = list(dict.fromkeys(t or "" for t in texts))
    found = repeats.remove_repeats(documents(list(enumerate(different))), 60, 30, hot=hot)
    got = {r["doc_id"]: bytes(r["kept"]) for r in found.collect()}
    assert [got[i] for i in range(len(different))] == first_stays([t.encode() for t in different], 60)


def test_later_copy_goes(documents):
    text = "some words that are long enough to count " * 3
    got = {r["doc_id"]: r["n_removed"] for r in repeats.remove_repeats(documents([(1, text), (2, text), (None, "y")]), 100, 40).collect()}
    inner = got[1]  # the text repeats itself
    assert got == {1: inner, 2: len(text), None: 0}


def test_no_documents(documents):
    assert repeats.remove_repeats(documents([])).count() == 0
