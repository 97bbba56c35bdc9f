import hashlib
import random
import struct

import pytest
import xxhash

from claimweave.llm import fingerprints as fp

M = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hash_text(t):
    return signed(xxhash.xxh64_intdigest(t.encode(), seed=42))


def hash_longs(*values):
    """Each value is hashed with the hash so far as its seed; a missing one changes nothing."""
    seed = 42
    for v in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=seed & M)
    return signed(seed)


def hash_long_int(a, b):
    """A long and an int: the int is hashed as 4 bytes."""
    seed = xxhash.xxh64_intdigest(struct.pack("<q", a), seed=42)
    return signed(xxhash.xxh64_intdigest(struct.pack("<i", b), seed=seed))


def brute(text):
    """All numbered k-mers on the circle; each slot takes the two next ones, found by scanning."""
    import re

    w = [hash_text(x) for x in re.split(r"[ \t\n\x0b\f\r]+", text)]
    mers = [hash_longs(w[i], w[i + 1] if i + 1 < len(w) else None) for i in range(len(w))]
    seen, pairs = {}, []
    for i, h in enumerate(mers):
        part = signed(h & fp.HASH & M)
        n = seen.get(part, 0)
        seen[part] = n + 1
        if n:
            part = signed(hash_long_int(part, n) & fp.HASH & M)
        pairs.append(((part & M | fp.SET | i), i))
    ring = sorted((signed(p), i) for p, i in pairs)
    out = []
    for r in range(-fp.SLOTS // 2, fp.SLOTS // 2):
        after = [x for x in ring if x[0] > r << fp.TURN] + [x for x in ring if x[0] < r << fp.TURN]
        a, b = after[0][1], after[1 % len(after)][1]
        out.append(hash_longs(mers[min(a, b)], mers[max(a, b)]) & 0x7FFFFFFF)
    return out


def texts():
    rng = random.Random(2)
    word = lambda: rng.choice("the of to be and in that it éa ß".split()) + rng.choice(["", "x", "yz", str(rng.randint(0, 50))])
    made = [" ".join(word() for _ in range(rng.choice([1, 2, 3, 9, 40, 400]))) for _ in range(30)]
    return made + ["", None, "a a a a a a a a a a", "\n tab\tand  blanks ", made[3], "a b a b a b a b"]


def test_slots_match_brute_force(documents):
    rows = list(enumerate(texts()))
    got = {r["doc_id"]: list(r["slots"]) for r in fp.order_minhash(documents(rows), "text", "slots").collect()}
    for i, t in rows:
        assert got[i] == brute(t or ""), t


def test_edited_texts_and_likeness(documents):
    rows = [(3 * i, t) for i, t in enumerate(texts())]
    got = {r["doc_id"]: r for r in fp.edited_fingerprints(documents(rows)).collect()}
    order = sorted(rows, reverse=True)
    for k, (d, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        own, changed, after = brute(t), brute(edited), brute(following)
        r = got[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r["fingerprint"] == "".join(f"{x:08X}" for x in own) and r["edited_fingerprint"] == "".join(f"{x:08X}" for x in changed)
        assert r["near_edited"] == sum(a == b for a, b in zip(own, changed)) / fp.SLOTS
        assert r["near_next"] == sum(a == b for a, b in zip(own, after)) / fp.SLOTS


def test_order_matters_and_small_edits_matter_little(documents):
    rng = random.Random(9)
    w = [f"w{rng.randint(0, 10**6)}" for _ in range(300)]
    swapped, edited = w[150:] + w[:150], list(w)
    edited[100] = "other"
    rows = [(0, " ".join(w)), (1, " ".join(swapped)), (2, " ".join(edited))]
    got = {r["doc_id"]: list(r["slots"]) for r in fp.order_minhash(documents(rows), "text", "slots").collect()}
    alike = lambda a, b: sum(x == y for x, y in zip(got[a], got[b])) / fp.SLOTS
    assert alike(0, 2) > 0.85 > 0.7 > alike(0, 1) > 0.2  # the k-mers are nearly all shared by both


def test_repeated_missing_and_lone_ids(documents):
    rows = [(5, "one two three four"), (5, "one two"), (5, "one two"), (2, "abcdef"), (None, "kept gone"), (None, None)]
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["near_next"] is None) for r in fp.edited_fingerprints(documents(rows)).collect()]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    name = lambda s: "".join(f"{x:08X}" for x in brute(s))
    want = [
        (5, 18, sha("one two tabcdef"), name("one two three four"), False),
        (5, 7, sha("one abc"), name("one two"), False),
        (5, 7, sha("one abc"), name("one two"), False),
        (2, 6, sha("abcone"), name("abcdef"), False),
        (None, 9, sha("kept "), name("kept gone"), True),
        (None, 0, sha(""), name(""), True),
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    lone = fp.edited_fingerprints(documents([(1, "abcd")])).first()
    assert lone["edited_sha256"] == sha("abab") and lone["near_next"] == 1.0


def test_no_documents(documents):
    assert fp.edited_fingerprints(documents([])).count() == 0


def test_no_python_and_one_shuffle_of_the_texts(documents):
    plan = fp.edited_fingerprints(documents([(1, "a b"), (2, "c d")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
