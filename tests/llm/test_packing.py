import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from claimweave.llm import packing

TEXTS = ["Hello, World. it's a <|endoftext|> b", None, "", "A<|ENDOFTEXT|>b É. İ ΣΑΣ. ., x.", "\x0b\x85\xa0a b\x1cc don't I'LL 3.5", "word " * 5000, "same text", "same text"]


def expected(text):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def test_pieces_are_the_tokenizers_ids(documents):
    docs = documents([(i, t) for i, t in enumerate(TEXTS)])
    got = {}
    for r in packing.pack_documents(docs).collect():
        got.setdefault(r["doc_id"], {})[r["piece"]] = (r["start"], r["length"], r["ids_crc32"])
    for i, t in enumerate(TEXTS):
        ids = expected(t)
        parts = [(a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for a in range(0, len(ids), 2048)]
        assert [got[i][k] for k in sorted(got[i])] == parts


def test_sequences_are_gapless_and_few(documents):
    docs = documents([(i % 90, "the quick brown fox " * (1 + 37 * i % 300)) for i in range(300)] + [(None, "no id")])
    rows = packing.pack_documents(docs).collect()
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 2048
    least = -(-sum(r["length"] for r in rows) // 2048)
    assert len(by) <= 1.02 * least + 1


def test_no_documents(documents):
    assert packing.pack_documents(documents([])).count() == 0


def test_crossover_keeps_every_item_once():
    import random

    rng = random.Random(3)
    lengths = [rng.randint(1, 100) for _ in range(200)]
    order = list(range(200))
    a, b = packing.best_fit(order, lengths, 128), packing.best_fit(sorted(order, key=lambda i: -lengths[i]), lengths, 128)
    child = packing.crossover(a, b, lengths, 128, rng)
    assert sorted(i for x in child for i in x) == order
    assert all(sum(lengths[i] for i in x) <= 128 for x in child)
    assert len(set(packing.evolve(lengths, 128, 1, [], 5, 10))) <= len(b)


def triplets(seed, bins=30):
    """Lengths that fill bins of 1000 exactly by threes, which best fit decreasing does not find."""
    import random

    rng, out = random.Random(seed), []
    for _ in range(bins):
        a = rng.randint(380, 490)
        b = rng.randint((1000 - a) // 2 - 40, (1000 - a) // 2 + 40)
        out += [a, b, 1000 - a - b]
    return out


def test_search_beats_best_fit_decreasing():
    better = 0
    for seed in range(6):
        lengths = triplets(seed)
        plain = packing.best_fit(sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, 1000)
        assert len(plain) > 30
        labels = packing.evolve(lengths, 1000, seed, [], 12, 400)
        sizes = np.bincount(labels, weights=lengths)
        assert sizes.max() <= 1000 and len(labels) == len(lengths)
        better += len(sizes) < len(plain)
    assert better >= 4


def test_islands_pass_on_their_best(spark, monkeypatch):
    lengths = triplets(1)
    pieces = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "row long, piece int, length long")

    def used(epochs):
        rows = packing.pack_pieces(pieces, 1000, epochs=epochs, islands=3, population=8, generations=60).collect()
        assert len(rows) == len(lengths)
        return len({r["sequence_id"] for r in rows})

    plain = len(packing.best_fit(sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, 1000))
    assert used(6) <= used(1) <= plain and used(6) < plain
    # An island that is given a better packing keeps it or improves on it.
    best = packing.evolve(lengths, 1000, 1, [], 12, 400)
    assert max(packing.evolve(lengths, 1000, 2, [best, list(range(len(lengths)))], 4, 5)) <= max(best)


def test_shards_at_the_bound_are_not_searched_on(spark, monkeypatch):
    made = []
    plain = packing.store_table
    monkeypatch.setattr(packing, "store_table", lambda df, name: made.append(name) or plain(df, name))
    even = spark.createDataFrame([(i, 0, 500) for i in range(40)], "row long, piece int, length long")
    assert packing.pack_pieces(even, 1000, epochs=5).select("sequence_id").distinct().count() == 20
    assert made.count("islands") == 1
