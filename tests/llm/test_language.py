import zlib

import numpy as np
import pytest

from claimweave.llm import language
from tests.llm.conftest import FOLDER


def test_filters_match_plain_convolution():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, (5, 40)).astype(np.uint8)
    net = language.train(data, ["a", "b", "a", "b", "a"], epochs=1)
    one_hot = np.eye(256)[data]
    for group, found in zip(net.tables, net.answers(data)):
        kernel = np.stack(group)  # place, byte, filter
        for i in range(found.shape[1]):
            plain = np.einsum("njb,jbf->nf", one_hot[:, i : i + len(group)], kernel)
            assert np.allclose(found[:, i], plain, atol=1e-4)


def test_gradient_lowers_the_loss():
    rng = np.random.default_rng(2)
    labels = [("x", "y")[i % 2] for i in range(200)]
    data = rng.integers(97, 105, (200, 64)).astype(np.uint8)
    for row, label in zip(data, labels):
        at = rng.integers(0, 60)
        row[at : at + 3] = np.frombuffer({"x": b"qzw", "y": b"wzq"}[label], np.uint8)
    net = language.train(data, labels, epochs=20)
    assert (net.log_chances(data).argmax(axis=1) == [net.languages.index(c) for c in labels]).mean() > 0.95


def test_windows_cover_whole_texts():
    data, owner = language.windows_of([b"a" * 600, b"", b"bc"], 256)
    assert data.shape == (5, 256) and owner.tolist() == [0, 0, 0, 1, 2]
    assert bytes(data[owner == 0].ravel()).rstrip(b"\0") == b"a" * 600


@pytest.mark.skipif(FOLDER is None, reason="no test tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = language.identify_languages(docs).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95


def test_nulls_and_nothing_to_learn(documents):
    rows = [(1, None, "en"), (2, "123 ...", "en"), (3, "some words", None), (None, "words", "en")]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify_languages(documents(rows[:3])).collect()}
    assert got == {1: ("und", 0.0), 2: ("und", 0.0), 3: ("und", 0.0)}
    assert language.identify_languages(documents([])).count() == 0
    more = documents(rows + [(i, "the and of to", "en") for i in range(10, 30)] + [(i, "der und die das", "de") for i in range(30, 60)])
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify_languages(more).collect()}
    assert found[1] == found[2] == "und" and found[None] in ("en", "de")


def test_signs_and_digits_are_no_letters(documents):
    rows = [(1, "² ½ ¾"), (2, "Ⅷ"), (3, "ª"), (4, "中")] + [(i, "the and of to", "en") for i in range(10, 40)]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify_languages(documents(rows)).collect()}
    assert {i: got[i] for i in range(1, 5)} == {1: "und", 2: "und", 3: "en", 4: "en"}


def test_each_language_gives_its_own_sample(documents):
    rows = [(i, f"text number {i} in words", "en") for i in range(900)] + [(2000 + i, f"seltener text {i}", "de") for i in range(4)]
    rows += [(3000 + i, f"texte {i}", "fr") for i in range(60)] + [(4000, "text number 1 in words", "en"), (4001, None, "en"), (4002, "77", "de")]
    found = [tuple(r)[::2] for r in language.drawn_texts(documents(rows), 50, 1000).collect()]
    by = {k: [t for n, t in found if n == k] for k in ("en", "de", "fr")}
    assert {k: len(v) for k, v in by.items()} == {"en": 50, "de": 4, "fr": 50}
    assert all(len(set(v)) == len(v) for v in by.values())
    again = [tuple(r)[::2] for r in language.drawn_texts(documents(rows[::-1]), 50, 1000).collect()]
    assert sorted(again) == sorted(found)
    assert len(language.drawn_texts(documents(rows), 50, 30).collect()) == 4 + 10 + 10


def test_windows_are_drawn_from_the_whole_text(documents, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "train", lambda data, labels: seen.append(bytes(data.ravel())))
    text = "".join(f"{i:05d} a" for i in range(2000))
    language.fit_language(documents([(1, text, "en")]), each=40)
    places = [text.find(seen[0][i : i + 100].decode()) for i in range(0, len(seen[0]), 256)]
    assert len(set(places)) > 30 and min(places) < 3000 and max(places) > 11_000
