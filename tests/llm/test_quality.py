import itertools
import zlib

import numpy as np
import pytest

from claimweave.llm import quality
from tests.llm.conftest import LARGER


def test_marginals_match_all_labellings():
    rng = np.random.default_rng(3)
    per_text = np.array([3, 1, 5, 2])
    features = rng.standard_normal((per_text.sum(), 4))
    field = quality.LineField(rng.standard_normal(4), rng.standard_normal((2, 2)))
    good, moved, norm = field.marginals(features, per_text)
    at, want, moves, total = 0, [], np.zeros((2, 2)), 0.0
    for n in per_text:
        unary = features[at : at + n] @ field.weights
        weights = {}
        for labels in itertools.product((0, 1), repeat=int(n)):
            s = sum(u for u, y in zip(unary, labels) if y) + sum(field.moves[a, b] for a, b in zip(labels, labels[1:]))
            weights[labels] = np.exp(s)
        z = sum(weights.values())
        total += np.log(z)
        want += [sum(v for y, v in weights.items() if y[i]) / z for i in range(n)]
        for y, v in weights.items():
            for a, b in zip(y, y[1:]):
                moves[a, b] += v / z
        at += n
    assert np.allclose(good, want) and np.allclose(moved, moves) and np.isclose(norm, total)


def test_line_features_of_each_text_alone():
    texts = [b"One line.\nTwo TWO two!!", b"", "É à ç | 12 | 12".encode(), b"\n\n", b"the the the\nthe"]
    together, size, per_text = quality.line_features(texts)
    assert per_text.tolist() == [2, 1, 1, 3, 2] and np.isfinite(together).all()
    alone = np.concatenate([quality.line_features([t])[0] for t in texts])
    assert np.allclose(together, alone)
    wide = quality.with_neighbours(together, per_text)
    assert (wide[0, 16:32] == 0).all() and (wide[1, 16:32] == together[0]).all() and (wide[1, 32:] == 0).all()


@pytest.mark.skipif(LARGER is None, reason="no test tables")
def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{n}.parquet") for n in ("documents", "labels"))
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = quality.classify_quality(docs, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and known.get(r["doc_id"]) is not None]
    assert np.mean([r["predicted"] == known[r["doc_id"]] for r in held]) > 0.95


def test_nulls_long_lines_and_no_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(1, None), (2, ""), (3, "x" * 200_000), (4, "\n" * 5000), (None, "words"), (2, "")]
    got = quality.classify_quality(documents(rows), none).collect()
    assert len(got) == 6 and all(r["score"] == 0.5 for r in got)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (41, None)], "doc_id long, quality int")
    docs = documents(rows[:0] + [(i, "Fine words here.\nAnd more." if i % 2 else "@@ ## !!\n$$ %%") for i in range(40)] + [(100, None), (None, "Fine words here.")])
    found = quality.classify_quality(docs, labels).collect()
    assert len(found) == 42 and all(r["predicted"] == r["doc_id"] % 2 for r in found if r["doc_id"] is not None and r["doc_id"] < 40)
    assert quality.classify_quality(documents([]), labels).count() == 0


def test_training_takes_whole_texts_of_labels_with_documents(spark, documents, monkeypatch):
    texts, seen = ["a good line.\n" * 3000 + f"|| {i} ||" for i in range(3)], []
    monkeypatch.setattr(quality, "train_quality", lambda t, labels: seen.extend(t))
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    quality.fit_quality(documents(list(enumerate(texts))), labels, most=3)
    assert sorted(seen) == [t.encode() for t in texts]
