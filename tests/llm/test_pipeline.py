import pytest

from tests.llm.conftest import FOLDER

pytestmark = pytest.mark.skipif(FOLDER is None, reason="no test tables")


def test_each_stage_acts_on_what_the_one_before_kept(spark):
    import corpus_pipeline as cp
    from claimweave.llm import decontaminate, jaccard, packing, privacy

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    stages = dict(cp.STAGES)
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]
    good = stages["quality"](spark, docs, FOLDER).cache()
    kept = {r["doc_id"] for r in good.select("doc_id").collect()}
    assert good.columns == docs.columns
    agree = [(d in kept) == (q == 1) for d, q in labels.items() if q is not None]
    assert sum(agree) > 0.97 * len(agree)
    one = stages["near_duplicates"](spark, good, FOLDER).cache()
    groups = jaccard.near_groups(good).collect()
    assert {r["doc_id"] for r in one.collect()} == {r["component_id"] for r in groups}
    clean = stages["decontamination"](spark, one, FOLDER).cache()
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert not any(x in t for t in left.values() for x in items)
    leaks = {r["doc_id"] for r in decontaminate.contaminated(one, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()}
    assert set(left) == {r["doc_id"] for r in one.select("doc_id").collect()} - leaks
    masked = stages["personal_data"](spark, clean, FOLDER).cache()
    out = {r["doc_id"]: r for r in masked.collect()}
    assert set(out) == set(left) and masked.columns == docs.columns
    for d, r in out.items():
        assert not privacy.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        assert r["text"] == left[d] or privacy.base_spans(left[d])
    places = stages["packing"](spark, masked, FOLDER).collect()
    assert {r["doc_id"] for r in places} == set(out) and max(r["offset"] + r["length"] for r in places) <= packing.CAPACITY


def test_run_returns_the_last_stage(spark):
    import corpus_pipeline as cp

    assert cp.run(spark, FOLDER).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_rows_that_break_rules(spark, documents):
    import corpus_pipeline as cp

    rows = [(1, None), (2, ""), (None, "a b c"), (None, None), (3, "same words in this text"), (3, "same words in this text"), (4, "x@y.zz")]
    for rowset in (rows, []):
        docs = documents(rowset)
        for _, stage in cp.STAGES[1:4]:
            docs = stage(spark, docs, FOLDER)
        found = docs.collect()
        assert len(found) == (6 if rowset else 0)
        assert docs.columns == documents([]).columns


def test_one_row_of_each_group_where_ids_repeat(spark, documents):
    import corpus_pipeline as cp

    a, b = ([f"{x}{i}" for i in range(60)] for x in "pq")
    rows = [(5, " ".join(a)), (5, " ".join([*a, "more"])), (5, " ".join(b)), (3, " ".join([*b, "more"]))]
    kept = cp.one_of_each_group(spark, documents(rows), FOLDER).collect()
    assert sorted(r["doc_id"] for r in kept) == [3, 5] and {r["text"] for r in kept} & {t for _, t in rows[:2]}


def test_columns_of_the_input_keep_their_values(spark, documents):
    import corpus_pipeline as cp

    rows = [(1, "mail a@b.cc to the office"), (2, "mail a@b.cc to the office"), (None, "x@y.zz"), (3, None)]
    for _, stage in cp.STAGES[:4]:
        docs = documents(rows)
        names = [c for c in docs.columns if c not in ("text", "n_chars")]
        before = {tuple(r) for r in docs.select(*names).collect()}
        found = stage(spark, docs, FOLDER)
        assert found.columns == docs.columns
        assert {tuple(r) for r in found.select(*names).collect()} <= before


def test_the_row_of_a_repeated_document_does_not_depend_on_order(spark):
    import corpus_pipeline as cp

    words = " ".join(f"w{i}" for i in range(40))
    rows = [(1, words, k, "x") for k in range(6)] + [(2, words + " more", 9, "y"), (None, words, 1, "z"), (3, "", 1, "a"), (3, "", 2, "a")]
    kept = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, key int, kept_row string").repartition(3)
        kept.append(sorted(map(tuple, cp.one_of_each_group(spark, docs, FOLDER).collect()), key=str))
    assert kept[0] == kept[1] and [r[0] for r in kept[0]].count(1) == 1
    assert sorted(r[0] or 0 for r in kept[0]) == [0, 1, 3]


def test_very_long_texts_pass_all_stages(spark, documents):
    import corpus_pipeline as cp

    long = " ".join(f"plain{i % 7919} words" for i in range(60_000))
    docs = documents([(1, long), (2, long + " a@b.cc"), (3, "short text")])
    for _, stage in cp.STAGES[1:]:
        docs = stage(spark, docs, FOLDER)
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} == {1, 3}
