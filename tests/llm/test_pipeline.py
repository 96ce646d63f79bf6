"""The pipeline against its stages done plainly in Python."""

import corpus_pipeline
from claimlens.llm import bytecnn, decontam, langid, pieces, simhash
from tests.llm.test_scans_and_chat import slow_scan
from tests.llm.test_search_and_copies import classes

SF = "/root/testdata/sf0.01"


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}

    rows = [tuple(r) for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]
    model = langid.fit(docs)
    rows = [r for r in rows if langid.classify(model, r[1])[0] != "und" and langid.classify(model, r[1])[1] >= 0.5]
    kept = docs.join(spark.createDataFrame([(r[0],) for r in rows], "doc_id long"), "doc_id", "left_semi")
    net = bytecnn.fit(kept, labels)
    rows = [r for r in rows if bytecnn.probability(net, net.paired(), r[1]) >= 0.3]
    fps = [simhash.fingerprint(t) for _, t in rows]
    rows = [r for r, c in zip(rows, classes([r[0] for r in rows], fps, 2)) if r[0] == c]
    rows = [r for r, s in zip(rows, slow_scan(rows, items, 10)) if not s[1]]
    assert {i: t for i, t in rows} == {i: r.decoded for i, r in got.items()}
    spm = pieces.read_model()
    assert all(pieces.decode(spm, r.piece_ids) == r.decoded and r.exact for r in got.values())


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language id", "quality classifier", "simhash near-dedup", "benchmark decontamination", "sentencepiece"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0).selectExpr("*", "1 as score", "'x' as fp")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_stage_edge_cases(spark):
    """Nulls, repeated rows and clashing names pass through the filters with a defined result."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(None, "The and of the with this. And the of that in the house of words.", None, None, None, "f"), (1, None, "en", "s", 0, "f"), (2, "", "en", "s", 0, "f")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string")
    both = docs.selectExpr("*", "'f' as fp").unionByName(odd)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, both, SF)
        assert out.columns == both.columns
        out.count()
    assert decontam.keep_clean(odd, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 3


def test_one_row_of_each_class_stays(spark):
    """Copies without an id are copies too, and a repeated id stands for each of its classes."""
    a, b, c = (" ".join(f"{w}{k}" for k in range(60)) for w in ("alpha", "beta", "gamma"))
    rows = [(None, a, 1), (None, a, 2), (7, a, 3), (None, c + " end", 4), (None, c + " end", 5), (3, b, 6), (5, b, 7), (5, c, 8), (9, None, 9), (None, "", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = simhash.keep_first(docs, radius=2, shingle=3)
    assert got.schema.fieldNames() == docs.columns
    first = {simhash.fingerprint(t): t for _, t, _ in rows}
    assert len(first) == 5
    assert sorted((r.doc_id or 0, (r.text or "")[:3]) for r in got.collect()) == [(0, "gam"), (3, "bet"), (5, "gam"), (7, "alp"), (9, "")]
    nulls = spark.createDataFrame([(None, t) for t in (a, b, a, b, a)], "doc_id string, text string")
    assert sorted(r.text for r in simhash.keep_first(nulls).collect()) == [a, b]
