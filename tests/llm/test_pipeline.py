"""The pipeline's stages one by one against what each may keep, and the registration."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from replicheck.llm import mixing, pii
from replicheck.llm.queries import vocabulary
from test_jaccard import brute


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.schema.simpleString() == stages[0].schema.simpleString()


def test_toxic_go(stages):
    before, after = ({r.doc_id for r in df.collect()} for df in stages[:2])
    assert after <= before and len(after) >= 0.8 * len(before)


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    want = {c for _, _, c in brute(rows, size=corpus_pipeline.SHINGLE, percent=corpus_pipeline.ALIKE)}
    assert {r.doc_id for r in stages[2].collect()} == want


def test_masked(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    for r in stages[3].collect():
        assert r.n_chars == len(r.text)
        assert not pii.base_spans(r.text)
        if not any(c in before[r.doc_id] for c in "@0123456789"):
            assert r.text == before[r.doc_id]


def test_mixed(stages):
    rows = stages[3].collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    names = sorted(sizes)
    goal = mixing.targets([sizes[s] for s in names], [1 + i % 3 for i in range(len(names))])
    taken = dict.fromkeys(names, 0)
    for r in stages[4].collect():
        taken[r.source] += len(r.text.split())
    longest = max(len(r.text.split()) for r in rows)
    assert all(abs(taken[s] - g) <= longest for s, g in zip(names, goal))


def test_encoded(stages):
    texts = sorted((r.doc_id, r.text.encode()) for r in stages[4].collect())
    got = sorted((r.doc_id, b"".join(vocabulary()[i] for i in r.ids)) for r in stages[5].collect())
    assert got == texts


def test_of_copies_without_an_id_or_with_one_for_several_texts_one_row_stays(spark):
    base, other = " ".join(f"w{i}" for i in range(50)), " ".join(f"v{i}" for i in range(50))
    rows = [(None, base), (None, base), (1, other), (1, base), (1, other), (2, other), (None, None), (None, None), (3, "")]
    df = spark.createDataFrame([(d, t, "s") for d, t in rows], "doc_id long, text string, source string")
    kept = sorted((r.doc_id or -1, r.text or "") for r in corpus_pipeline.drop_near_copies(spark, df, "").collect())
    assert kept == [(-1, ""), (-1, ""), (1, other), (1, base), (3, "")]


@pytest.mark.parametrize("empty", [True, False])
def test_whole_chain_on_empty_tables_and_rows_without_ids(spark, tmp_path, empty):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0 if empty else 30)
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").limit(0 if empty else 1000)
    docs = docs.withColumn("doc_id", F.expr("if(doc_id % 2 = 0, doc_id, null)"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "source", "n_tokens", "ids"]
    assert (out.count() == 0) == empty
    if not empty:
        assert out.filter("doc_id is null").count() > 0


def test_near_copies_by_five_words_and_four_fifths(spark):
    """Also a copy with a fifth of its text added, which is no near copy by four words and 85%."""
    base = [f"w{i}" for i in range(104)]
    rows = [(1, " ".join(base)), (2, " ".join(base + [f"x{i}" for i in range(24)])),
            (3, " ".join(base + [f"y{i}" for i in range(40)])), (4, "another text of six words")]
    df = spark.createDataFrame([(d, t, "s") for d, t in rows], "doc_id long, text string, source string")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()}
    assert kept == {c for _, _, c in brute(rows, size=5, percent=80)} == {1, 3, 4}
    assert {c for _, _, c in brute(rows)} == {1, 2, 3, 4}


def test_texts_go_to_workers_in_small_batches(spark, tmp_path, monkeypatch):
    """A batch of texts is held whole by the executor and its worker."""
    spark.range(2_500).selectExpr("id as doc_id").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")

    def sizes(_, docs, __):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

        return docs.mapInArrow(run, "n long")

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("sizes", sizes)])
    assert sorted(r.n for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == [500, 2000]
    assert spark.conf.get(name) == before


def test_a_stage_by_itself_limits_bytes_of_batches(spark):
    """A caller that writes what a stage returns does so outside of ``run``."""
    before = {name: spark.conf.get(name) for name in corpus_pipeline.BATCH_LIMITS}
    docs = spark.range(0, 1_000, 1, 1).selectExpr("id as doc_id", "'s' as source", "repeat('word ', 2000) as text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    try:
        corpus_pipeline.encode_texts(spark, docs, "")
        seen = [r.n for r in docs.select("text").mapInArrow(sizes, "n long").collect()]
        assert sum(seen) >= 10_000_000
        assert max(seen) < 1.1 * corpus_pipeline.BATCH_BYTES
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
