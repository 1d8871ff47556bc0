"""How many files and how large Arrow batches the pipeline makes."""
import pyarrow as pa
import pytest

import corpus_pipeline
from orrery.llm import common, components, neardup

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def wide(spark):
    """Shuffles of 40 partitions that Spark does not join to fewer."""
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def files(monkeypatch):
    """Names of the tables written and their numbers of files."""
    made, write = [], common.written

    def watched(df, what, *a, **k):
        out = write(df, what, *a, **k)
        made.append((what, len(out.inputFiles())))
        return out

    for module in (common, components, neardup):
        monkeypatch.setattr(module, "written", watched)
    return made


def test_written_gathers_the_files_of_a_wide_shuffle(wide):
    df = wide.range(8000).selectExpr("id % 2000 as id").groupBy("id").count()
    apart, gathered = common.written(df, "test"), common.written(df, "test", gathered=True)
    assert len(apart.inputFiles()) == 40
    assert 1 <= len(gathered.inputFiles()) <= wide.sparkContext.defaultParallelism < 40
    assert sorted(map(tuple, gathered.collect())) == sorted(map(tuple, apart.collect())) == [(i, 4) for i in range(2000)]
    assert common.written(df.filter("id < 0"), "test", gathered=True).count() == 0


def test_tables_of_near_duplicates_have_few_files(wide, files):
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) + f" end{k}" for i in range(100) for k in range(2)]
    docs = wide.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    out = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    assert out == {i: i - i % 2 for i in range(200)}
    most = max(4, wide.sparkContext.defaultParallelism)
    names = {what for what, _ in files}
    assert {"classes", "buckets", "shingle-sets", "close-pairs", "links", "edges", "components", "open-buckets", "met"} <= names
    for what, n in files:
        assert n <= (2 * most if what == "components" else most), what  # components: two tables in one


def test_stages_ask_for_arrow_batches_by_bytes(spark, docs_of):
    docs = docs_of(["one two three"])
    before = spark.conf.get(BATCH, None)
    try:
        for _, stage in corpus_pipeline.STAGES[:3]:
            spark.conf.unset(BATCH)
            assert stage(spark, docs, "/root/testdata/sf0.001").columns == docs.columns
            assert int(spark.conf.get(BATCH)) == 4 << 20
        spark.conf.set(BATCH, "1234567")
        corpus_pipeline.STAGES[1][1](spark, docs, "/root/testdata/sf0.001")
        assert spark.conf.get(BATCH) == "1234567"
        spark.conf.unset(BATCH)
        corpus_pipeline._small_batches(spark)
        large = spark.range(0, 4000, 1, 1).selectExpr("id", "repeat('abcd', 1000) t")
        sizes = [r.b for r in large.mapInArrow(lambda bs: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["b"]) for b in bs), "b long").collect()]
        assert len(sizes) >= 4 and max(sizes) < 5e6
    finally:
        spark.conf.unset(BATCH) if before is None else spark.conf.set(BATCH, before)
