"""What Python workers hold of large Arrow batches."""
import contextlib
import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from orrery.llm import alignment, classifier, common, language


class Docs:
    """Stands in for a DataFrame (doc_id, text): keeps the function given to mapInArrow."""

    columns = ["doc_id", "text"]
    schema = [SimpleNamespace(name=n, dataType=SimpleNamespace(simpleString=lambda t=t: t)) for n, t in (("doc_id", "bigint"), ("text", "string"))]
    sparkSession = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value)))

    def drop(self, *names):
        return self

    def mapInArrow(self, f, schema):
        return f


def batch_of(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])


def tagger():
    counts = pa.table({"lang": ["de", "en", "de", "en"], "kind": pa.array([0, 0, 1, 1], pa.int32()), "gram": ["haus", "house", "z", "w"], "n": [5, 5, 5, 5]})
    return language.predict(Docs(), language.Model(counts))


def scorer():
    r = np.random.default_rng(3)
    return classifier.classify(Docs(), {k: (r.normal(0, 0.1, classifier._size()), 0.0) for k in ("quality", "toxic")})


ODD = [None, "", " \n", "haus", "house house", None, "x" * 2_500_000, "w " * 700_000, "", "z z", "house"]


@pytest.mark.parametrize("f", [tagger, scorer])
def test_rows_of_a_batch_cut_in_portions(f):
    whole = pa.Table.from_batches(f()(iter([batch_of(ODD)]))).to_pylist()
    single = [row for i in range(len(ODD)) for row in pa.Table.from_batches(f()(iter([batch_of(ODD).slice(i, 1)]))).to_pylist()]
    assert [r["doc_id"] for r in whole] == list(range(len(ODD)))
    assert whole == single
    assert not list(f()(iter([batch_of([])]))) or not pa.Table.from_batches(f()(iter([batch_of([])]))).num_rows


@pytest.mark.parametrize("f, most", [(tagger, 30e6), (scorer, 6e6)])
def test_worker_memory_does_not_grow_with_the_batch(f, most):
    r = random.Random(1)
    words = ["".join(r.choices("abcdefghwz", k=r.randint(3, 8))) for _ in range(3000)]
    batch, run = batch_of([" ".join(r.choices(words, k=400)) for _ in range(3500)]), f()
    assert batch.nbytes > 8e6
    tracemalloc.start()
    try:
        n = sum(out.num_rows for out in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 3500
    assert peak < most


def test_alignment_memory_does_not_grow_with_the_batch(monkeypatch):
    monkeypatch.setattr(alignment, "written", lambda f, what, **k: f)
    monkeypatch.setattr(alignment, "arrow_batches", lambda spark: contextlib.nullcontext(), raising=False)
    monkeypatch.setattr(alignment, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 1)))

    class Columns(Docs):
        def select(self, *columns):
            return self

    monkeypatch.setattr(alignment, "F", SimpleNamespace(col=lambda name: SimpleNamespace(cast=lambda kind: name)))
    import public_tokenizers as public
    run = alignment.align_blocks(Columns(), public.path("byte_bpe_50k.tiktoken"), public.path("piece_bpe_32k.model"), public.PATTERN)
    r = random.Random(2)
    words = ["".join(r.choices("abcdefghwz", k=r.randint(3, 8))) for _ in range(3000)]
    list(run(iter([batch_of([" ".join(words)])])))  # the tokenizers and the words are known
    batch = batch_of([" ".join(r.choices(words, k=400)) for _ in range(3500)])
    assert batch.nbytes > 8e6
    tracemalloc.start()
    try:
        rows = sum(b.column(0).to_pylist().count("document") for b in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 3500
    assert peak < 80e6
    common.forget("alignment")


def test_what_a_worker_kept_for_a_stage_is_forgotten():
    made = []
    for _ in range(2):
        common.worker_state(("forgotten", 1), lambda: made.append(1))
        common.worker_state(("forgotten-not", 1), lambda: made.append(2))
    common.forget("forgotten")
    common.worker_state(("forgotten", 1), lambda: made.append(1))
    common.worker_state(("forgotten-not", 1), lambda: made.append(2))
    assert made == [1, 2, 1]
    common.forget("forgotten"), common.forget("forgotten-not"), common.forget("never")


def test_alignment_asks_for_arrow_batches_by_bytes(spark, docs_of, monkeypatch):
    conf, seen, write = "spark.sql.execution.arrow.maxBytesPerBatch", [], alignment.written
    monkeypatch.setattr(alignment, "written", lambda df, what, **k: seen.append(spark.conf.get(conf, None)) or write(df, what, **k))
    before = spark.conf.get(conf, None)
    try:
        for said in (None, "1234567"):
            spark.conf.unset(conf) if said is None else spark.conf.set(conf, said)
            assert alignment.align_documents(docs_of(["one two", "three"])).count() == 2
            assert spark.conf.get(conf, None) == said
    finally:
        spark.conf.unset(conf) if before is None else spark.conf.set(conf, before)
    assert seen[0] == str(4 << 20) and seen[2] == "1234567"
