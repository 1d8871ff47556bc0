"""Letters of the language operator, rows of the near-duplicate stage, memos
of the workers, and workers that do not have the package."""

import os
import subprocess
import sys

import corpus_pipeline
from orrery.llm import common, language

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_letters_are_unicode_letters_with_their_marks():
    words = lambda t: language.words_of(t.encode())
    assert words("½ ² Ⅷ 3 ₂ ①_٣") == [] and words("½²³¹¼¾ 12") == []
    assert words("हिन्दी में") == ["हिन्दी", "में"]
    assert words("Éa2b l'été x²y") == ["éa", "b", "l", "été", "x", "y"]
    assert words("café ß ́alone") == ["café", "ß", "alone"]
    assert words("ªº µ 中文") == ["ªº", "µ", "中文"]


def test_numerals_have_no_language(spark, docs_of):
    docs = docs_of(["plain words here", "½ ² Ⅷ", "une phrase", None], langs=["en", "en", "fr", "fr"])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs.select("doc_id", "text"), language.fit(docs)).collect()}
    assert got[1] == ("und", 0.0) and got[3] == ("und", 0.0) and got[0][0] == "en" and got[2][0] == "fr"


def test_forgetting_unseen_words_changes_nothing(spark, docs_of):
    texts = [f"the words {chr(97 + i % 26) * 7}{i} and les mots {i}x{i}y" for i in range(300)]
    docs = docs_of(texts, langs=["en", "fr"] * 150).coalesce(1)
    model = language.fit(docs)
    all_of = lambda n: sorted(tuple(r) for r in language.predict(docs.select("doc_id", "text"), model, remember=n).collect())
    assert all_of(300_000) == all_of(3)


def test_near_duplicate_stage_judges_rows(spark, docs_of):
    long = " ".join(f"w{i}" for i in range(60))
    near, other, alone = long + " more", " ".join(f"v{i}" for i in range(60)), " ".join(f"u{i}" for i in range(60))
    # A near copy and a unique text share id 5; two near copies share id 7; copies without id.
    docs = docs_of([long, near, alone, other, other + " end", "x y z a b c d", "x y z a b c d", ""], ids=[1, 5, 5, 7, 7, None, None, 8])
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    got = sorted(((r.doc_id, r.text) for r in stage(spark, docs, "").collect()), key=repr)
    assert len(got) == 5
    assert (1, long) in got and (5, alone) in got and (None, "x y z a b c d") in got and (8, "") in got
    assert sum(i == 7 for i, _ in got) == 1
    assert got == sorted(((r.doc_id, r.text) for r in stage(spark, docs.repartition(3, "text"), "").collect()), key=repr)


def test_two_generations_keep_what_is_asked_for():
    memo = common.TwoGenerations(2)
    made = []

    def make(keys):
        made.extend(sorted(keys))
        return {k: k * 2 for k in keys}
    for keys in ({1, 2}, {1, 3}, {1, 4}, {1, 2}):
        memo.hold(keys, make)
        assert all(memo.young[k] == 2 * k for k in keys)
        memo.turn()
    assert made == [1, 2, 3, 4, 2]


def test_workers_need_no_package(tmp_path):
    """Only the driver's path has the package, as on a cluster that gets no archive."""
    code = f"""
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", "{tmp_path}/c").getOrCreate()
assert spark.range(1).rdd.map(lambda _: any(p == {REPO!r} for p in __import__('sys').path)).first() is False
sys.path.insert(0, {REPO!r})
from orrery.llm import alignment, chat, language, packing, spelling
docs = spark.createDataFrame([(i, f"some plain words {{i}} of it", "en") for i in range(9)], "doc_id long, text string, lang string")
turns = spark.createDataFrame([(1, 0, "assistant", "t")], "conv_id long, turn long, role string, text string")
print("ROWS", language.predict(docs.select("doc_id", "text"), language.fit(docs)).filter("lang_pred = 'en'").count(), spelling.group_variants(docs).count(),
      alignment.align_documents(docs).count(), packing.pack_documents(docs).count(), chat.read_back(chat.prefix_examples(turns)).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 9 2 9 9 1" in out.stdout, out.stdout[-500:] + out.stderr[-3000:]
