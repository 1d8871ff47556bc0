"""From raw documents to packed training sequences.

STAGES are (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents. Extra columns
of documents, whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orrery.llm import classifier, language, mixing, neardup, packing
from orrery.llm.common import written
from orrery.tables import read_table

LEAST_LANGUAGE_SCORE = 0.5
_BATCH, _BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20)


def _small_batches(spark: SparkSession) -> None:
    """Texts go to the Python workers in Arrow batches of 4 MB, not of 10,000
    rows whatever their length, which executor and worker each hold whole (and
    the stage's last step is planned after it returns, so this stays set). What
    the session says itself holds."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, _BATCH_BYTES)


def _filtered(docs: DataFrame, judged, keep: str) -> DataFrame:
    """The rows of docs that ``judged`` (rows with numbered column names -> rows
    with a verdict) keeps, under their own names."""
    numbered = docs.toDF(*[c if c in ("text", "doc_id") else f"c{i}" for i, c in enumerate(docs.columns)])
    names = numbered.columns
    return judged(numbered).filter(keep).select(*names).toDF(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (low quality, toxic or without words) go."""
    _small_batches(spark)
    model = classifier.fit(docs.select("doc_id", "text"), read_table(spark, sf_dir, "labels"))
    return _filtered(docs, lambda d: classifier.classify(d, model), "kept")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letters or no language the model is sure of.

    The model learns the languages of three quarters of the documents with a
    language; with none, there is nothing to reject by and all documents stay.
    """
    _small_batches(spark)
    model = language.fit(docs.select("doc_id", "text", "lang").filter(~language.held_out()))
    if not model.languages:
        return docs
    return _filtered(docs, lambda d: language.predict(d, model), f"lang_pred <> '{language.UNDETERMINED}' and score >= {LEAST_LANGUAGE_SCORE}")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one of the smallest
    doc_id (none counts as largest). Shingles of five words, similarity 0.8.

    Rows are judged, not ids: each gets a key of its own, so two texts under
    one id are two documents, and copies without id are copies. Among rows of
    one id a hash of all their columns decides, so reruns keep the same ones.
    """
    _small_batches(spark)
    names = [f"c{i}" for i in range(len(docs.columns))]
    doc_id, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    rows = written(docs.toDF(*names).withColumn("row", F.monotonically_increasing_id()), "near-duplicate-rows")
    found = neardup.near_duplicates(rows.select(F.col("row").alias("doc_id"), F.col(text).alias("text")), width=5, percent=80)
    found = written(found.select(F.col("doc_id").alias("row"), "component_id"), "near-duplicates", gathered=True)
    order = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.xxhash64(*names).alias("h"), F.col("row").alias("row"))
    first = rows.select("row", order.alias("order")).join(found, "row").groupBy("component_id").agg(F.min("order").alias("order"))
    return rows.join(first.select(F.col("order.row").alias("row")), "row", "left_semi").drop("row").toDF(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: one row for each time the schedule takes a document.

    A document taken whole keeps its text; where a source's target ends
    inside a document, the last copy holds the words taken, parted by single
    spaces, and its n_chars says so. Documents never taken go.
    """
    documents, pieces = mixing.mix(docs.select("doc_id", "source", "text"))
    taken = pieces.groupBy("source_no", "start", "epoch").agg(
        F.min("from_word").alias("a"), F.max(F.col("from_word") + F.col("n_words")).alias("z"))
    same = ["doc_id", "source", "size"]
    copy = F.row_number().over(Window.partitionBy(*same).orderBy("start"))
    placed = documents.filter("size > 0").withColumn("copy", copy).join(taken, ["source_no", "start"]).select(*same, "copy", "a", "z")
    names = [f"c{i}" for i in range(len(docs.columns))]
    place = {c: names[i] for i, c in reversed(list(enumerate(docs.columns)))}
    rows = docs.toDF(*names).withColumn("n", mixing.word_count(F.col(place["text"])))
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy(place["doc_id"], place["source"], "n").orderBy(place["text"])))
    both = rows.join(placed, F.col(place["doc_id"]).eqNullSafe(F.col("doc_id")) & F.col(place["source"]).eqNullSafe(F.col("source"))
                     & (F.col("n") == F.col("size")) & (rows["copy"] == placed["copy"]))
    whole = (F.col("a") == 0) & (F.col("z") == F.col("size"))
    part = F.array_join(F.slice(F.regexp_extract_all(F.col(place["text"]), F.lit(mixing.WORD_PATTERN), F.lit(0)),
                                (F.col("a") + 1).cast("int"), (F.col("z") - F.col("a")).cast("int")), " ")
    text = F.when(whole, F.col(place["text"])).otherwise(part)
    out = {place["text"]: text}
    if "n_chars" in place:
        out[place["n_chars"]] = F.when(whole, F.col(place["n_chars"])).otherwise(F.length(part)).cast(docs.schema["n_chars"].dataType)
    return both.select(*[out.get(c, F.col(c)).alias(c) for c in names]).toDF(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of the mix (its columns: those of the packing operator)."""
    _small_batches(spark)
    return packing.pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("source_mixing", mixing_stage),
    ("packing", packing_stage),
]

# The classifier, the language model and the tokenizer cannot be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {}
