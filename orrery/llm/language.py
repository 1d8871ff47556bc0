"""Language identification, word first.

A known word counts with its log frequency in each language. An unseen word
falls back to its character 5-grams, then 4-grams and so on down to single
characters: the first length of which any is known decides.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import binary_texts, crc_bucket_col, portions

UNDETERMINED = "und"
# Words begin with a letter and go on with letters and the marks on them
# (Unicode categories L and M); numerals such as a half or a Roman eight are
# no letters. Texts of Latin-1 characters, which has no marks, go by the
# faster pattern.
_LATIN = re.compile(r"[^\W\d_\xb2\xb3\xb9\xbc-\xbe]+")
_ANY = r"\p{L}[\p{L}\p{M}]*"
_LONGEST = 40  # letters of a run that count as one word; longer runs are cut (scripts without spaces)
_ORDERS = (5, 4, 3, 2, 1)


def words_of(text: bytes | None) -> list[str]:
    """Runs of letters with their marks, lower-cased; runs of over 40 characters in pieces of 40."""
    if not text:
        return []
    lower = text.decode("utf-8", "replace").lower()
    try:
        lower.encode("latin-1")
        w = _LATIN.findall(lower)
    except UnicodeEncodeError:
        import regex
        w = regex.findall(_ANY, lower)
    if w and max(map(len, w)) > _LONGEST:
        w = [x[i:i + _LONGEST] for x in w for i in range(0, len(x), _LONGEST)]
    return w


def grams_of(word: str, order: int) -> list[str]:
    if order == 1:
        return list(word)
    w = f"^{word}$"
    return [w[i:i + order] for i in range(len(w) - order + 1)]


class Model:
    """Log frequencies by language: ``words`` and ``grams`` map to rows of ``table``."""

    def __init__(self, counts: pa.Table, smoothing: float = 0.5):
        self.languages = sorted(counts["lang"].unique().to_pylist(), key=lambda s: s.encode())
        at = {lang: i for i, lang in enumerate(self.languages)}
        kinds = counts["kind"].to_numpy()
        self.index, rows, first = {}, [], 0
        for kind in np.unique(kinds).tolist():
            part = counts.filter(pa.array(kinds == kind))
            grams = part["gram"].combine_chunks().dictionary_encode()
            names = grams.dictionary.to_pylist()
            c = np.zeros((len(names), len(self.languages)))
            np.add.at(c, (grams.indices.to_numpy(), np.array([at[x] for x in part["lang"].to_pylist()])), part["n"].to_numpy().astype(float))
            log = np.log((c + smoothing) / (c.sum(axis=0) + smoothing * (len(names) + 1)))
            self.index[kind] = {g: first + i for i, g in enumerate(names)}
            first += len(names)
            rows.append((log - log.mean(axis=1, keepdims=True)).astype(np.float32))
        self.table = np.concatenate(rows) if rows else np.zeros((0, len(self.languages)), np.float32)

    def unseen(self, word: str) -> np.ndarray | None:
        for order in _ORDERS:
            known = self.index.get(order)
            if known:
                rows = [known[g] for g in grams_of(word, order) if g in known]
                if rows:
                    return self.table[rows].mean(axis=0)
        return None


def fit(docs: DataFrame, docs_per_language: int = 4000, words_per_language: int = 20_000, grams_per_language: int = 20_000) -> Model:
    """Learn from (doc_id, text, lang) rows with a language.

    At most about ``docs_per_language`` documents of each language are used,
    chosen by hash; whole texts. The model keeps the most frequent words and
    character n-grams of each language, which bounds what the driver gathers
    and broadcasts. Ties in frequency go by code point.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = known.groupBy("lang").agg((F.lit(float(docs_per_language)) / F.count(F.lit(1))).alias("share"))
    spot = (F.pmod(F.xxhash64(F.col("doc_id"), F.lit(4)), F.lit(1 << 30)) / float(1 << 30))
    sample = known.select("doc_id", "text", "lang").join(F.broadcast(share), "lang").filter(spot < F.col("share")).select("lang", "text")

    def count(batches):
        by, most = {}, 100_000  # words held at a time, of all languages
        for batch in portions(batches, 1):
            for lang, text in zip(batch.column(0).to_pylist(), binary_texts(batch.column(1))):
                by.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, by.values())) >= most:
                yield from counted(by)
                by = {}
        yield from counted(by)

    def counted(by):
        # One language and length of grams at a time: few counts are held beside the words.
        for lang, words in by.items():
            for kind in (0, *_ORDERS) if words else ():
                out = words
                if kind:
                    out = Counter()
                    for w, n in words.items():
                        for g in grams_of(w, kind):
                            out[g] += n
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(out), pa.string()), pa.array([kind] * len(out), pa.int32()),
                                                      pa.array(out, pa.string()), pa.array(out.values(), pa.int64())],
                                                     names=["lang", "kind", "gram", "n"])

    counts = sample.mapInArrow(count, "lang string, kind int, gram string, n long").groupBy("lang", "kind", "gram").agg(F.sum("n").alias("n"))
    counts = counts.filter("n > 1 or kind = 1")
    order = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), F.col("gram"))
    most = F.when(F.col("kind") == 0, words_per_language).otherwise(grams_per_language)
    top = counts.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= max(words_per_language, grams_per_language)).filter(F.col("k") <= most)
    return Model(top.drop("k").toArrow())


def predict(docs: DataFrame, model: Model, remember: int = 100_000) -> DataFrame:
    """Adds lang_pred and score to the rows, in place of columns of these names (a null text or one without
    letters is ``und`` with score 0; with nothing learned, all are).

    The score is the posterior of the best language, the evidence of at most
    50 words' weight counted; ties go to the first language by code point.
    """
    docs = docs.drop("lang_pred", "score")
    # Plain dicts and an array: broadcasts are pickled by reference, and a worker need not have this package.
    shared = docs.sparkSession.sparkContext.broadcast(model.__dict__)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    place = docs.columns.index("text")

    def tag(batches):
        m = Model.__new__(Model)
        m.__dict__.update(shared.value)
        n_lang = len(m.languages)
        known = m.index.get(0, {})

        class Rows(dict):
            """Word -> row of one growing table: the model's, then those of unseen words."""

            def forget(self):
                self.clear()
                self.table, self.used = m.table, len(m.table)

            def __missing__(self, word):
                at = known.get(word)
                if at is None:
                    if self.used == len(self.table):
                        self.table = np.concatenate([self.table, np.zeros((max(4096, len(self.table) // 4), n_lang), np.float32)])
                    at, v = self.used, m.unseen(word)
                    self.table[at] = 0 if v is None else v
                    self.used += 1
                self[word] = at
                return at

        rows = Rows()
        rows.forget()
        for batch in portions(batches, place):
            size, pred, score = batch.num_rows, [], []
            words = [words_of(t) if n_lang else [] for t in binary_texts(batch.column(place))]
            counts = np.fromiter(map(len, words), np.int64, size)
            if len(rows) > remember:
                rows.forget()
            at = np.fromiter((rows[w] for ws in words for w in ws), np.int64, int(counts.sum()))
            doc = np.repeat(np.arange(size), counts)
            total = np.stack([np.bincount(doc, rows.table[at, j], size) for j in range(n_lang)], 1) if n_lang else np.zeros((size, 0))
            mean = total / np.maximum(counts, 1)[:, None] * np.minimum(counts, 50)[:, None]
            for n, row in zip(counts.tolist(), mean):
                if not n:
                    pred.append(UNDETERMINED)
                    score.append(0.0)
                    continue
                e = np.exp(row - row.max())
                pred.append(m.languages[int(row.argmax())])
                score.append(float(1 / e.sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             names=[*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(tag, ", ".join(fields) + ", lang_pred string, score double")


def held_out(doc_id: str = "doc_id"):
    """The fold that no model of the query learns from."""
    return crc_bucket_col(doc_id, 4) == 2


def op4(spark, sf_dir) -> DataFrame:
    from ..tables import read_table
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
