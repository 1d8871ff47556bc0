"""Spelling variants: words one edit apart, found by Bloom-guided
neighbourhoods.

Every word of the vocabulary generates its edits as hashes only and probes
them against blocked Bloom filters of the vocabulary, one shard a word
length. Only probes that a filter lets through become strings, and an exact
join with the vocabulary removes the false ones. Deletions reach the shorter
neighbour and replacements by a later character the neighbour of equal
length, so every near pair is met exactly once; insertions are the same
pairs from the other side.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_texts, mix64, remove, written

_RUN = re.compile("[a-zÀ-ÿ]+")
_ROWS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def count_words(docs: DataFrame, least_length: int = 5, spread: int = 97, most: int = 300_000) -> DataFrame:
    """(doc_id, text) -> (word, n): partial counts of the words of at least
    ``least_length`` code points, a few rows a word and task.

    Words are maximal runs of Latin letters, A-Z lowered. An occurrence whose
    crc32 of ``<doc_id>:<run>`` ``spread`` divides loses one code point.
    A task holds at most about ``most`` words and one text.
    """

    def run(batches):
        found = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), binary_texts(batch.column(1))):
                if not text:
                    continue
                begun = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(_RUN.findall(text.lower().decode("utf-8", "replace"))).items():
                    if len(word) < least_length:
                        continue
                    h = zlib.crc32(word.encode(), begun)
                    if h % spread == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least_length:
                            continue
                    found[word] += n
                if len(found) >= most:
                    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], schema=_ROWS)
                    found = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], schema=_ROWS)

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n long")


def vocabulary(docs: DataFrame, least_length: int = 5, least: int = 3) -> DataFrame:
    """(word, n) of the words that occur ``least`` times or more."""
    return count_words(docs, least_length).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


# A word's hash is a polynomial of its code points, so that an edit's hash
# follows from the word's by one product. Its weakness costs false positives
# only, which the exact join removes.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LINES = 8  # words of 64 bits a block; a key sets one bit in each
_SALTS = mix64(np.arange(1, _LINES + 1)) | np.uint64(1)
_LONGEST_SHARD = 64  # longer words share a shard


def _powers(n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(0, n - 1), _BASE, np.uint64), dtype=np.uint64)])[:n]


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, one row a word."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)


class Filters:
    """Blocked Bloom filters of a vocabulary, one shard a word length."""

    def __init__(self, sizes: dict[int, int], bits_per_key: int):
        self.first, self.blocks, n = {}, {}, 0
        for length, keys in sorted(sizes.items()):
            self.first[length], self.blocks[length] = n, max(1, -(-keys * bits_per_key // (64 * _LINES)))
            n += self.blocks[length]
        self.words = np.zeros((n, _LINES), np.uint64)

    def place(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Block of every hash, and the mixed hash its bits come from."""
        u, length = mix64(hashes), min(length, _LONGEST_SHARD)
        return (self.first[length] + (((u >> np.uint64(32)) * np.uint64(self.blocks[length])) >> np.uint64(32)).astype(np.int64)), u

    @staticmethod
    def bit(u: np.ndarray, j: int) -> np.ndarray:
        return ((u & np.uint64(0xFFFFFFFF)) * _SALTS[j]) >> np.uint64(58)

    def possible(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Places in ``hashes`` that the filter lets through; most fall at its first word."""
        if min(length, _LONGEST_SHARD) not in self.blocks:
            return np.zeros(0, np.int64)
        block, u = self.place(hashes, length)
        at = np.arange(len(u))
        for j in range(_LINES):
            at = at[(self.words[block[at], j] >> self.bit(u[at], j)) & np.uint64(1) == 1]
        return at


def _by_length(words: list[str]) -> dict[int, list[int]]:
    out = defaultdict(list)
    for i, w in enumerate(words):
        out[len(w)].append(i)
    return out


def _hashes(codes: np.ndarray) -> np.ndarray:
    return (codes * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)


def build_filters(words: DataFrame, sizes: dict[int, int], part: int, parts: int, bits_per_key: int) -> Filters:
    """The filters of the keys of one part (by hash): tasks set the bits of
    their words by block, a group-by or-s the blocks, the driver gets no more
    than the filters' own size."""
    filters = Filters({k: -(-n // parts) for k, n in sizes.items()}, bits_per_key)

    def bits(batches):
        for batch in batches:
            ws = batch.column(0).to_pylist()
            for length, rows in _by_length(ws).items():
                h = _hashes(_codes([ws[i] for i in rows]))
                h = h[mix64(h + np.uint64(1)) % np.uint64(parts) == part]
                block, u = filters.place(h, length)
                found, inverse = np.unique(block, return_inverse=True)
                masks = np.zeros((len(found), _LINES), np.uint64)
                for j in range(_LINES):
                    np.bitwise_or.at(masks[:, j], inverse, np.uint64(1) << filters.bit(u, j))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), *[pa.array(masks[:, j].view(np.int64)) for j in range(_LINES)]],
                                                 names=["block", *[f"w{j}" for j in range(_LINES)]])

    schema = "block long, " + ", ".join(f"w{j} long" for j in range(_LINES))
    empty = filters.words
    filters.words = empty[:0]  # tasks need the shard sizes only
    rows = words.select("word").mapInArrow(bits, schema).groupBy("block").agg(
        *[F.bit_or(f"w{j}").alias(f"w{j}") for j in range(_LINES)]).toArrow()
    filters.words = empty
    if rows.num_rows:
        empty[rows.column("block").to_numpy()] = np.stack([rows.column(f"w{j}").to_numpy() for j in range(_LINES)], axis=1).view(np.uint64)
    return filters


def _edits(codes: np.ndarray, alphabet: np.ndarray, most: int):
    """Hashes of the edits of words of one length, in bounded runs: (hashes,
    length, rows, places, code points or None for deletions)."""
    n, length = codes.shape
    powers = _powers(length)
    whole = _hashes(codes)
    step = max(1, most // max(1, length))
    for a in range(0, n, step):
        c = codes[a:a + step]
        terms = c * powers
        upto = np.cumsum(terms, axis=1, dtype=np.uint64)
        gone = (upto - terms) + (whole[a:a + step, None] - upto) * _INVERSE
        # Deleting any letter of a run of equal ones is the same edit: the first counts.
        first = np.ones(c.shape, bool)
        first[:, 1:] = c[:, 1:] != c[:, :-1]
        row, place = np.nonzero(first)
        yield gone[row, place], length - 1, row + a, place, None
    for a in range(0, n, max(1, most // max(1, length * len(alphabet)))):
        rows = slice(a, a + max(1, most // max(1, length * len(alphabet))))
        wide = max(1, most // max(1, len(alphabet)))
        for p in range(0, length, wide):
            c = codes[rows, p:p + wide]
            later = alphabet[None, None, :] > c[:, :, None]
            row, place, letter = np.nonzero(later)
            new = alphabet[letter]
            h = whole[rows][row] + (new - c[row, place]) * powers[p:p + wide][place]
            yield h, length, row + a, place + p, new


def near_pairs(words: DataFrame, least_length: int = 5, bits_per_key: int = 24, most_bytes: int = 64 << 20, most: int = 500_000) -> DataFrame:
    """A written (word, n) table of distinct words -> every pair one edit
    apart, once: (a, n_a, b, n_b).

    The filters take ``bits_per_key`` bits a word. A broadcast is at most
    ``most_bytes``: a vocabulary whose filters are larger is gone through in
    as many parts by hash, each with filters of its own, so false positives
    stay as rare and no probe is lost. A word has a bounded number of edits,
    so no key of the exact join is hot.
    """
    spark = words.sparkSession
    # One row a length (64 at most), and the letters in use (the class has 90).
    sizes = {int(r[0]): r[1] for r in words.groupBy(F.least(F.length("word"), F.lit(_LONGEST_SHARD))).count().collect()}
    letters = [r[0] for r in words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).filter("c <> ''").distinct().collect()]
    alphabet = np.array(sorted(map(ord, letters)), np.uint64)
    parts = max(1, -(-sum(sizes.values()) * bits_per_key // (8 * most_bytes)))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = words.repartition(tasks)  # the work is in the edits, not in the few bytes of the words
    out = None
    for part in range(parts):
        shared = spark.sparkContext.broadcast(build_filters(words, sizes, part, parts, bits_per_key).__dict__)

        def probe(batches, shared=shared, part=part):
            filters = Filters.__new__(Filters)
            filters.__dict__.update(shared.value)
            for batch in batches:
                ws, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
                for length, rows in _by_length(ws).items():
                    at = np.array(rows)
                    for h, size, row, place, new in _edits(_codes([ws[i] for i in rows]), alphabet, most):
                        if size < least_length:
                            continue
                        if parts > 1:
                            mine = np.flatnonzero(mix64(h + np.uint64(1)) % np.uint64(parts) == part)
                            h, row, place, new = h[mine], row[mine], place[mine], None if new is None else new[mine]
                        hit = filters.possible(h, size)
                        if not len(hit):
                            continue
                        source, place = at[row[hit]], place[hit].tolist()
                        put = [""] * len(hit) if new is None else list(map(chr, new[hit].tolist()))
                        a = [ws[i] for i in source.tolist()]
                        b = [w[:p] + c + w[p + 1:] for w, p, c in zip(a, place, put)]
                        yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(counts[source], pa.int64()), pa.array(b, pa.string())],
                                                         names=["a", "n_a", "b"])

        maybe = dealt.select("word", "n").mapInArrow(probe, "a string, n_a long, b string")
        out = maybe if out is None else out.unionByName(maybe)
    known = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    return out.join(known, "b").select("a", "n_a", "b", "n_b")


def group_variants(docs: DataFrame, least_length: int = 5, least: int = 3, bits_per_key: int = 24, most_bytes: int = 64 << 20) -> DataFrame:
    """(doc_id, text) -> one row a word: word, form, root, n, n_near, form_n.

    ``form`` is the near word (one inserted, deleted or replaced code point)
    of largest n, the first by code points among equals, if it occurs at least
    twice as often as the word; ``root`` is where the forms lead. Null and
    empty texts and texts without letters hold no words; a null doc_id counts
    as empty; repeated rows count each; an empty table gives no rows; other
    columns are not read. A word may be as long as its text.
    """
    words = written(vocabulary(docs, least_length, least), "spelling-words")
    pairs = near_pairs(words, least_length, bits_per_key, most_bytes)
    sides = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("n")),
                    F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("n")))
    best = pairs.select(F.explode(sides).alias("s")).groupBy(F.col("s.word").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("s.n")).alias("less"), F.col("s.near").alias("form"))).alias("best"))
    often = -F.col("best.less") >= 2 * F.col("n")
    judged = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, F.col("best.form")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n")), "spelling-forms")
    # Down from the roots: a round joins the words whose form was placed in the
    # round before. Counts double along forms, so there are few rounds, and a
    # form has no more followers than edits, so no key is hot.
    follows = judged.filter("form is not null").select("word", "form")
    tops = follows.select("form").distinct().join(follows.select(F.col("word").alias("form")), "form", "left_anti")
    layer = tops.select(F.col("form").alias("word"), F.col("form").alias("root"))
    placed = None
    while True:
        layer = written(follows.join(layer.select(F.col("word").alias("form"), "root"), "form").select("word", "root"), "spelling-roots")
        if layer.isEmpty():
            remove(layer)
            break
        placed = layer if placed is None else placed.unionByName(layer)
    roots = judged.join(placed, "word", "left") if placed is not None else judged.withColumn("root", F.lit(None).cast("string"))
    return roots.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11(spark, sf_dir) -> DataFrame:
    from ..tables import read_table
    return group_variants(read_table(spark, sf_dir, "documents"))
