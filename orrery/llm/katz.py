"""Katz backoff language model over words.

Good-Turing discounted bigram and unigram counts with exactly normalised
backoff weights, in tables partitioned by hash, looked up per token: the
bigram if it was seen, else the backoff weight of its history times the
unigram, else the mass kept for unknown words.

How the work moves. Documents are gathered into blocks of about
``block_tokens`` tokens where they are read. A block asks each part of a
table once for its distinct keys (a sorted, compressed array a part) and
sends its own counts along, so counting, storing and looking up take one
shuffle, and a frequent word or pair is one entry a block however often it
occurs. The parts answer by block, in the order asked. Bigrams are parted by
a hash of both words, so a frequent word's bigrams are spread over all parts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Ids, binary_texts, chunks, crc_bucket_col, mix64, written

START, END, UNKNOWN, FIRST = 0, 1, 2, 3
_COLUMNS = (("kind", "string"), ("block", "long"), ("part", "int"), ("data", "binary"), ("counts", "binary"), ("extra", "binary"), ("flags", "binary"))
_ROWS = ", ".join(f"{c} {t}" for c, t in _COLUMNS)
_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
_SCHEMA = pa.schema([(c, _ARROW[t]) for c, t in _COLUMNS])
_BEGIN = b""  # the start of a text among the words; no word is empty


def _squeeze(raw: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=3).compress(raw)


def _expand(raw: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(raw)


def pack(a: np.ndarray) -> bytes:
    """Compressed bytes of an array, byte planes apart (high ones are mostly equal)."""
    a = np.ascontiguousarray(a)
    return _squeeze(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()) if len(a) else b""


def unpack(raw: bytes, kind) -> np.ndarray:
    if not raw:
        return np.empty(0, kind)
    planes = np.frombuffer(_expand(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=a.dtype.type(0)))


def unpack_sorted(raw: bytes, kind=np.uint64) -> np.ndarray:
    return np.cumsum(unpack(raw, kind), dtype=kind)


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def _row(kind, block=None, part=None, data=None, counts=None, extra=None, flags=None) -> dict:
    return {"kind": kind, "block": block, "part": part, "data": data, "counts": counts, "extra": extra, "flags": flags}


def _word_part(word: bytes, parts: int) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(word) % parts


def _history_part(h: np.ndarray, parts: int) -> np.ndarray:
    """The part of the vocabulary that numbered a word."""
    p = (h - np.uint64(FIRST)) % np.uint64(parts)
    return np.where(h == START, np.uint64(_word_part(_BEGIN, parts)), p).astype(np.int64)


def good_turing(of: np.ndarray, most: int) -> np.ndarray:
    """Discount of each count 0..most from ``of[r]``, the number of kinds seen
    r times; counts without a usable estimate are not discounted."""
    d = np.ones(most + 1)
    if of[1] > 0:
        common = (most + 1) * of[most + 1] / of[1]
        if common < 1:
            for r in range(1, most + 1):
                if of[r] > 0:
                    x = ((r + 1) * of[r + 1] / (r * of[r]) - common) / (1 - common)
                    if 0 < x < 1:
                        d[r] = x
    return d


class Unigrams:
    """Good-Turing unigram probabilities; what the discounts free is the unknown word's."""

    def __init__(self, tokens: int, of: np.ndarray, most: int):
        self.discounts = good_turing(of, most)
        r = np.arange(most + 1)
        freed = float(((1 - self.discounts) * r * of[:most + 1]).sum())
        self.total = float(tokens) if freed > 0 else tokens + 1.0
        self.unknown = freed / self.total if freed > 0 else 1 / self.total
        self.most = most

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        p = counts * self.discounts[np.minimum(counts, self.most + 0) * (counts <= self.most)] / self.total
        return np.where(counts > 0, p, self.unknown)


def _tokens(docs: DataFrame, parts: int, block_tokens: int) -> DataFrame:
    """A row 'doc' a block (its documents' words as numbers inside the block)
    and rows 'words' (the block's words of one part, with training counts)."""
    def look(batches):
        task, number = TaskContext.get().partitionId(), 0
        fresh = lambda: (Ids({_BEGIN: 0}), [], [], [])
        ids, doc_ids, held, texts_ = fresh()
        size = 0

        def flush():
            block, words = (task << 32) | number, list(ids)
            part = np.fromiter((_word_part(w, parts) for w in words), np.int64, len(words))
            order = np.argsort(part, kind="stable")
            place = np.empty(len(words), np.uint32)
            place[order] = np.arange(len(words), dtype=np.uint32)
            sizes = np.array([len(a) for a in texts_], np.int64)
            flat = place[np.concatenate(texts_)]
            train = np.repeat(~np.array(held, bool), sizes)
            counts = np.bincount(flat[train], minlength=len(words)).astype(np.uint32)
            flags = np.array([h + 2 * (d is None) for h, d in zip(held, doc_ids)], np.uint8)
            rows = [_row("doc", block, None, pack(flat), pack(sizes), pack(np.array([d or 0 for d in doc_ids], np.int64)), pack(flags))]
            edge = np.searchsorted(part[order], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(edge)).tolist():
                own = order[edge[p]:edge[p + 1]]
                rows.append(_row("words", block, p, _squeeze(b"\n".join([words[i] for i in own])), pack(counts[edge[p]:edge[p + 1]])))
            return _rows(rows)

        for batch in batches:
            batch_ids, texts, out = batch.column(0).to_pylist(), binary_texts(batch.column(1)), batch.column(2).to_pylist()
            for a, z in chunks(texts, 1_000_000):
                for i in range(a, z):
                    w = texts[i].lower().split() if texts[i] else []
                    texts_.append(np.fromiter(map(ids.__getitem__, w), np.uint32, len(w)))
                    doc_ids.append(batch_ids[i])
                    held.append(out[i])
                    size += len(w) + 1
                if size >= block_tokens:
                    yield flush()
                    ids, doc_ids, held, texts_ = fresh()
                    size, number = 0, number + 1
        if held:
            yield flush()

    return docs.mapInArrow(look, _ROWS)


def _vocabulary(parts: int):
    """One part of the vocabulary: numbers its training words and answers the blocks."""
    def merge(table: pa.Table) -> pa.Table:
        ids, asked, p = Ids(), [], table.column("part")[0].as_py()
        for data in table.column("data").to_pylist():
            words = _expand(data).split(b"\n")
            asked.append(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
        total = np.zeros(len(ids), np.int64)
        for a, c in zip(asked, table.column("counts").to_pylist()):
            total[a] += unpack(c, np.uint32)
        words = list(ids)
        # Frequent words first: their numbers are small and pack well.
        learned = sorted((i for i in range(len(words)) if total[i] > 0), key=lambda i: (-total[i], words[i]))
        number = np.full(len(words), UNKNOWN, np.uint32)
        number[learned] = FIRST + p + parts * np.arange(len(learned), dtype=np.uint32)
        if _BEGIN in ids:
            number[ids[_BEGIN]] = START
        rows = [_row("model", None, p, _squeeze(b"\n".join([words[i] for i in learned])), pack(total[learned]))]
        rows += [_row("answer", b, p, pack(number[a]), pack(total[a])) for b, a in zip(table.column("block").to_pylist(), asked)]
        return pa.Table.from_batches([_rows(rows)])
    return merge


def _count_of_counts(model: DataFrame, most: int) -> tuple[int, int, np.ndarray, int]:
    """(kinds, sum, kinds seen r times for r = 0 .. most + 1, kinds of the largest part) over the model's count arrays."""
    def look(batches):
        for batch in batches:
            for c in batch.column(0).to_pylist():
                c = unpack(c, np.int64)
                of = np.bincount(np.minimum(c, most + 2), minlength=most + 3)
                r = [-2, -1, *range(most + 2)]
                yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()), pa.array([len(c), int(c.sum()), *of[:most + 2].tolist()], pa.int64())], names=["r", "n"])
    found = model.select("counts").mapInArrow(look, "r long, n long").groupBy("r").agg(F.sum("n").alias("n"), F.max("n").alias("most")).collect()
    rows = {r["r"]: r["n"] for r in found}
    largest = max([0, *(r["most"] for r in found if r["r"] == -2)])
    return rows.get(-2, 0), rows.get(-1, 0), np.array([rows.get(r, 0) for r in range(most + 2)], float), largest


class _Block:
    """The documents of one block with model numbers, and its distinct bigrams."""

    def __init__(self, table: pa.Table, parts: int, train_docs: int, width: int):
        kinds, part = table.column("kind").to_pylist(), table.column("part").to_pylist()
        data, counts, extra, flags = (table.column(c).to_pylist() for c in ("data", "counts", "extra", "flags"))
        by_part = lambda kind: sorted((i for i, k in enumerate(kinds) if k == kind), key=part.__getitem__)
        joined = lambda column, kind, dtype: np.concatenate([np.empty(0, dtype)] + [unpack(column[i], dtype) for i in by_part(kind)])
        number, seen = joined(data, "answer", np.uint32), joined(counts, "answer", np.int64)
        doc = kinds.index("doc")
        local, sizes = unpack(data[doc], np.uint32), unpack(counts[doc], np.int64)
        ids, flag = unpack(extra[doc], np.int64).tolist(), unpack(flags[doc], np.uint8)
        self.held_out, self.doc_id = (flag & 1).astype(bool), [None if f & 2 else i for i, f in zip(ids, flag.tolist())]
        self.size = sizes + 1
        self.doc = np.repeat(np.arange(len(sizes)), self.size)
        last = np.cumsum(self.size) - 1
        inside = np.ones(len(self.doc), bool)
        inside[last] = False
        end = END if train_docs else UNKNOWN
        self.word, self.count = np.full(len(inside), end, np.uint64), np.full(len(inside), train_docs, np.int64)
        self.word[inside], self.count[inside] = number[local], seen[local]
        # What stands before each token, as a place among the block's words.
        begin = int(np.flatnonzero(number == START)[0])
        self.place = np.full(len(inside), begin, np.int64)
        after = np.flatnonzero(inside) + 1
        self.place[after] = local
        self.before = number[self.place].astype(np.uint64)
        if not train_docs:
            self.before[:] = UNKNOWN
        self.known = np.flatnonzero((self.before != UNKNOWN) & (self.word != UNKNOWN))
        self.keys, first, self.key_at = np.unique(self.before[self.known] * np.uint64(width) + self.word[self.known], return_index=True, return_inverse=True)
        self.key_count = self.count[self.known][first]
        self.key_part = (mix64(self.keys) % np.uint64(parts)).astype(np.int64)
        self.key_order = np.argsort(self.key_part, kind="stable")
        self.pairs = joined(data, "bigrams", np.int64)
        self.weight, self.divisor = joined(data, "backoff", np.float64), joined(counts, "backoff", np.int64)


def _ask(parts: int, train_docs: int, width: int):
    """A block's questions: its distinct bigrams, with training counts and the last word's count."""
    def ask(table: pa.Table) -> pa.Table:
        b, block = _Block(table, parts, train_docs, width), table.column("block")[0].as_py()
        counts = np.bincount(b.key_at, ~b.held_out[b.doc[b.known]], len(b.keys)).astype(np.uint32)
        rows, edge = [], np.searchsorted(b.key_part[b.key_order], np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(edge)).tolist():
            own = b.key_order[edge[p]:edge[p + 1]]
            rows.append(_row("bigrams", block, p, pack_sorted(b.keys[own]), pack(counts[own]), pack(b.key_count[own])))
        return pa.Table.from_batches([_rows(rows)])
    return ask


def _count_bigrams(table: pa.Table) -> pa.Table:
    """One part of the bigram table: adds the blocks' counts up and answers them."""
    p, asked = table.column("part")[0].as_py(), [unpack_sorted(d) for d in table.column("data").to_pylist()]
    keys, first, at = np.unique(np.concatenate(asked), return_index=True, return_inverse=True)
    total = np.bincount(at, np.concatenate([unpack(c, np.uint32) for c in table.column("counts").to_pylist()]), len(keys)).astype(np.int64)
    last = np.concatenate([unpack(c, np.int64) for c in table.column("extra").to_pylist()])[first]
    seen = total > 0
    rows, start = [_row("model", None, p, pack_sorted(keys[seen]), pack(total[seen]), pack(last[seen]))], 0
    for block, a in zip(table.column("block").to_pylist(), asked):
        rows.append(_row("bigrams", block, p, pack(total[at[start:start + len(a)]])))
        start += len(a)
    return pa.Table.from_batches([_rows(rows)])


def _masses(model: DataFrame, unigram: Unigrams, discounts: np.ndarray, most: int, parts: int, width: int) -> DataFrame:
    """For each part of the bigram table and history: what its discounts free,
    the unigram mass of its seen words, and its count."""
    def look(batches):
        for batch in batches:
            for data, counts, last in zip(*(c.to_pylist() for c in batch.columns)):
                keys, c = unpack_sorted(data), unpack(counts, np.int64)
                if not len(keys):
                    continue
                h = keys // np.uint64(width)
                start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                freed = np.add.reduceat(np.where(c <= most, (1 - discounts[np.minimum(c, most)]) * c, 0.0), start)
                mass = np.add.reduceat(unigram(unpack(last, np.int64)), start)
                size = np.add.reduceat(c, start)
                h = h[start]
                part = _history_part(h, parts)
                rows = []
                for p in np.unique(part).tolist():
                    own = part == p
                    rows.append(_row("mass", None, p, pack_sorted(h[own]), pack(size[own]), pack(np.concatenate([freed[own], mass[own]]))))
                yield _rows(rows)
    return model.select("data", "counts", "extra").mapInArrow(look, _ROWS)


def _backoff(table: pa.Table) -> pa.Table:
    """One part of the backoff table, and its answers: the weight that makes a
    history's probabilities sum to one, and what its counts are divided by."""
    p, kinds = table.column("part")[0].as_py(), table.column("kind").to_pylist()
    data, counts, extra = (table.column(c).to_pylist() for c in ("data", "counts", "extra"))
    mass = [i for i, k in enumerate(kinds) if k == "mass"]
    h, at = np.unique(np.concatenate([np.empty(0, np.uint64)] + [unpack_sorted(data[i]) for i in mass]), return_inverse=True)
    pairs = [unpack(extra[i], np.float64).reshape(2, -1) for i in mass]
    pairs = np.concatenate([np.empty((2, 0)), *pairs], axis=1)
    size = np.bincount(at, np.concatenate([np.empty(0, np.int64)] + [unpack(counts[i], np.int64) for i in mass]), len(h))
    freed, seen = np.bincount(at, pairs[0], len(h)), np.bincount(at, pairs[1], len(h))
    # A history whose counts are all too large to be discounted gives up one count's share instead.
    spare = freed > 0
    divisor = np.where(spare, size, size + 1).astype(np.int64)
    weight = np.where(spare, freed, 1.0) / divisor / np.maximum(1 - seen, 1e-300)
    rows = [_row("model", None, p, pack_sorted(h), pack(divisor), pack(weight))]
    for i, k in enumerate(kinds):
        if k == "answer":  # the words of a block's part, in its order
            asked = unpack(data[i], np.uint32).astype(np.uint64)
            w, d = np.ones(len(asked)), np.ones(len(asked), np.int64)
            if len(h):
                j = np.minimum(np.searchsorted(h, asked), len(h) - 1)
                found = h[j] == asked
                w, d = np.where(found, weight[j], w), np.where(found, divisor[j], d)
            rows.append(_row("backoff", table.column("block")[i].as_py(), p, pack(w), pack(d)))
    return pa.Table.from_batches([_rows(rows)])


_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                  ("base_score", pa.float64()), ("score", pa.float64())])


def _evaluate(parts: int, train_docs: int, width: int, tokens: int, kinds: int, unigram: Unigrams, discounts: np.ndarray, most: int):
    def score(table: pa.Table) -> pa.Table:
        b = _Block(table, parts, train_docs, width)
        n = len(b.doc_id)
        found = np.empty(len(b.keys), np.int64)
        found[b.key_order] = b.pairs
        pair = np.zeros(len(b.word), np.int64)
        pair[b.known] = found[b.key_at]
        weight, divisor = b.weight[b.place], b.divisor[b.place]
        count = b.count
        single = unigram(count)
        seen = pair * np.where(pair <= most, discounts[np.minimum(pair, most)], 1.0) / divisor
        p = np.where(pair > 0, seen, np.where(b.before == UNKNOWN, single, weight * single))
        base = np.log10((count + 0.1) / (tokens + 0.1 * (kinds + 1)))
        cols = [b.doc_id, b.held_out, b.size, np.bincount(b.doc, count > 0, n).astype(np.int64), np.full(n, tokens),
                np.bincount(b.doc, base, n), np.bincount(b.doc, np.log10(np.maximum(p, 1e-300)), n)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _OUT)], schema=_OUT)
    return score


def katz_scores(docs: DataFrame, held_out, most: int = 5, block_tokens: int = 1_200_000, part_keys: int = 3_000_000) -> DataFrame:
    """(doc_id, text) -> doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score for every document.

    The model learns from the documents where the column ``held_out`` is
    false. Tokens: words at ASCII white space, A-Z lower-cased, then one end.
    Counts up to ``most`` are discounted. score is the log10 probability of
    the text with its end, an unseen word counting as one unknown kind; the
    probabilities after any history sum to one over the learned words, the
    end and the unknown word. Null and empty texts are the end alone; repeated
    rows count each; with no document to learn from every token has
    probability one. The tables (unigrams, bigrams, backoff weights) are
    written by part in the shared folder, parts holding about ``part_keys``
    keys of the input's size.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(max(8, -(-size // (6 * part_keys))))
    docs = docs.select("doc_id", "text", held_out.alias("held_out"))
    train_docs = docs.filter("not held_out").count()
    kept = written(_tokens(docs, parts, block_tokens), "katz-tokens", "kind")
    text = kept.filter("kind = 'doc'")
    words = written(kept.filter("kind = 'words'").groupBy("part").applyInArrow(_vocabulary(parts), _ROWS), "katz-unigrams", "kind")
    kinds, tokens, of, most_in_part = _count_of_counts(words.filter("kind = 'model'"), most)
    width = FIRST + parts * (most_in_part + 1)  # above every word's number
    if train_docs:  # the end is a kind of token too
        kinds, tokens = kinds + 1, tokens + train_docs
        if train_docs <= most + 1:
            of[train_docs] += 1
    unigram = Unigrams(tokens, of, most)
    numbers = words.filter("kind = 'answer'")
    known = text.unionByName(numbers)
    asked = known.groupBy("block").applyInArrow(_ask(parts, train_docs, width), _ROWS)
    pairs = written(asked.groupBy("part").applyInArrow(_count_bigrams, _ROWS), "katz-bigrams", "kind")
    model = pairs.filter("kind = 'model'")
    discounts = good_turing(_count_of_counts(model, most)[2], most)
    masses = _masses(model, unigram, discounts, most, parts, width)
    backoff = written(masses.unionByName(numbers).groupBy("part").applyInArrow(_backoff, _ROWS), "katz-backoff", "kind")
    answers = known.unionByName(pairs.filter("kind = 'bigrams'")).unionByName(backoff.filter("kind = 'backoff'"))
    return answers.groupBy("block").applyInArrow(
        _evaluate(parts, train_docs, width, tokens, kinds, unigram, discounts, most),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op3(spark, sf_dir) -> DataFrame:
    from ..tables import read_table
    return katz_scores(read_table(spark, sf_dir, "documents"), crc_bucket_col("doc_id", 10) == 0)
