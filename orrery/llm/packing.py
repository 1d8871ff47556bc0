"""Packing token sequences: first-fit decreasing with a tournament tree of
bin capacities, run independently in randomised groups of pieces."""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_texts, portions, written

DOC_END = 1


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


# A run of Latin letters, all of one code point with and without
# normalisation, and ASCII punctuation after it (without the apostrophe, which
# may begin a run) that forms one run of its own.
_ENDS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([" + re.escape(_ENDS.decode()) + "]*)")


def lowered(text: bytes) -> bytes:
    """A-Z in lower case where the tokenizer would do the same: it looks for
    special tokens before, and joins letters with marks (U+0300 to U+037F) in a
    way that depends on their case."""
    return text if b"\xcc" in text or b"\xcd" in text or b"<|" in text else text.lower()


class WordTokens(dict):
    """Word (no ASCII white space in it) -> little-endian unsigned 32-bit ids.

    The tokenizer drops white space, so a text's ids are its words' ids in
    turn. Plain words go straight to the tokenizer's model, lower-cased and
    in its byte alphabet; all others through the whole tokenizer. Remembers
    ``most`` words at most.
    """

    def __init__(self, path: str, most: int = 200_000):
        from tokenizers import Tokenizer
        self.tokenizer, self.most, self.plain, self.tails = Tokenizer.from_file(path), most, {}, {}
        self.tokenize = self.tokenizer.model.tokenize
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = dict(zip(shown, shown)) | {b: 256 + i for i, b in enumerate(hidden)}

    def whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.most:
            self.clear()
            self.plain.clear()
        head = word.rstrip(_ENDS)
        if head.isalpha():  # ASCII letters only, which stand for themselves in the byte alphabet
            head, tail = head.lower().decode(), word[len(head):]
        else:
            text = word.decode("utf-8", "replace")
            m = _PLAIN.fullmatch(text)
            if not m:
                self[word] = ids = self.whole(text)
                return ids
            head, tail = m[1].lower().encode().decode("latin-1").translate(self.alphabet), m[2].encode()
        ids = self.plain.get(head)
        if ids is None:
            found = [t.id for t in self.tokenize(head)]
            ids = self.plain[head] = struct.pack(f"<{len(found)}I", *found)
        if tail:
            if tail not in self.tails:
                if len(self.tails) > 10_000:
                    self.tails.clear()
                self.tails[tail] = self.whole(tail.decode())
            ids += self.tails[tail]
        self[word] = ids
        return ids


def pieces_of(docs: DataFrame, path: str, length: int = 2048) -> DataFrame:
    """(doc_id, text) -> pieces of at most ``length`` ids: doc_id, start,
    length, ids_crc32, doc_tokens. Every document ends with id 1."""
    end = np.array([DOC_END], "<u4").tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])

    def tokenise(batches):
        cache = WordTokens(path)
        for batch in portions(batches, 1):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), binary_texts(batch.column(1))):
                seq = b"".join(map(cache.__getitem__, lowered(text).split() if text else ())) + end
                n = len(seq) // 4
                for s in range(0, n, length):
                    part = seq[4 * s:4 * (s + length)]
                    rows.append((doc, s, len(part) // 4, zlib.crc32(part), n))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(tokenise, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item: longest first, each into the first bin it
    fits, found from the root of a tournament tree over the bins' free room."""
    n = len(lengths)
    leaves = 1 << max(0, int(n - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[i]), 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - tree[node]
        tree[node] -= need
        while node > 1:
            node >>= 1
            left, right = tree[2 * node], tree[2 * node + 1]
            best = left if left > right else right
            if tree[node] == best:
                break
            tree[node] = best
    return bins, offsets


def pack(pieces: DataFrame, length: int = 2048, group_pieces: int = 4096, seed: int = 5) -> DataFrame:
    """Adds sequence_id and offset to pieces (with a ``length`` column).

    The pieces are dealt at random into groups of about ``group_pieces``; each
    group is packed alone, so no task holds more than a group, whatever ids
    repeat. ``pieces`` must be a written table: the random deal is by its
    partitions and rows and so the same when a task runs again.
    """
    n_groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("group", F.floor(F.rand(seed) * n_groups).cast("long"))

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        bins, offsets = first_fit_decreasing(part["length"].to_numpy(), length)
        return part.assign(sequence_id=part["group"].to_numpy() * (1 << 20) + bins, offset=offsets)

    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema]
    return dealt.groupBy("group").applyInPandas(fit, ", ".join(names) + ", sequence_id long, offset long").drop("group")


def pack_documents(docs: DataFrame, path: str | None = None, length: int = 2048, group_pieces: int = 4096) -> DataFrame:
    """(doc_id, text) -> packed pieces: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset.

    Null and empty texts are one piece with the end id alone; long documents
    are cut into pieces of ``length`` and a rest; repeated rows are packed
    each; an empty table gives no rows.
    """
    return pack(written(pieces_of(docs, path or tokenizer_path(), length), "pieces"), length, group_pieces)


def op5(spark, sf_dir) -> DataFrame:
    from ..tables import read_table
    return pack_documents(read_table(spark, sf_dir, "documents"))
