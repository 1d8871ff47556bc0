"""Quality rules with suffix-array repetition.

The suffix array of a document's symbols gives the longest common prefix of
neighbouring suffixes. The intervals of that array whose prefix is long
enough are the repeated substrings; the left-maximal ones are the maximal
repeats, and the union of their spans is the repeated part of the document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import WHITE, Ids, binary_texts, chunks

# The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"


class SuffixRanks:
    """Suffix order by prefix doubling, over several documents at once.

    ``levels[k]`` ranks every position by its window of 2 ** k symbols, cut at
    the end of its document; the rank is the place in the suffix array at
    which the positions with that window begin. Documents never share a
    window. Each doubling sorts only the positions that are not alone yet.
    """

    def __init__(self, symbols: np.ndarray, doc: np.ndarray):
        n = self.n = len(symbols)
        self.end = np.searchsorted(doc, doc, side="right")
        key = doc * (int(symbols.max()) + 1) + symbols if n else np.empty(0, np.int64)
        self.levels, self.shared = [], []
        self._sort(np.arange(n), np.zeros(n, np.int64), key)

    def _sort(self, at: np.ndarray, rank: np.ndarray, key: np.ndarray) -> None:
        """Split the groups of equal rank of the positions ``at`` by ``key`` (rank first)."""
        order = np.argsort(key)
        k, at = key[order], at[order]
        old, i = rank[at], np.arange(len(at))
        changes = lambda x: np.concatenate([np.ones(min(1, len(x)), bool), x[1:] != x[:-1]])
        new = changes(k)
        first = np.maximum.accumulate(np.where(new, i, 0))
        begin = np.maximum.accumulate(np.where(changes(old), i, 0))
        rank[at] = old + first - begin
        alone = new & np.concatenate([new[1:], np.ones(min(1, len(at)), bool)])
        self.levels.append(rank)
        self.shared.append(np.sort(at[~alone]))

    def _double(self) -> None:
        at, rank, step = self.shared[-1], self.levels[-1].copy(), 1 << (len(self.levels) - 1)
        after = np.where(at + step < self.end[at], rank[np.minimum(at + step, self.n - 1)], -1)
        self._sort(at, rank, rank[at] * (self.n + 1) + after + 1)

    def reach(self, k: int) -> None:
        """Have level k, unless all positions are alone before."""
        while len(self.levels) <= k and len(self.shared[-1]):
            self._double()

    def finish(self) -> None:
        while len(self.shared[-1]):
            self._double()


def window_repeats(ranks: SuffixRanks, width: int) -> np.ndarray:
    """Positions whose window of ``width`` symbols occurs again in the document."""
    k = width.bit_length() - 1
    rest = width - (1 << k)
    ranks.reach(k)
    if len(ranks.shared) <= k:
        return np.empty(0, np.int64)
    at, level = ranks.shared[k], ranks.levels[k]
    at = at[at + width <= ranks.end[at]]
    key = level[at] * (ranks.n + 1) + level[np.minimum(at + rest, ranks.n - 1)]
    _, where, count = np.unique(key, return_inverse=True, return_counts=True)
    return at[count[where] > 1]


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Positions inside the union of the spans [start, end)."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def maximal_repeats(ranks: SuffixRanks, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of every occurrence of a maximal repeat of ``least``
    symbols or more: the longest repeated prefix of each suffix that cannot
    be lengthened to the left.

    A suffix's longest repeated prefix is the larger of its common prefixes
    with its two neighbours in the suffix array, read off the doubling levels,
    longest window first. Suffixes alone with their window of 2 ** k <= least
    symbols have none that long and are left out.
    """
    ranks.finish()
    k = least.bit_length() - 1
    at = ranks.shared[k] if k < len(ranks.shared) else np.empty(0, np.int64)
    sa = at[np.argsort(ranks.levels[-1][at])]
    if len(sa) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = sa[:-1].copy(), sa[1:].copy()
    end_a, end_b = ranks.end[a], ranks.end[b]
    lcp = np.zeros(len(a), np.int64)
    for j in range(len(ranks.levels) - 1, -1, -1):
        level = ranks.levels[j]
        same = (a < end_a) & (b < end_b) & (level[np.minimum(a, ranks.n - 1)] == level[np.minimum(b, ranks.n - 1)])
        a[same] += 1 << j
        b[same] += 1 << j
        lcp[same] += 1 << j
    longest = np.zeros(ranks.n, np.int64)
    both = np.zeros(len(sa), np.int64)
    both[1:] = lcp
    both[:-1] = np.maximum(both[:-1], lcp)
    longest[sa] = both
    start = np.flatnonzero(longest >= least)
    before = np.where(start > 0, longest[start - 1], 0)
    left = before <= longest[start]  # else the repeat one to the left holds this one
    return start[left], longest[start[left]]


def short_repeats(number: np.ndarray, counts: np.ndarray, piece_words: int) -> np.ndarray:
    """Words inside a maximal repeat of two words or more of their piece, or equal to a neighbour.

    A document is cut evenly into pieces of at most ``piece_words`` words, so
    that the share of such words does not grow with its length. The union of
    all maximal repeats of two words or more is that of the two-word windows
    that occur again, so the first levels of the suffix order are enough.
    """
    n = len(number)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    pieces = -(-counts // piece_words)
    piece = np.repeat(np.cumsum(pieces) - pieces, counts) + (np.arange(n) - first) * np.repeat(pieces, counts) // np.repeat(counts, counts)
    at = window_repeats(SuffixRanks(number, piece), 2)
    same = np.flatnonzero((number[1:] == number[:-1]) & (first[1:] == first[:-1]))
    at = np.concatenate([at, same])
    return covered(at, at + 2, n)


def analyse(texts: list[bytes], least: int, long_word: int, piece_words: int = 500) -> dict[str, np.ndarray]:
    """Figures of some non-null texts, by text."""
    n = len(texts)
    ids, words, counts, lines, symbols = Ids(), [], [], [], []
    for t in texts:
        w = t.split()
        words.append(w)
        counts.append(len(w))
        symbols.append(len(t) - len(t.translate(None, SYMBOLS)))
        seen, dup = set(), 0
        if b"\n" in t:
            for line in t.split(b"\n"):
                if line in seen:
                    dup += 1
                elif line.strip(WHITE):
                    seen.add(line)
        lines.append(dup)
    counts = np.array(counts, np.int64)
    flat = [w for ws in words for w in ws]
    number = np.fromiter(map(ids.__getitem__, flat), np.int64, len(flat))
    doc = np.repeat(np.arange(n), counts)
    ranks = SuffixRanks(number, doc)
    at = window_repeats(ranks, 5)
    repeated = covered(at, at + 5, len(flat))
    # Symbols of the suffix array: words, or single characters of overlong words.
    weight = np.array([len(w) for w in ids], np.int64)
    total = np.bincount(doc, weight[number], n) if len(number) else np.zeros(n)
    short = np.bincount(doc, weight[number] * short_repeats(number, counts, piece_words), n) / np.maximum(total, 1) if len(number) else np.zeros(n)
    if len(weight) and weight.max() > long_word:
        parts = [[w] if len(w) <= long_word else [c.encode("utf-8", "surrogateescape") for c in w.decode("utf-8", "surrogateescape")] for w in flat]
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = [p for ps in parts for p in ps]
        number = np.fromiter(map(ids.__getitem__, flat), np.int64, len(flat))
        doc = np.repeat(doc, size)
        ranks = SuffixRanks(number, doc)
        weight = np.array([len(w) for w in ids], np.int64)
    start, length = maximal_repeats(ranks, least)
    weights = weight[number] if len(number) else np.zeros(0, np.int64)
    inside = covered(start, start + length, len(flat))
    share = np.bincount(doc, weights * inside, n) / np.maximum(total, 1)
    longest = np.zeros(n, np.int64)
    if len(start):
        upto = np.concatenate([[0], np.cumsum(weights)])
        np.maximum.at(longest, doc[start], upto[start + length] - upto[start])
    return {"n_words": counts, "n_symbols": np.array(symbols, np.int64), "n_dup_lines": np.array(lines, np.int64),
            "n_repeat_words": np.bincount(np.repeat(np.arange(n), counts), repeated, n).astype(np.int64),
            "covered": share, "longest": longest, "short": short}


def quality_rules(docs: DataFrame, least: int = 8, most_covered: float = 0.2, most_longest: int = 500, long_word: int = 64,
                  min_words: int = 10, most_repeat_percent: int = 20, most_short: float = 0.5, piece_words: int = 500) -> DataFrame:
    """(doc_id, text) -> doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, repeat_covered, longest_repeat, short_covered.

    The base rule fails documents of fewer than ``min_words`` words or with
    more than ``most_repeat_percent`` of their words in repeated 5-word
    windows. The suffix array's symbols are words (single characters of words
    over ``long_word`` bytes, for scripts without spaces). It rejects a
    document if maximal repeats of ``least`` symbols or more cover more than
    ``most_covered`` of its word bytes, or the longest has more than
    ``most_longest`` bytes. The base rule and these limits see no repeat of
    two to four words, so it also rejects a document if repeats of two words
    or more within pieces of ``piece_words`` words, and words that follow
    themselves, cover more than ``most_short`` of its word bytes; here an
    overlong word is one symbol. Null texts count as empty, and empty texts fail
    the base rule. Whole texts; repeated rows give repeated rows.
    """
    long, real, flag = pa.int64(), pa.float64(), pa.bool_()
    schema = pa.schema([("doc_id", long), ("n_words", long), ("word_chars", long), ("n_symbols", long), ("n_dup_lines", long),
                        ("n_repeat_words", long), ("base_failed", flag), ("kept", flag), ("repeat_covered", real), ("longest_repeat", long),
                        ("short_covered", real)])

    def rules(batches):
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            texts = [t or b"" for t in binary_texts(column)]
            points = pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            white = np.array([len(t) - len(t.translate(None, WHITE)) for t in texts], np.int64)
            for a, z in chunks(texts, 3_000_000):
                x = analyse(texts[a:z], least, long_word, piece_words)
                failed = (x["n_words"] < min_words) | (100 * x["n_repeat_words"] > most_repeat_percent * x["n_words"])
                kept = ~failed & (x["covered"] <= most_covered) & (x["longest"] <= most_longest) & (x["short"] <= most_short)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, z - a), pa.array(x["n_words"]), pa.array(points[a:z] - white[a:z]), pa.array(x["n_symbols"]),
                     pa.array(x["n_dup_lines"]), pa.array(x["n_repeat_words"]), pa.array(failed), pa.array(kept),
                     pa.array(x["covered"]), pa.array(x["longest"]), pa.array(x["short"])], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(
        rules, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
               "base_failed boolean, kept boolean, repeat_covered double, longest_repeat long, short_covered double")


def op2(spark, sf_dir) -> DataFrame:
    from ..tables import read_table
    return quality_rules(read_table(spark, sf_dir, "documents"))
