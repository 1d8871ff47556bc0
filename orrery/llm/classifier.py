"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document.
Expectation-maximisation over the vote patterns estimates what each labeller
is worth; the posterior labels train a hashed linear scorer, whose verdict
counts. Two targets are learned this way: low quality, from heuristics of
form, and toxicity, from lexicons learned on different folds of the hand
labels. Hand labels vote too where there are any.
"""

from __future__ import annotations

import warnings
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, Hashes, binary_texts, crc_bucket, mix64, portions, written

_BITS = 20
_SYMBOLS = b"#*$%&|<>"
_ENDS = b".,;:!?"
_UPPER = bytes(range(65, 91))
GOOD, NONE, BAD = 2, 1, 0

# The labellers of form: name, figure and the value above which they vote bad; else they do not vote.
LABELLERS = (
    ("short", "inverse_words", 1 / 10),
    ("symbols", "symbols_a_word", 0.08),
    ("repeated_neighbours", "repeated_neighbours", 0.08),
    ("one_word", "most_common_share", 0.30),
    ("duplicate_lines", "duplicate_line_share", 0.30),
    ("odd_length", "odd_word_length", 2.5),
    ("few_letters", "non_letter_share", 0.20),
    ("shouting", "upper_share", 0.30),
    ("no_sentences", "unpunctuated", 0.995),
)


def figures(text: bytes | None) -> dict[str, float]:
    """What the labellers of form look at; whole text."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return {"inverse_words": 1.0, "symbols_a_word": 0.0, "repeated_neighbours": 0.0, "most_common_share": 0.0,
                "duplicate_line_share": 0.0, "odd_word_length": 0.0, "non_letter_share": 0.0, "upper_share": 0.0, "unpunctuated": 0.99}
    size = len(text) - (len(text) - len(text.translate(None, WHITE)))
    lines = [x for x in text.split(b"\n") if x.strip(WHITE)]
    bare = text.translate(None, WHITE + b"0123456789!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    mean = size / n
    ended = sum(w[-1] in _ENDS for w in words)
    return {"inverse_words": 1 / n,
            "symbols_a_word": (len(text) - len(text.translate(None, _SYMBOLS))) / n,
            "repeated_neighbours": sum(map(eq, words, words[1:])) / n,
            "most_common_share": max(Counter(words).values()) / n if n >= 10 else 0.2,
            "duplicate_line_share": 1 - len(set(lines)) / len(lines),
            "odd_word_length": max(mean / 6, 6 / max(mean, 0.1)),
            "non_letter_share": 1 - len(bare) / size,
            "upper_share": (len(bare) - len(bare.translate(None, _UPPER))) / max(len(bare), 1),
            "unpunctuated": 1 - ended / n if n >= 30 else 0.99}


def votes(text: bytes | None) -> int:
    """The labellers' votes as digits to base 3, the first labeller first."""
    f = figures(text)
    return sum((BAD if f[name] > bad else NONE) * 3 ** j for j, (_, name, bad) in enumerate(LABELLERS))


def digits(codes: np.ndarray, n: int) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(n)[None, :] % 3


def features(text: bytes | None, code: int, hashes: Hashes) -> np.ndarray:
    """Distinct hashed features: lower-cased words without punctuation at the
    end, their first four bytes (a stem), and the votes."""
    words = {w.rstrip(_ENDS) for w in set(text.lower().split())} if text else set()
    mask = (1 << _BITS) - 1
    found = {hashes[w] & mask for w in words} | {hashes[w] & mask for w in {b"\0" + w[:4] for w in words}}
    n = len(LABELLERS)
    return np.array(sorted(found) + [mask + 1 + 3 * j + code // 3 ** j % 3 for j in range(n)], np.uint32)


def _size() -> int:
    return (1 << _BITS) + 3 * len(LABELLERS)


def estimate(patterns: np.ndarray, weights: np.ndarray, start: np.ndarray, prior_bad: float = 0.15, rounds: int = 200) -> np.ndarray:
    """Posterior of bad for every vote pattern (rows of votes 0, 1, 2).

    Expectation-maximisation with one table P(vote | class) a labeller.
    ``start`` (2 classes, labellers, 3 votes) is where it begins, and stays as
    a prior of weight one in fifty, so labellers better than chance keep the
    classes apart.
    """
    seen = np.stack([patterns == v for v in range(3)], 2).astype(float)  # pattern, labeller, vote
    table, share = start.copy(), prior_bad
    held = 0.02 * weights.sum() + 1
    post = np.full(len(patterns), prior_bad)
    for _ in range(rounds):
        log = np.einsum("pjv,cjv->pc", seen, np.log(np.maximum(table, 1e-9))) + np.log([share, 1 - share])
        new = 1 / (1 + np.exp(np.clip(log[:, 1] - log[:, 0], -60, 60)))
        for c, r in ((0, new), (1, 1 - new)):
            w = np.einsum("p,pjv->jv", weights * r, seen) + held * start[c]
            table[c] = w / w.sum(axis=1, keepdims=True)
        share = float(np.clip(((weights * new).sum() + held * prior_bad) / (weights.sum() + held), 0.005, 0.6))
        done = np.abs(new - post).max(initial=0) < 1e-6
        post = new
        if done:
            break
    return post


def start_table(votes_bad: float, wrongly: float, none_else: bool, cover: float = 1.0) -> np.ndarray:
    """(2, 3): P(vote | bad), P(vote | good) of a labeller that votes bad on a
    share ``votes_bad`` of bad and ``wrongly`` of good documents and else not
    at all, or good; ``cover``: the share on which it can vote."""
    t = np.zeros((2, 3))
    t[:, BAD] = np.array([votes_bad, wrongly]) * cover
    t[:, NONE if none_else else GOOD] = cover - t[:, BAD]
    t[:, NONE] += 1 - cover
    return t


def train(rows: list[np.ndarray], target: np.ndarray, least: int = 10, penalty: float = 3e-4, rounds: int = 150) -> tuple[np.ndarray, float]:
    """Logistic weights by accelerated proximal gradient with an L1 penalty;
    features of fewer than ``least`` rows get none."""
    n = len(rows)
    doc = np.repeat(np.arange(n, dtype=np.int32), [len(r) for r in rows])
    flat = np.concatenate(rows).astype(np.int32) if n else np.empty(0, np.int32)
    frequent = np.bincount(flat, minlength=_size()) >= min(least, max(1, n // 20))
    doc, flat = doc[frequent[flat]], flat[frequent[flat]]
    used = np.flatnonzero(frequent)
    flat, size = np.searchsorted(used, flat), len(used)
    weight = np.where(target > 0.5, 0.5 / max(target.mean(), 1e-3), 0.5 / max(1 - target.mean(), 1e-3)) if n else target
    weight = np.sqrt(np.minimum(weight, 20.0))
    df = np.bincount(flat, minlength=size) / max(n, 1)
    scale = 1 / np.sqrt(np.maximum(df * (1 - df), 1e-3) + 1e-3)  # common words move little, rare ones as far as all
    scale = np.minimum(scale, 12.0)
    # Step size: one over the curvature bound, by power iteration.
    u = np.ones(size)
    curve = 1.0
    for _ in range(12 if n else 0):
        z = np.bincount(doc, (u * scale)[flat], n) + 1.0
        u = np.bincount(flat, (weight * z)[doc], size) * scale / (4 * n)
        curve = max(float(np.sqrt((u * u).sum())), 1e-9)
        u /= curve
    step = 0.9 / (curve + float(weight.mean() if n else 0) / 4)
    w, b, v, vb, t = np.zeros(size), 0.0, np.zeros(size), 0.0, 1.0
    for _ in range(rounds if n else 0):
        z = np.bincount(doc, (v * scale)[flat], n) + vb
        r = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target) / n
        nw = v - step * np.bincount(flat, r[doc], size) * scale
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * penalty, 0)
        nb = vb - step * r.sum()
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    out = np.zeros(_size())
    out[used] = w * scale
    return out, b


def lexicon(rows: list[np.ndarray], toxic: np.ndarray, least: int = 5, ratio: float = 8.0,
            significance: float = 40.0) -> np.ndarray:
    """Word features at least ``ratio`` times as frequent in toxic documents
    as in others, seen in ``least`` toxic ones or more, and not by chance.
    Documents with the same smallest rare feature under a random order count
    as copies of each other, once."""
    size = 1 << _BITS
    df = np.bincount(np.concatenate([np.empty(0, np.int64), *rows]).astype(np.int64), minlength=_size())
    rare = [r[(r < size) & (df[r] <= 0.005 * len(rows) + 2)] for r in rows]
    least_feature = [int(mix64(r).min()) if len(r) else i for i, r in enumerate(rare)]
    _, once = np.unique(least_feature, return_index=True)
    rows, toxic = [rows[i] for i in once], toxic[once]
    count = lambda keep: np.bincount(np.concatenate([r[r < size] for r, k in zip(rows, keep) if k] or [np.empty(0, np.int64)]).astype(np.int64), minlength=size)
    bad, other = count(toxic), count(~toxic)
    share_bad, share_other = (bad + 0.1) / max(toxic.sum(), 1), (other + 0.5) / max((~toxic).sum(), 1)
    # Log-likelihood ratio of one rate for both kinds against a rate for each.
    n_bad, n_other = max(int(toxic.sum()), 1), max(int((~toxic).sum()), 1)
    entropy = lambda k, n: k * np.log(np.maximum(k, 1e-12) / n) + (n - k) * np.log(np.maximum(n - k, 1e-12) / n)
    gain = 2 * (entropy(bad, n_bad) + entropy(other, n_other) - entropy(bad + other, n_bad + n_other))
    return np.flatnonzero((bad >= least) & (share_bad > ratio * share_other) & (gain > significance))


class _Lexicons(dict):
    """word -> bits of the lexicons that have the word or its stem, for at most ``most`` words."""

    def __init__(self, lexicons: list[np.ndarray], most: int = 100_000):
        self.bits, self.most, self.hashes = {}, most, Hashes()
        for j, words in enumerate(lexicons):
            for w in words.tolist():
                self.bits[w] = self.bits.get(w, 0) | 1 << j

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        bare, mask = word.rstrip(_ENDS), (1 << _BITS) - 1
        self[word] = b = self.bits.get(self.hashes[bare] & mask, 0) | self.bits.get(self.hashes[b"\0" + bare[:4]] & mask, 0)
        return b


def _lexicon_patterns(docs: DataFrame, hand: DataFrame, lexicons: list[np.ndarray]):
    """(hits, toxic, n) over all documents; hits has one bit a lexicon."""
    def look(batches):
        known = _Lexicons(lexicons)
        for batch in portions(batches, 1):
            hits = []
            for text in binary_texts(batch.column(1)):
                bits = 0
                for word in set(text.lower().split()) if text else ():
                    bits |= known[word]
                hits.append(bits)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hits, pa.int64())], names=["doc_id", "hits"])

    seen = docs.select("doc_id", "text").mapInArrow(look, "doc_id long, hits long").join(hand.select("doc_id", "toxic"), "doc_id", "left")
    return seen.groupBy("hits", "toxic").agg(F.count(F.lit(1)).alias("n")).toPandas()


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = 12_000, folds: int = 3) -> dict:
    """Weights of both scorers from (doc_id, text) and hand labels (doc_id, quality, toxic).

    The labellers of form vote on all documents, and expectation-maximisation
    runs over the counts of all vote patterns (at most 2 ** 9 of them a label);
    so it does for the votes of the toxic lexicons. The lexicons are learned and
    the scorers trained on about ``sample_docs`` documents chosen by hash: that
    bounds what the driver gathers. Half of them are hand-labelled, or as many
    as there are, so the labels used do not thin out as documents grow. If the
    labels give no lexicon, a warning says that no document is found toxic.
    Repeated labels of a document count as the worst of them.
    """
    hand = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    marked = hand.filter("quality is not null or toxic is not null").select("doc_id")
    n_docs, n_marked = docs.count(), docs.select("doc_id").join(marked, "doc_id", "left_semi").count()
    take = min(n_marked, max(sample_docs // 2, sample_docs - (n_docs - n_marked)))
    below = lambda most, of: int(min(1.0, most / max(of, 1)) * (1 << 30))
    most_marked, most_other = below(take, n_marked), below(sample_docs - take, n_docs - n_marked)
    spot = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), F.lit(6)), F.lit(1 << 30))
    picked = np.array([r[0] for r in docs.select("doc_id").join(marked, "doc_id", "left_semi").filter(spot < most_marked).distinct().collect()], np.int64)

    def look(batches):
        hashes = Hashes()
        for batch in portions(batches, 1):
            texts, place = binary_texts(batch.column(1)), batch.column(2).to_numpy()
            chosen = (place < most_other) | ((place < most_marked) & np.isin(batch.column(0).fill_null(-1).to_numpy(), picked))
            codes = [votes(t) for t in texts]
            found = [features(t, c, hashes).tobytes() if k else None for t, c, k in zip(texts, codes, chosen)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.int64()), pa.array(found, pa.binary())],
                                             names=["doc_id", "code", "features"])

    seen = docs.select("doc_id", "text", spot.alias("place")).mapInArrow(look, "doc_id long, code long, features binary")
    seen = written(seen.join(hand, "doc_id", "left"), "weak-votes")
    patterns = seen.groupBy("code", "quality").agg(F.count(F.lit(1)).alias("n")).toPandas()
    most = F.when(F.coalesce("quality", "toxic").isNotNull(), most_marked).otherwise(most_other)
    sample = seen.filter("features is not null").filter(spot < most).select("doc_id", "code", "quality", "toxic", "features").orderBy("doc_id", "code").toArrow()
    stored, sample = sample["features"].to_pylist(), sample.drop_columns("features").to_pandas()
    n = len(LABELLERS)
    hand_vote = lambda s, bad: np.where(s.isna(), NONE, np.where(s == bad, BAD, GOOD))

    # Low quality: labellers of form and the hand label.
    cover = float(patterns.loc[patterns["quality"].notna(), "n"].sum() / max(patterns["n"].sum(), 1)) if len(patterns) else 0.0
    start = np.stack([start_table(0.25, 0.003, True)] * n + [start_table(0.95, 0.03, False, cover)], 1)
    post = estimate(np.column_stack([digits(patterns["code"].to_numpy(np.int64), n), hand_vote(patterns["quality"], 0)]), patterns["n"].to_numpy(float), start)
    by = {(c, None if q != q else q): p for c, q, p in zip(patterns["code"], patterns["quality"], post)}
    low = np.array([by[c, None if q != q else q] for c, q in zip(sample["code"], sample["quality"])])
    rows = [np.frombuffer(f, np.uint32) for f in stored]

    # Toxicity: one lexicon a fold, learned on the labelled documents outside it, and the hand label.
    fold = np.array([crc_bucket(None if d != d else int(d), folds) for d in sample["doc_id"]], np.int64)
    labelled, toxic = sample["toxic"].notna().to_numpy(), (sample["toxic"] == 1).to_numpy()
    lexicons = []
    for f in range(folds):
        use = labelled & (fold != f)
        lexicons.append(lexicon([r for r, u in zip(rows, use) if u], toxic[use]))
    lexicons = [words for words in lexicons if len(words)]
    poison = np.zeros(len(rows))
    if lexicons:
        patterns = _lexicon_patterns(docs, hand, lexicons)
        m, hits = len(lexicons), patterns["hits"].to_numpy(np.int64)
        hit = np.where(hits[:, None] >> np.arange(m) & 1, BAD, GOOD)
        cover = float(patterns.loc[patterns["toxic"].notna(), "n"].sum() / patterns["n"].sum())
        start = np.stack([start_table(0.9, 0.02, False)] * m + [start_table(0.95, 0.02, False, cover)], 1)
        post = estimate(np.column_stack([hit, hand_vote(patterns["toxic"], 1)]), patterns["n"].to_numpy(float), start, prior_bad=0.05)
        by = {(h, None if t != t else t): p for h, t, p in zip(hits.tolist(), patterns["toxic"], post)}
        found = sum((np.array([np.isin(r, words).any() for r in rows], np.int64) << j for j, words in enumerate(lexicons)), np.zeros(len(rows), np.int64))
        poison = np.array([by[h, None if t != t else t] for h, t in zip(found.tolist(), sample["toxic"])])
    if not poison.max(initial=0) > 0.5:
        warnings.warn(f"no document will be found toxic: {int(toxic.sum())} toxic of {int(labelled.sum())} hand labels used, "
                      f"{len(lexicons)} lexicons", RuntimeWarning, stacklevel=2)
    return {"quality": train(rows, low), "toxic": train(rows, poison) if poison.max(initial=0) > 0.5 else (np.zeros(_size()), -20.0)}


def classify(docs: DataFrame, model: dict) -> DataFrame:
    """Adds quality_score, toxic_score (0 to 1) and kept to the rows, in place of columns of these names.

    A document is kept if its quality score is at least 0.5 and its toxic
    score below 0.5. Null and empty texts have no words and are scored by
    their votes alone; documents of no words are never kept.
    """
    docs = docs.drop("quality_score", "toxic_score", "kept")
    shared = docs.sparkSession.sparkContext.broadcast({k: (w.astype(np.float32), b) for k, (w, b) in model.items()})
    place = docs.columns.index("text")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]

    def score(batches):
        hashes = Hashes()
        (wq, bq), (wt, bt) = shared.value["quality"], shared.value["toxic"]
        sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        for batch in portions(batches, place):
            q, t, empty = [], [], []
            for text in binary_texts(batch.column(place)):
                f = features(text, votes(text), hashes)
                q.append(wq[f].sum() + bq)
                t.append(wt[f].sum() + bt)
                empty.append(not text or not text.strip(WHITE))
            good, poison = 1 - sigmoid(np.array(q, float)), sigmoid(np.array(t, float))
            kept = (good >= 0.5) & (poison < 0.5) & ~np.array(empty, bool)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(good), pa.array(poison), pa.array(kept)],
                                             names=[*batch.schema.names, "quality_score", "toxic_score", "kept"])

    return docs.mapInArrow(score, ", ".join(fields) + ", quality_score double, toxic_score double, kept boolean")


def op6(spark, sf_dir) -> DataFrame:
    from ..tables import read_table
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return classify(docs, model).drop("text")
