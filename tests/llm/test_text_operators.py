"""Mixing, quality rules, packing, language model, language ID, classifier and
licence scan against brute force on whole small tables and odd texts."""

import math
import random
import zlib

import brute
import numpy as np
import pytest
from brute import SF_SMALL

from orrery.llm import classifier, katz, language, licenses, mixing, packing, repetition
from orrery.llm.common import crc_bucket, crc_bucket_col
from orrery.tables import read_table


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def documents(spark):
    return [(r.doc_id, r.text, r.lang, r.source) for r in read_table(spark, SF_SMALL, "documents").collect()]


# --- mixing -----------------------------------------------------------------

def check_mix(spark, docs, block_words):
    documents_, pieces = mixing.mix(docs, block_words=block_words)
    got = rows(documents_)
    sizes = {}
    for r in docs.select("source", "text").collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(brute.words(r.text))
    want = brute.targets(sizes)
    taken, words_at = {}, {}
    for p in rows(pieces):
        key = (p["source_no"], p["start"])
        taken[key] = taken.get(key, 0) + p["n_words"]
        for w in range(p["from_word"], p["from_word"] + p["n_words"]):
            words_at[key, p["epoch"], w] = words_at.get((key, p["epoch"], w), 0) + 1
    assert all(n == 1 for n in words_at.values())  # a word is taken once an epoch
    by_source = {}
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9, abs=1e-9)
        t = taken.get((r["source_no"], r["start"]), 0) if r["size"] else 0
        assert t <= 3 * r["size"]
        by_source[r["source"]] = by_source.get(r["source"], 0) + t
    for s, t in by_source.items():
        assert abs(t - want[s]) <= 0.5 + 1e-6
    return got, rows(pieces)


def test_mix_small_table(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    got, pieces = check_mix(spark, docs, 300)
    assert len(got) == docs.count()
    again = rows(mixing.mix(docs, block_words=300)[1])
    order = lambda ps: sorted(tuple(sorted(p.items())) for p in ps)
    assert order(pieces) == order(again)


def test_mix_interleaves_sources_evenly(spark, docs_of):
    docs = docs_of(["w " * 100] * 60, sources=["a"] * 30 + ["b"] * 30)
    _, pieces = check_mix(spark, docs, 50)
    by_slot = [p["source_no"] for p in sorted(pieces, key=lambda p: (p["slot"], p["from_word"]))]
    share = by_slot.count(0) / len(by_slot)
    for n in range(40, len(by_slot), 20):
        assert abs(by_slot[:n].count(0) / n - share) < 0.1


def test_mix_odd_rows(spark, docs_of, odd):
    sources = [None, "z", "a", "é", "a", "a", "hot", "hot", "hot", "A", None]
    check_mix(spark, docs_of(odd, sources=sources, ids=[1, None, 2, 3, 4, 4, None, None, 5, 6, 7]), 700)
    documents_, pieces = mixing.mix(docs_of([]))
    assert documents_.count() == 0 and pieces.count() == 0
    documents_, pieces = mixing.mix(docs_of([None, "", " "]))
    assert documents_.count() == 3 and pieces.count() == 0


# --- quality rules ------------------------------------------------------------

def check_rules(docs):
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts[r.doc_id] = r.text
    for r in rows(repetition.quality_rules(docs)):
        n, chars, symbols, dup, rep = brute.rule_figures(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, rep)
        assert r["base_failed"] == (n < 10 or 100 * rep > 20 * n)
        w = brute.words(texts[r["doc_id"]])
        if len(w) < 800 and max(map(lambda x: len(x.encode()), w), default=0) <= 64:
            share, longest = brute.repeated(w)
            assert r["repeat_covered"] == pytest.approx(share) and r["longest_repeat"] == longest
            assert r["kept"] == (not r["base_failed"] and share <= 0.2 and longest <= 500)


def test_rules_small_table(spark):
    check_rules(read_table(spark, SF_SMALL, "documents"))


def test_rules_odd_texts(spark, docs_of, odd):
    rng = random.Random(3)
    some = " ".join(rng.choice("ab") for _ in range(300))
    check_rules(docs_of(odd + [some, some + "\n" + some, "a " * 400, "x y z " * 3, "l one\nl one\n\n \nl one\nl two" * 3]))
    assert repetition.quality_rules(docs_of([])).count() == 0


def test_rules_see_repeats_without_spaces(spark, docs_of):
    rng = random.Random(5)
    line = "".join(chr(0x4E00 + rng.randrange(2000)) for _ in range(60))
    once = " ".join("".join(chr(0x4E00 + rng.randrange(2000)) for _ in range(60)) for _ in range(12))
    got = {r["doc_id"]: r for r in rows(repetition.quality_rules(docs_of([once, once + line + line + line + line])))}
    assert got[0]["kept"] and got[0]["repeat_covered"] < 0.05
    assert got[1]["repeat_covered"] > 0.1


def test_rules_see_stutters_and_short_phrases(spark, docs_of):
    rng = random.Random(6)
    some = lambda n: ["".join(rng.choices("abcdefghij", k=6)) for _ in range(n)]
    junk = [" ".join(w for w in some(8) for _ in range(5)), " ".join(w for w in some(20) for _ in range(2)),
            " ".join(" ".join(["only", "here", "today", "cheap", *some(2)]) for _ in range(30)),
            " ".join(" ".join(some(1) * 3 + some(1) * 4) for _ in range(300))]
    plain = [" ".join(some(40)), " ".join(rng.choices(some(3000), k=20_000)), " ".join(" ".join(["of", "the", *some(4)]) for _ in range(400)), "one"]
    got = {r["doc_id"]: r for r in rows(repetition.quality_rules(docs_of(junk + plain)))}
    for i in range(len(junk)):
        assert not got[i]["base_failed"] and got[i]["repeat_covered"] <= 0.2 and got[i]["longest_repeat"] <= 500
        assert got[i]["short_covered"] > 0.5 and not got[i]["kept"]
    for i in range(len(junk), len(junk) + 3):
        assert got[i]["short_covered"] < 0.4 and got[i]["kept"]
    assert got[len(junk) + 3]["short_covered"] == 0


# --- packing --------------------------------------------------------------------

def test_word_memos_stay_small():
    from orrery.llm.common import Hashes
    hashes, bits = Hashes(), classifier._Lexicons([])
    most = 0
    for i in range(250_000):
        word = b"%d" % i
        assert hashes[word] == Hashes()[word] if i % 50_000 == 0 else hashes[word] >= 0
        assert bits[word] == 0
        most = max(most, len(hashes), len(bits), len(bits.hashes))
    assert most <= 100_000


def test_plain_words_go_to_the_model_and_others_keep_the_tokenizers_ids():
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(packing.tokenizer_path())
    asked = []

    class Asked(packing.WordTokens):
        def whole(self, word):
            asked.append(word)
            return super().whole(word)

    known = Asked(packing.tokenizer_path(), most=4)
    for text in ("Abc$$$ abc ABC### Caf\u00c9*** caf\u00e9 it's IT'S a<b a> B2B",
                 "J\u030cab J\u030cAB K\u0331 \u01f0", "<|ENDOFTEXT|> <|endoftext|> A<|endoftext|>.", "\u0130I \u03a3A\u03a3 \u4e2d\u6587 \u1e9e."):
        words = packing.lowered(text.encode()).split()
        assert np.frombuffer(b"".join(map(known.__getitem__, words)), "<u4").tolist() == tk.encode(text, add_special_tokens=False).ids
        assert len(known) <= 4
    assert not {"abc$$$", "abc###", "caf\u00e9***"} & set(asked) and {"$$$", "###", "***", ">"} <= set(asked)


def check_pack(spark, docs, length=2048):
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(packing.tokenizer_path())
    got = rows(packing.pack_documents(docs, length=length))
    want = sorted((r.doc_id if r.doc_id is not None else -1, len(tk.encode(r.text or "", add_special_tokens=False).ids) + 1)
                  for r in docs.select("doc_id", "text").collect())
    crcs = {}
    for r in docs.select("doc_id", "text").collect():
        ids = [*tk.encode(r.text or "", add_special_tokens=False).ids, packing.DOC_END]
        for s in range(0, len(ids), length):
            part = np.array(ids[s:s + length], "<u4")
            crcs.setdefault((r.doc_id, s, len(part), len(ids)), []).append(zlib.crc32(part.tobytes()))
    have = {}
    for r in got:
        have.setdefault((r["doc_id"], r["start"], r["length"], r["doc_tokens"]), []).append(r["ids_crc32"])
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in crcs.items()}
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["doc_tokens"]) for r in got if r["start"] == 0) == want
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= length
    used = sum(r["length"] for r in got)
    return len(bins) * length, used


def test_pack_small_table(spark):
    room, used = check_pack(spark, read_table(spark, SF_SMALL, "documents"))
    assert used / room > 0.98


def test_pack_odd_texts(spark, docs_of, odd):
    check_pack(spark, docs_of(odd, ids=[1, None, 2, 2, 3, 3, None, 5, 6, 7, 8]))
    check_pack(spark, docs_of(odd), length=100)
    assert packing.pack_documents(docs_of([])).count() == 0


def test_first_fit_decreasing_is_first_fit():
    rng = random.Random(1)
    for n in (1, 2, 7, 200):
        lengths = np.array([rng.randint(1, 64) for _ in range(n)])
        bins, offsets = packing.first_fit_decreasing(lengths, 64)
        room, want = [], {}
        for i in sorted(range(n), key=lambda i: (-lengths[i], i)):
            for k, r in enumerate(room):
                if r >= lengths[i]:
                    break
            else:
                room.append(64)
                k = len(room) - 1
            want[i] = (k, 64 - room[k])
            room[k] -= lengths[i]
        assert {i: (int(b), int(o)) for i, (b, o) in enumerate(zip(bins, offsets))} == want


# --- Katz ---------------------------------------------------------------------------

def check_katz(docs, held, column, **settings):
    source = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want, sums = brute.katz(source, held)
    assert all(abs(s - 1) < 1e-9 for s in sums.values())
    got = rows(katz.katz_scores(docs, column, **settings))
    assert len(got) == len(source)
    for r in got:
        n_tokens, n_known, total, base, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n_tokens, n_known, total)
        assert r["base_score"] == pytest.approx(base, abs=1e-6) and r["score"] == pytest.approx(score, abs=1e-6)
        assert r["held_out"] == held(r["doc_id"]) and math.isfinite(r["score"])


def test_katz_small_table(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    check_katz(docs, lambda i: brute.crc(i, 10) == 0, crc_bucket_col("doc_id", 10) == 0, block_tokens=9000, part_keys=4000)


def test_katz_odd_texts(spark, docs_of, odd):
    from pyspark.sql import functions as F
    check_katz(docs_of(odd), lambda i: i % 3 == 0, F.col("doc_id") % 3 == 0)
    check_katz(docs_of(["a b", "c"]), lambda i: True, F.lit(True))
    assert katz.katz_scores(docs_of([]), F.lit(False)).count() == 0


# --- language -----------------------------------------------------------------------

def test_language_small_table(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    model = language.fit(docs.filter(~language.held_out()))
    got = {r["doc_id"]: r for r in rows(language.predict(docs.select("doc_id", "text"), model))}
    held = [(i, t, lang) for i, t, lang, _ in documents(spark) if crc_bucket(i, 4) == 2 and language.words_of((t or "").encode())]
    right = sum(got[i]["lang_pred"] == lang for i, _, lang in held)
    assert right / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_brute_force(spark, docs_of):
    model = language.fit(docs_of(["the cat sat the mat", "der hund und die katze", "the dog", "die maus und der hund"], langs=["en", "de", "en", "de"]))

    def score(text):
        total, words = np.zeros(2), language.words_of(text.encode())
        for w in words:
            if w in model.index[0]:
                total += model.table[model.index[0][w]]
            else:
                for order in (5, 4, 3, 2, 1):
                    known = [model.table[model.index[order][g]] for g in language.grams_of(w, order) if g in model.index.get(order, {})]
                    if known:
                        total += np.mean(known, axis=0)
                        break
        return total / max(1, len(words)) * min(50, len(words))
    texts = ["the mat", "und der", "hunde", "zzz", "catmat", "the der " * 200]
    for r, text in zip(sorted(rows(language.predict(docs_of(texts), model)), key=lambda r: r["doc_id"]), texts):
        s = score(text)
        assert r["lang_pred"] == model.languages[int(s.argmax())]
        assert r["score"] == pytest.approx(np.exp(s.max()) / np.exp(s).sum(), abs=1e-4)


def test_language_odd_texts(spark, docs_of, odd):
    model = language.fit(docs_of(["the cat sat on the mat"] * 3 + ["der hund und die katze"] * 3 + odd, langs=["en"] * 3 + ["de"] * 3 + [None] * len(odd)))
    got = {r["doc_id"]: r for r in rows(language.predict(docs_of(odd + ["1234 !!"]), model))}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (0, 1, 2, len(odd)))
    assert got[0]["block"] == 7  # other columns stay
    empty = language.fit(docs_of([]))
    assert [r["lang_pred"] for r in rows(language.predict(docs_of(["text"]), empty))] == ["und"]
    assert language.predict(docs_of([]), model).count() == 0


# --- classifier -----------------------------------------------------------------------

def test_classifier_separates_hand_labels(spark):
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    got = {r["doc_id"]: r for r in rows(classifier.classify(docs.select("doc_id", "text"), classifier.fit(docs, labels)))}
    hand = [(r.doc_id, r.quality, r.toxic) for r in labels.collect()]
    bad = [got[i]["kept"] for i, q, _ in hand if q == 0]
    clean = [got[i]["kept"] for i, q, t in hand if q == 1 and t == 0]
    assert sum(bad) / len(bad) < 0.1 and sum(clean) / len(clean) > 0.95


def test_classifier_learns_from_other_documents(spark):
    """Toxic and bad documents without a hand label of their own."""
    from pyspark.sql import functions as F
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    got = {r["doc_id"]: r["kept"] for r in rows(classifier.classify(docs.select("doc_id", "text"), classifier.fit(docs, labels.filter(F.col("doc_id") % 2 == 0))))}
    hand = [(r.doc_id, r.quality, r.toxic) for r in labels.filter(F.col("doc_id") % 2 == 1).collect()]
    bad = [got[i] for i, q, _ in hand if q == 0]
    clean = [got[i] for i, q, t in hand if q == 1 and t == 0]
    assert sum(bad) / len(bad) < 0.15 and sum(clean) / len(clean) > 0.93


def test_classifier_uses_labels_that_are_few_among_documents(spark):
    """200 labels of 20,200 documents, a sample of 400: half of it is labelled, and toxic documents are found."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefghijkl", k=6)) for _ in range(400)]
    line = lambda poison: " ".join(rng.choices(vocabulary, k=30) + (["vilework", "hateword", "slurword"] if poison else [])) + "."
    texts = [(i, line(i % 4 == 0)) for i in range(20_200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    model = classifier.fit(docs, labels, sample_docs=400)
    got = rows(classifier.classify(docs.filter("doc_id >= 19000"), model))
    assert all((r["toxic_score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in got)
    with pytest.warns(RuntimeWarning, match="toxic"):
        classifier.fit(docs.limit(300), labels.filter("toxic = 0"))


def test_classifier_odd_rows(spark, docs_of, odd):
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 0), (3, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    good = [f"A sentence with word{i}, and some more words in it, number {i}. Then another one follows here." for i in range(40)]
    docs = docs_of(odd + good, ids=[None, 1, *range(2, len(odd) + 40)])
    got = rows(classifier.classify(docs, classifier.fit(docs, labels)))
    assert len(got) == len(odd) + 40 and all(0 <= r["quality_score"] <= 1 for r in got)
    assert not any(r["kept"] for r in got if not brute.words(r["text"]))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert classifier.classify(docs_of([]), classifier.fit(docs_of([]), none)).count() == 0


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(0)
    bad = rng.random(20000) < 0.2
    votes = np.stack([np.where(rng.random(20000) < np.where(bad, p, q), classifier.BAD, classifier.NONE) for p, q in ((0.6, 0.01), (0.5, 0.02), (0.4, 0.01), (0.55, 0.03))], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    post = classifier.estimate(patterns, counts.astype(float), np.stack([classifier.start_table(0.25, 0.003, True)] * 4, 1))
    by = {tuple(p): x for p, x in zip(patterns.tolist(), post)}
    guess = np.array([by[tuple(v)] for v in votes.tolist()])
    assert ((guess > 0.5) == bad).mean() > 0.93


# --- licences ----------------------------------------------------------------------------

def brute_licenses(text, templates, width=5, similarity=0.8):
    import string

    def bare(t):
        return [x for x in (w.strip(string.punctuation) for w in brute.words(t, True)) if x]
    w, found = bare(text), set()
    for name, t in templates:
        tw = bare(t)
        want = {tuple(tw[i:i + width]) for i in range(max(1, len(tw) - width + 1))}
        k = min(width, len(tw))
        span = 2 * len(tw)
        for s in range(0, max(1, len(w)), 1):
            have = {tuple(w[i:i + k]) for i in range(s, max(s, min(len(w), s + span) - k + 1))}
            if len(want & have) >= similarity * len(want):
                found.add(name)
                break
    return found


def test_licenses_brute_force(spark, docs_of, odd):
    rng = random.Random(2)
    filler = lambda n: " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(n))
    texts = list(odd)
    for _, t in licenses.TEMPLATES:
        texts += [t, filler(37) + "\n" + t + "\n" + filler(90), filler(500) + " " + t.upper() + " " + filler(3), " ".join(t.split()[:len(t.split()) // 2])]
    texts.append(filler(900))
    got = {r["doc_id"]: r for r in rows(licenses.scan_licenses(docs_of(texts), licenses.TEMPLATES))}
    for i, t in enumerate(texts):
        have = {x["template"] for x in got[i]["licenses"]}
        assert have == brute_licenses(t, licenses.TEMPLATES), t
        assert got[i]["n_words"] == len(brute.words(t))
    assert licenses.scan_licenses(docs_of([]), licenses.TEMPLATES).count() == 0
    assert all(not r["licenses"] for r in rows(licenses.scan_licenses(docs_of(texts), [("empty", ""), ("none", None)])))


def test_licenses_small_table(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    got = {r["doc_id"]: {x["template"] for x in r["licenses"]} for r in rows(licenses.scan_licenses(docs, licenses.TEMPLATES))}
    for i, t, _, _ in documents(spark):
        if t and len(t) < 4000:
            assert got[i] == brute_licenses(t, licenses.TEMPLATES)
        if t and "Released under the MIT License." in t:
            assert "mit" in got[i]


def test_licenses_find_short_notices_anywhere():
    """One-shingle notices, shorter and 9-word ones, at the start and in the middle of many texts."""
    templates = [*licenses.TEMPLATES, ("three", "Public domain work."), ("nine", "You may copy this text for any use whatever.")]
    matcher = licenses.Matcher(templates)
    rng, missed = np.random.default_rng(4), 0
    for name in ("mit", "cc-by-nc-4.0", "three", "nine"):
        notice = licenses._words(dict(templates)[name].encode(), licenses._WordHashes())
        for k in range(1500):
            filler = rng.integers(1, 1 << 63, 80, dtype=np.uint64)
            before = 0 if k % 2 else int(rng.integers(1, 60))
            found = {x[0]: x[1:] for x in matcher.scan(np.concatenate([filler[:before], notice, filler[before:]]))}
            missed += found.get(name) != (before, len(notice), 1.0)
    assert missed == 0


def test_licenses_missed_bound_of_every_template():
    """Passages spread over twice a template's words, with the least share that counts, in many fillers."""
    matcher = licenses.Matcher(licenses.TEMPLATES)
    rng = np.random.default_rng(5)
    for name, text in licenses.TEMPLATES:
        notice = licenses._words(text.encode(), licenses._WordHashes())
        cut = (len(notice) - 4) // 5  # shingles that an insertion may break
        for k in range(100):
            filler = rng.integers(1, 1 << 63, 120, dtype=np.uint64)
            gap = filler[100:100 + len(notice)] if cut >= 4 else filler[:0]
            at = len(notice) // 2
            words = np.concatenate([filler[:k % 40], notice[:at], gap, notice[at:], filler[40:100]])
            assert name in {x[0] for x in matcher.scan(words)}, (name, k)
