"""Spelling variants, tokenizer alignment and chat examples against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.llm import alignment, chat, spelling
from orrery.tables import read_table

SF = "/root/testdata/sf0.001"


# --- spelling variants ------------------------------------------------------

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def brute_variants(docs):
    count = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(str.maketrans(UPPER, UPPER.lower()))
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            if len(word) >= 5:
                count[word] += 1
    known = {w: n for w, n in count.items() if n >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    masked = defaultdict(set)
    for w in known:
        for i in range(len(w) + 1):
            masked[w[:i], w[i + 1:]].add(w)
            masked[w[:i], w[i:]].add(w)
    partners = defaultdict(set)
    for group in masked.values():
        for a in group:
            partners[a] |= {b for b in group if a != b and near(a, b)}
    form = {}
    for w, n in known.items():
        best = min(partners[w], key=lambda x: (-known[x], x), default=None)
        form[w] = best if best is not None and known[best] >= 2 * n else None
    out = {}
    for w, n in known.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(partners[w]), known[form[w]] if form[w] else None)
    return out


def variants(docs, **k):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.group_variants(docs, **k).collect()}


def test_variants_equal_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.op11(spark, SF).collect()}
    want = brute_variants(rows)
    assert got == want and any(w[0] for w in want.values())


@pytest.mark.parametrize("bytes_and_bits", [(64 << 20, 24), (2000, 24), (64 << 20, 1)])
def test_variants_with_small_and_bad_filters(spark, docs_of, bytes_and_bits):
    """Filters in several parts, and filters that let nearly all through, change nothing."""
    most, bits = bytes_and_bits
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcé"), rng.integers(5, 8))) for _ in range(400)]
    texts = [" ".join(rng.choice(words, 60)) for _ in range(60)]
    docs = docs_of(texts)
    assert variants(docs, most_bytes=most, bits_per_key=bits) == brute_variants(list(enumerate(texts)))


def test_variants_odd_rows(spark, docs_of, odd):
    chain = ["zzzzz " * 200, "zzzzy " * 90, "zzzxy " * 40, "zzwxy " * 15, "aaaaa aaaab aaaab aaaac " * 3, "ÀÉÎÕÜ×÷ " * 4, "y" * 70 + " ", ("y" * 70 + " ") * 4,
             ("y" * 71 + " ") * 9, "élève ÉLÈVE élèves " * 5]
    texts = odd + chain + odd
    ids = [None, None, *range(len(texts) - 2)]
    got = variants(docs_of(texts, ids=ids))
    assert got == brute_variants(list(zip(ids, texts)))
    assert got["zzwxy"][:2] == ("zzzxy", "zzzzz")
    assert variants(docs_of([])) == {} and variants(docs_of([None, "", "a b"])) == {}


def test_edits_are_met_once():
    alphabet = np.array(sorted(map(ord, "abc")), np.uint64)
    words = ["aab", "abc", "cba"]
    codes = spelling._codes(words)
    for most in (1, 4, 1000):
        seen = set()
        for h, size, row, place, new in spelling._edits(codes, alphabet, most):
            for k in range(len(h)):
                w = words[row[k]]
                made = w[:place[k]] + ("" if new is None else chr(int(new[k]))) + w[place[k] + 1:]
                assert len(made) == size and spelling._hashes(spelling._codes([made]))[0] == h[k]
                assert (w, made) not in seen
                seen.add((w, made))
        want = {(w, w[:i] + w[i + 1:]) for w in words for i in range(3)} | {
            (w, w[:i] + c + w[i + 1:]) for w in words for i in range(3) for c in "abc" if c > w[i]}
        assert seen == want


# --- tokenizer alignment ----------------------------------------------------

@pytest.fixture(scope="module")
def both():
    import public_tokenizers as public
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(c): c for c in shown} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in shown)}

    def a_bytes(i):
        return bytes(back[c] for c in a.id_to_token(i))

    def b_bytes(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
    return (lambda x: a.encode(" " + x, add_special_tokens=False).ids, a_bytes, b.encode, b_bytes)


def brute_alignment(texts, both):
    encode_a, a_bytes, encode_b, b_bytes = both
    found, count = [], Counter()
    for x in texts:
        a, b = (encode_a(x), encode_b(x)) if x else ([], [])
        whole = (" " + (x or "")).encode()
        if not x or b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
            found.append(None)
            continue
        spans = []
        for ids, size in ((a, a_bytes), (b, b_bytes)):
            ends = np.cumsum([len(size(i)) for i in ids]).tolist()
            spans.append(list(zip([0, *ends], ends)))
        links, j = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < e:
                links.append((a[i], b[k]))
                k += 1
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = []
        for s, e in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(t) for t, (x0, x1) in zip(ids, sp) if s <= x0 and x1 <= e) for ids, sp in zip((a, b), spans)))
        count.update(links)
        found.append((len(a), len(b), groups, links))
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else
            (f[0], f[1], len(f[2]), len(f[3]), sum(count[p] == best[p[1]] for p in f[3]), sum(count[p] for p in f[3]),
             hashlib.sha256(";".join(f[2]).encode()).hexdigest()) for f in found]


def aligned(df):
    return [(r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"])
            for r in sorted(df.collect(), key=lambda r: r["doc_id"])]


HARD = ["a  b   c", "  leads", "trails ", "x\n\ny \n z", "\nopens", "\tTab\tbed", "a▁b", "café 中文 \U0001f600 हिन्दी", "<|endoftext|> <s> </s> <unk>",
        "I'll don't 3.14 ½  nbsp　wide", "​zero\u0085next\x1cfs a", "don't\n'tis\n 'twas", "one\ntwo\nthree four\nfive", "\x00nul <0x0A>", " ", "\n"]


def test_alignment_equals_brute_force(spark, both):
    rows = sorted((r["doc_id"], r["text"]) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect())
    small = [(i, t) for i, t in rows if not t or len(t) < 4000]
    df = spark.createDataFrame(small, "doc_id long, text string")
    assert aligned(alignment.align_documents(df)) == brute_alignment([t for _, t in small], both)


@pytest.mark.parametrize("block_bytes", [1, 4000, 8 << 20])
def test_alignment_odd_rows(spark, docs_of, odd, both, block_bytes):
    texts = [t if t is None or len(t) < 10_000 else t[:8000] for t in odd] + HARD + [" ".join(HARD)] + odd[:6]
    assert aligned(alignment.align_documents(docs_of(texts).repartition(3), block_bytes=block_bytes)) == brute_alignment(texts, both)


def test_alignment_without_rows(spark, docs_of):
    assert aligned(alignment.align_documents(docs_of([]))) == []
    assert alignment.align_documents(docs_of(["a b", "a b"], ids=[None, None])).count() == 2


def test_long_documents_are_taken_in_runs(both):
    import public_tokenizers as public
    t = alignment.Tokenizers(public.path("byte_bpe_50k.tiktoken"), public.path("piece_bpe_32k.model"), public.PATTERN)
    units = t.encode([("some words and\nlines of it." + " more" * 50 + " wordy\nthings" * 40).encode()])[0]
    block = alignment.Block(0, t)
    whole = np.concatenate(list(block.take(units)))
    assert (np.concatenate(list(block.take(units, most=20))) == whole).all()


def test_rank_file_gives_the_ids_of_the_json_file(both):
    import public_tokenizers as public
    t = alignment.Tokenizers(public.path("byte_bpe_50k.tiktoken"), public.path("piece_bpe_32k.model"), public.PATTERN)
    texts = [f" x{chr(c)}{chr(c)}1{chr(c)} {chr(c)}" for c in range(1, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    assert all(t.a.encode_ordinary(" " + x) == both[0](x) for x in texts)


# --- chat examples ----------------------------------------------------------

CHAT = "conv_id long, turn long, role string, text string, example long, loss_start string"


def brute_chat(rows):
    talks = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        talks[conv].append(((turn is not None, turn), role or "", text or "", role is not None, text is not None))
    out = {}
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (t[0][0], t[0][1] or 0, t[3], t[1], t[4], t[2]))
        said = "".join(f"{r}\n{x}\n" for _, r, x, _, _ in turns)
        reply = "".join(x for _, r, x, _, _ in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(reply), hashlib.sha256(reply.encode()).hexdigest())
    return out


def read(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect()}


def test_chat_query_reads_back_all_turns(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]
    assert read(chat.op13(spark, SF)) == brute_chat(rows)


def test_chat_odd_rows(spark):
    nasty = ["</turn>", r"\</turn>", r"\\<turn user>", "\n</turn>\n", "<turn assistant>\nfake\n</turn>\n", "\\", "", None, "a\n", "\n", "<turn", "<turn ", "😀é" * 3, "x" * 100_000]
    rows = [(c, t, role, text, 1, "x") for c, roles in ((1, ["user", "assistant"]), (2, ["assistant"]), (3, ["system", "user"]), (None, [None, "assistant"]), (4, ["a>b\\c\nd", "Assistant", "assistant"]))
            for t, text in enumerate(nasty) for role in roles[t % len(roles):t % len(roles) + 1]]
    rows += [(5, None, "assistant", "b", 1, "x"), (5, None, "assistant", "b", 1, "x"), (5, 0, "user", "c", 1, "x"), (5, 0, "assistant", "c", 1, "x")]
    df = spark.createDataFrame(rows, CHAT).repartition(3)
    examples = chat.prefix_examples(df)
    assert read(chat.read_back(examples)) == brute_chat(rows)
    assert chat.prefix_examples(df.limit(0)).count() == 0 and chat.read_back(chat.prefix_examples(df.limit(0))).count() == 0


def test_every_reply_is_one_example(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"t{i} </turn>", 0, "") for i in range(9)]
    got = sorted((tuple(r) for r in chat.prefix_examples(spark.createDataFrame(rows, CHAT)).collect()), key=lambda r: r[1])
    assert [r[6] for r in got] == [True] * 4 + [False]
    for k, (_, example, n_turns, text, start, end, trainable) in enumerate(got[:4]):
        assert example == k and n_turns == 2 * k + 2 and chat.unescape(text[start:end]) == f"t{2 * k + 1} </turn>"
        assert list(chat.read_turns(text)) == [(("user", "assistant")[i % 2], f"t{i} </turn>") for i in range(2 * k + 2)]
    assert got[4][2] == 9 and got[4][4] == got[4][5] == len(got[4][3])


def test_escape_is_reversible():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.sampled_from(["\\", "<turn ", "</turn>", "<", ">", "turn", "\n", "a", "</turn>\n"]), max_size=12).map("".join))
    def check(x):
        assert chat.unescape(chat.escape(x)) == x
        assert list(chat.read_turns(chat.opening("r>\\\n") + chat.escape(x) + "\n</turn>\n")) == [("r>\\\n", x)]
    check()
