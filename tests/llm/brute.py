"""Brute-force versions of the operators, for small tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

SF_SMALL = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text, lower=False):
    if text is None:
        return []
    return WORDS.findall(text.translate(LOWER) if lower else text)


def crc(doc_id, mod):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % mod


def targets(sizes, weights=(5, 2, 1), most=3):
    """sizes: source -> size. Share, stop and share again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out, free = sum(sizes.values()), {}, set(names)
    while free:
        rest = total - sum(out.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s] + 1e-9}
        if not over:
            return out | share
        out |= {s: float(most * sizes[s]) for s in over}
        free -= over
    return out


def rule_figures(text, least=8):
    w = words(text)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    inside = [False] * len(w)
    for i in range(len(w) - 4):
        if grams[tuple(w[i:i + 5])] > 1:
            inside[i:i + 5] = [True] * 5
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, sum(inside)


def repeated(w, least=8):
    """Share of word bytes inside, and bytes of the longest, repeated run of ``least`` words or more."""
    n = len(w)
    best = [0] * n
    order = sorted(range(n), key=lambda i: w[i:])
    for a, b in zip(order, order[1:]):
        k = 0
        while a + k < n and b + k < n and w[a + k] == w[b + k]:
            k += 1
        best[a], best[b] = max(best[a], k), max(best[b], k)
    inside, longest = [False] * n, 0
    for i in range(n):
        if best[i] >= least:
            inside[i:i + best[i]] = [True] * best[i]
            longest = max(longest, sum(len(x.encode()) for x in w[i:i + best[i]]))
    size = [len(x.encode()) for x in w]
    return sum(s for s, k in zip(size, inside) if k) / max(1, sum(size)), longest


def katz(docs, held_out, most=5):
    """(doc_id, text) -> doc_id: (n_tokens, n_known, N, base, score); also the model's distribution by history."""
    tokens = {i: words(t, True) + ["</s>"] for i, t in docs}
    uni, pair = Counter(), Counter()
    for i, t in docs:
        if not held_out(i):
            uni.update(tokens[i])
            pair.update(zip(["<s>"] + tokens[i], tokens[i]))
    N, V = sum(uni.values()), len(uni)

    def discounts(counter):
        of = Counter(counter.values())
        d = {}
        if of[1]:
            common = (most + 1) * of[most + 1] / of[1]
            for r in range(1, most + 1):
                if of[r] and common < 1:
                    x = ((r + 1) * of[r + 1] / (r * of[r]) - common) / (1 - common)
                    if 0 < x < 1:
                        d[r] = x
        return lambda r: d.get(r, 1.0)
    du, dp = discounts(uni), discounts(pair)
    freed = sum((1 - du(c)) * c for c in uni.values())
    total = N if freed > 0 else N + 1
    unknown = freed / total if freed > 0 else 1 / total
    p1 = lambda w: du(uni[w]) * uni[w] / total if uni[w] else unknown
    after = defaultdict(list)
    for (h, w), c in pair.items():
        after[h].append((w, c))
    back = {}
    for h, rows in after.items():
        size, free = sum(c for _, c in rows), sum((1 - dp(c)) * c for _, c in rows)
        div = size if free > 0 else size + 1
        back[h] = (div, (free if free > 0 else 1) / div / (1 - sum(p1(w) for w, _ in rows)))

    def p2(h, w):
        if pair[h, w]:
            return dp(pair[h, w]) * pair[h, w] / back[h][0]
        return p1(w) * (back[h][1] if h in back else 1)
    out = {}
    for i, _ in docs:
        t = tokens[i]
        out[i] = (len(t), sum(uni[w] > 0 for w in t), N, sum(math.log10((uni[w] + 0.1) / (N + 0.1 * (V + 1))) for w in t),
                  sum(math.log10(p2(h, w)) for h, w in zip(["<s>"] + t, t)))
    return out, {h: sum(p2(h, w) for w in [*uni, "<never seen>"]) for h in list(after)[:50]}


def components(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def shingles(text, width=3):
    w = words(text, True)
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def near_duplicate_components(docs, width=3, percent=85):
    """docs: (doc_id, text) with distinct ids in rising order -> doc_id: (size, component)."""
    sets = [shingles(t, width) for _, t in docs]
    at = defaultdict(list)
    links = []
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in at[x])
        links += [(j, i) for j, k in common.items() if 100 * k >= percent * (len(s) + len(sets[j]) - k)]
        for x in s:
            at[x].append(i)
    c = components(len(docs), links)
    return {d: (len(s), docs[k][0]) for (d, _), s, k in zip(docs, sets, c)}
