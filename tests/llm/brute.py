"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import difflib
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def base_labels(text, phrases):
    w = words(text)
    at = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def notices(text, known, k, gap, votes, least):
    """(labels, best coverage) of notices {label: words} in a text: equal k-grams vote for diagonals, near ones merge, and spans with enough votes are compared word by word."""
    w, labels, best = words(text), set(), 0.0
    for label, tpl in known.items():
        diagonals = defaultdict(list)
        for i in range(len(w) - k + 1):
            for j in range(len(tpl) - k + 1):
                if w[i : i + k] == tpl[j : j + k]:
                    diagonals[i - j].append(i)
        runs = []
        for d in sorted(diagonals):
            if runs and d - runs[-1][0] <= gap:
                runs[-1] = (d, runs[-1][1] + diagonals[d])
            else:
                runs.append((d, diagonals[d]))
        n = len(tpl)
        for _, at in runs:
            if len(at) < votes:
                continue
            low, high = max(0, min(at) - n), min(len(w), max(at) + k + n)
            for p in range(low, max(low + 1, high - 3 * n), 3 * n):
                found = difflib.SequenceMatcher(None, tpl, w[p : min(high, p + 6 * n)], autojunk=False).get_matching_blocks()
                coverage = sum(b.size for b in found if b.size >= 2) / n
                best = max(best, coverage)
                if coverage >= least:
                    labels.add(label)
    return labels, best


def quality_features(text, log2, repeats, mix, word_hash, pair_hash):
    """Indicators of a text one by one, with the operator's hash functions: byte trigrams, words, word pairs, runs of equal words."""
    bucket = lambda x: int(mix(np.array([x], np.uint64))[0]) >> (64 - log2)
    raw, w = (text or "").encode(), re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    own = {bucket((raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]) + 1) for i in range(len(raw) - 2)}
    own |= {bucket((word_hash(x) + 2) % 2**64) for x in w}
    own |= {bucket((pair_hash(word_hash(a), word_hash(b)) + 3) % 2**64) for a, b in zip(w, w[1:], strict=False)}
    return own | {bucket(j << 32) for j in range(2, repeats + 1) for i in range(len(w) - j + 1) if len(set(w[i : i + j])) == 1}


def nbsvm(rows, y, smoothing, penalty, epochs, seed):
    """(weights, bias) of a hinge-loss model over indicators scaled by log-count ratios, by dual coordinate descent; rows are sets, dimensions those that occur."""
    p, q = Counter(f for x, s in zip(rows, y, strict=True) if s > 0 for f in x), Counter(f for x, s in zip(rows, y, strict=True) if s < 0 for f in x)
    dimensions = 1 << 18
    sp, sq = sum(p.values()) + smoothing * dimensions, sum(q.values()) + smoothing * dimensions
    ratio = {f: math.log((p[f] + smoothing) / sp) - math.log((q[f] + smoothing) / sq) for f in p | q}
    w, bias, alpha = Counter(), 0.0, [0.0] * len(rows)
    top = {s: penalty * len(rows) / (2 * max(1, y.count(s))) for s in (1, -1)}
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            root = math.sqrt(max(1, len(rows[i])))
            margin = y[i] * (sum(w[f] * ratio[f] for f in rows[i]) / root + bias)
            norm = sum(ratio[f] ** 2 for f in rows[i]) / root**2 + 1
            new = min(max(alpha[i] - (margin - 1) / norm, 0.0), top[y[i]])
            for f in rows[i]:
                w[f] += (new - alpha[i]) * y[i] * ratio[f] / root
            bias += (new - alpha[i]) * y[i]
            alpha[i] = new
    return {f: w[f] * ratio[f] for f in w}, bias


def letter_grams(text):
    """Pairs and triples of letters, lower case, a blank for each gap between words."""
    low = lambda c: (c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " "
    s = " " + "".join(map(low, text or "")) + " "
    pairs = [s[i : i + 2] for i in range(len(s) - 1) if s[i : i + 2] != "  "]
    return pairs + [s[i : i + 3] for i in range(len(s) - 2) if s[i + 1] != " "]


def languages(learn, rows, share, most):
    """(language, score) of each text of ``rows``, with sets of n-grams in place of filters; ``learn`` is (text, lang)."""
    counts = defaultdict(Counter)
    for text, lang in learn:
        counts[lang].update(letter_grams(text))
    rate = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    best = Counter()
    for r in rate.values():
        for g, x in r.items():
            best[g] = max(best[g], x)
    members = {lang: {g for g, x in r.items() if x >= share * best[g]} for lang, r in rate.items()}
    assert all(len(m) <= most for m in members.values())
    out = []
    for text in rows:
        hits = {lang: sum(g in members[lang] for g in letter_grams(text)) for lang in sorted(members)}
        lang = max(hits, key=lambda x: hits[x])
        out.append((lang, hits[lang] / max(1, sum(hits.values()))) if any(c.isalpha() for c in text or "") else ("und", 0.0))
    return out


def components(rows, percent=75, k=5):
    """(doc_id, size, component) of rows with distinct ids."""
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    owners = defaultdict(list)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        shared = Counter(j for g in s for j in owners[g])
        for g in s:
            owners[g].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return sorted((i, len(s), find(i)) for i, s in sets.items())


def row_components(rows, percent=75, k=5):
    """components, where rows may share a doc_id: each row links by its own text."""
    found = components([(j, t) for j, (_, t) in enumerate(rows)], percent, k)
    low = {}
    for j, _, c in found:
        low[c] = min(low.get(c, rows[j][0]), rows[j][0])
    return sorted((rows[j][0], n, low[c]) for j, n, c in found)


def contamination(rows, items, window=10):
    """The columns of op5, longest_match and longest_at included, of each row."""
    known = [(item, words(text)) for item, text in items if words(text)]
    grams = defaultdict(set)
    for number, (_, w) in enumerate(known):
        k = min(window, len(w))
        for j in range(len(w) - k + 1):
            grams[tuple(w[j : j + k])].add((number, j))
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in rows:
        w, hit, found, best = words(text), set(), set(), (0, None)
        for k in sizes:
            for i in range(len(w) - k + 1):
                for number, j in grams.get(tuple(w[i : i + k]), ()):
                    item, own = known[number]
                    n = k
                    while i + n < len(w) and j + n < len(own) and w[i + n] == own[j + n]:
                        n += 1
                    best = min(best, (-n, i))
                    hit |= set(range(i, i + k))
                    found |= set() if item is None else {str(item)}
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit), -best[0], best[1]))
    return sorted(out, key=repr)


def repeated_runs(rows, length):
    """(doc_id, bytes, maximal runs of bytes covered by a string of ``length`` bytes that also starts elsewhere) of each row."""
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[p : p + length] for _, b in data for p in range(len(b) - length + 1))
    out = []
    for i, b in data:
        covered = [False] * (len(b) + 1)
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                covered[p : p + length] = [True] * length
        edges = [q for q in range(len(b) + 1) if covered[q] != (q > 0 and covered[q - 1])]
        out.append((i, b, list(zip(edges[::2], edges[1::2], strict=True))))
    return out


def without(b, runs):
    return b"".join(b[a:z] for a, z in zip([0, *(z for _, z in runs)], [*(a for a, _ in runs), len(b)], strict=True))


def repeats(rows, length, passage, words):
    """(doc_id, n_bytes, n_removed, n_spans, kept, n_passages, passage_bytes) of each row."""
    out = []
    for (i, b, runs), (_, _, near) in zip(repeated_runs(rows, length), repeated_runs(rows, passage), strict=True):
        own = [z - a for a, z in near if len(b[a:z].split()) >= words]
        out.append((i, len(b), sum(z - a for a, z in runs), len(runs), without(b, runs), len(own), sum(own)))
    return out


def without_passages(rows, length, passage, words):
    """(doc_id, kept bytes) of each row."""
    return [(i, without(b, [(a, z) for a, z in near if z - a >= length or len(b[a:z].split()) >= words])) for i, b, near in repeated_runs(rows, passage)]
