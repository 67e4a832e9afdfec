"""Plain Python versions of the operators, for small tables."""

import re
import unicodedata
from collections import Counter
from hashlib import sha256
from math import log2, sqrt

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def digest(text):
    return sha256(text.encode()).hexdigest()


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def near(docs, shingle=5, threshold=75):
    sets = {}
    for i, t in docs:
        w = words((t or "").translate(LOWER))
        sets[i] = {tuple(w)} if 0 < len(w) < shingle else {tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)}
    u = Union(sets)
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= threshold * len(sets[a] | sets[b]):
                u.link(a, b)
    return {i: (len(s), u.find(i), u.find(i) == i) for i, s in sets.items()}


def repeats(docs, window):
    seen, out = {}, {}
    for i, t in sorted(docs):
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen.setdefault(tuple(w[k : k + window]), i) < i:
                gone[k : k + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out[i] = (len(w), sum(gone), digest(" ".join(kept)))
    return out


def removed_lines(docs, shingle=9, threshold=75):
    """Of linked lines all but the first; a line's set has a shingle from every character on."""
    places, sets = [], {}
    for i, t in sorted((i, t or "") for i, t in docs):
        for k, line in enumerate(t.split("\n")):
            body = re.sub(r"[ \t\n\x0b\f\r]+", " ", line.lower()).strip(" ")
            if body:
                places.append((i, k, body))
                sets[body] = {body[j : j + shingle] for j in range(max(len(body) - shingle + 1, 1))}
    u = Union(sets)
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                u.link(a, b)
    first, out = {}, {}
    for i, k, body in places:
        if first.setdefault(u.find(body), (i, k)) != (i, k):
            out.setdefault(i, []).append(k)
    return out


def base_counts(text):
    w = words(text)
    runs = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    count, inside = Counter(runs), [False] * len(w)
    for k, r in enumerate(runs):
        if count[r] > 1:
            inside[k : k + 5] = [True] * 5
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * sum(inside) > 20 * len(w)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), sum(inside), failed


def js_distance(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    parts = [(x * log2(2 * x / (x + y)) if x else 0) + (y * log2(2 * y / (x + y)) if y else 0) for x, y in zip(p, q, strict=True)]
    return sqrt(max(0.0, sum(parts) / 2))


def character_class(c):
    if c in "#*$%&|<>":
        return "symbol"
    if c in " \t\n\x0b\f\r":
        return "space"
    kind = unicodedata.category(c)
    return {"Lu": "upper", "Nd": "digit"}.get(kind, "mark" if kind[0] in "PS" else "other")


def verdicts(rows, common_share=0.004, most_class=0.29, most_word=0.42):
    """(kept, class distance, word distance) of (id, text, lang)."""
    classes, counts, out = {}, {}, {}
    for _, text, lang in rows:
        classes.setdefault(lang, Counter()).update(map(character_class, text))
        counts.setdefault(lang, Counter()).update(words(text))
    for i, text, lang in rows:
        own, total = Counter(words(text)), sum(counts[lang].values())
        common = {w: n for w, n in counts[lang].items() if n >= common_share * total}
        order, found = sorted(classes[lang]), Counter(map(character_class, text))
        by_class = js_distance([found[c] for c in order], [classes[lang][c] for c in order]) if len(text) >= 100 else None
        by_word = None
        if sum(own.values()) >= 50:
            met = [w for w in own if w in common]
            rest = total - sum(common.values())
            p = [own[w] for w in met] + [sum(n for w, n in own.items() if w not in common), 0]
            by_word = js_distance(p, [common[w] for w in met] + [rest, sum(n for w, n in common.items() if w not in met)])
        kept = not base_counts(text)[-1] and (by_class or 0) <= most_class and (by_word or 0) <= most_word
        out[i] = (kept, by_class, by_word)
    return out


def shared_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    stopped = set()
    while True:
        free = [s for s in order if s not in stopped]
        rest = sum(sizes.values()) - sum(most * sizes[s] for s in stopped)
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s] + 1e-9}
        if not over:
            return {s: share.get(s, most * sizes[s]) for s in order}
        stopped |= over
