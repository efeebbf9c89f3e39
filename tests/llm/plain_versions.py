"""The pipeline's stages in plain Python, over lists of (doc_id, text)."""

import math
import re
from collections import Counter, defaultdict

import regex

BLANK = b" \t\n\x0b\x0c\r"
LETTER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def toxicity_score(model, text, tokens=8, chunk=512):
    """Windows of ``tokens`` tokens compressed one by one with each dictionary."""
    raw = (text or "").encode()
    begins = [m.start() for m in re.finditer(rb"[^ \t\n\x0b\x0c\r]+", raw)]
    starts = sorted({0, *begins[tokens::tokens]}) if raw else []
    windows = [raw[a:b][i : i + chunk] for a, b in zip(starts, [*starts[1:], len(raw)][: len(starts)], strict=True) for i in range(0, b - a, chunk)]
    plain, toxic = model.compressors()
    gains = sorted((len(plain.compress(w)) - len(toxic.compress(w)) for w in windows), reverse=True)
    n = max(len(gains), 1)
    seen = [sum(gains[:1]), sum(gains[:2]), sum(gains[:4]), sum(gains) / n, math.log(n), sum(g >= 3 for g in gains) / n, sum(g >= 5 for g in gains) / n]
    if not gains:
        seen = [0.0] * 7
    z = model.weights[0] + sum((x - c) / s * w for x, c, s, w in zip(seen, model.centre, model.spread, model.weights[1:], strict=True))
    return 1 / (1 + math.exp(-min(max(z, -40), 40)))


def drop_lines(rows, shortest=10):
    key = lambda line: lowered(line.strip(" \t\n\v\f\r"))
    owners = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            owners[key(line)].add(d)
    stays = lambda d, line: len(key(line)) < shortest or min(owners[key(line)]) == d
    return [(d, t if t is None else "\n".join(x for x in t.split("\n") if stays(d, x))) for d, t in rows]


def shingles(text, size=5):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", lowered(text or ""))
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1)))


def one_of_each(rows, similarity=0.8):
    found = [shingles(t) for _, t in rows]
    frequency = Counter(x for f in found for x in f)
    vectors = [{x: n * (1 + math.log(len(rows) / frequency[x])) for x, n in f.items()} for f in found]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors[:i]):
            both = sum(min(w, b[x]) for x, w in a.items() if x in b)
            if a and b and both / (sum(a.values()) + sum(b.values()) - both) >= similarity:
                group[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    taken, out = set(), []
    for i, (d, t) in enumerate(rows):
        if not vectors[i]:
            out.append((d, t))
        elif least[root(i)] == d and root(i) not in taken:
            taken.add(root(i))
            out.append((d, t))
    return out


def cut_items(rows, items, window=10):
    known = set()
    for t in items:
        words = re.findall(LETTER + "+", lowered(t or ""))
        k = min(window, len(words))
        known |= {tuple(words[i : i + k]) for i in range(len(words) - k + 1) if k}
    out = []
    for d, t in rows:
        words, hit = re.findall(LETTER + "+", lowered(t or "")), set()
        for k in {len(w) for w in known}:
            for i in range(len(words) - k + 1):
                if tuple(words[i : i + k]) in known:
                    hit |= set(range(i, i + k))
        parts = iter(range(len(words)))
        kept = regex.sub(rf"({LETTER}+)([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)", lambda m: "" if next(parts) in hit else m.group(0), t) if hit else t
        out.append((d, kept))
    return out
