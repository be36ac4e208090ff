"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\\x20\\x09-\\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def base_quality(text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i:i + 5])].append(i)
    covered = {p for v in at.values() if len(v) > 1 for i in v for p in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), dup, len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def targets(sizes, share=1.5, weights=(5, 2, 1), most=2):
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, rest, out = share * sum(sizes.values()), set(names), {}
    while rest:
        total = sum(w[s] for s in rest)
        over = [s for s in rest if left * w[s] / total > most * sizes[s]]
        if not over:
            out.update({s: left * w[s] / total for s in rest})
            break
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
            rest.discard(s)
    return out


def shingles(text):
    w = words((text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def components(texts):
    """{id: (set size, smallest id reachable)} of {id: text}."""
    sets = {d: shingles(t) for d, t in texts.items()}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                a2, b2 = find(a), find(b)
                parent[max(a2, b2)] = min(a2, b2)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def plain_words(text):
    return re.findall("(?:[0-9a-z]|[^\\x00-\\x7f])+", (text or "").lower())


def overlaps(text, item, least=10, miss=2):
    """Equal words of the best stretch of two word lists side by side."""
    best = 0
    for shift in range(-len(item) + 1, len(text)):
        score = equal = 0
        top = 0
        for k in range(max(0, shift), min(len(text), shift + len(item))):
            same = text[k] == item[k - shift]
            score, equal = score + (1 if same else -miss), equal + same
            if score <= 0:
                score = equal = 0
            if score > top:
                top, best = score, max(best, equal)
    return best


def base_spans(text):
    text, found = text or "", []
    either = lambda s: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in s)
    names = "|".join([*map(either, ("password", "passwd", "secret", "token")), either("api") + "_?" + either("key")])
    for m in re.finditer("(?:" + names + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[1]) >= 12:
            found.append((m.start(), 0, m.end(), "assign"))
    for k, kind, pattern, least in ((1, "access", "AKIA[A-Z0-9]+", 18), (2, "hex", "[0-9a-f]+", 16)):
        found += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(found)


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def count(values):
    return Counter(values)
