"""Brute-force versions that several tests use."""

import re
import unicodedata
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_quality_kept(t):
    w = WORD.findall(t)
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    repeated = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    chars, upper = sum(map(len, w)), sum(unicodedata.category(c) == "Lu" for c in t)
    return not (len(w) < 50 or 100 * len(repeated) > 50 * len(w) or 10 * sum(t.count(c) for c in "#*$%&|<>") > len(w)
                or 5 * t.count("!") > len(w) or 100 * upper > 50 * len(t) or chars < 2 * len(w) or chars > 20 * len(w)
                or 2 * (len(lines) - len(set(lines))) > len(lines))


def near_duplicate_classes(texts, n, percent):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(t.translate(low))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    classes = {i: {i} for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and classes[a] is not classes[b]:
                    classes[a] |= classes[b]
                    for x in classes[b]:
                        classes[x] = classes[a]
    return {frozenset(c) for c in classes.values()}
