"""Plain definitions of the operators' results, for small inputs."""

import hashlib
from collections import Counter

import xxhash

WS = " \t\n\x0b\x0c\r"
UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def classes(n, linked):
    """Smallest index of the class of each of n items."""
    root = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if linked(i, j) and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


def covered(texts, length):
    """Per text the set of byte positions within a string that starts twice."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    return [{k for i in range(len(d) - length + 1) if seen[d[i:i + length]] > 1 for k in range(i, i + length)}
            for d in data]


def suffix_row(text, gone):
    d = (text or "").encode()
    kept = bytes(b for i, b in enumerate(d) if i not in gone)
    return len(d), len(gone), sum(1 for i in gone if i - 1 not in gone), kept


def simhash(text, k=4):
    words = "".join(LOW[UP.index(c)] if c in UP else c for c in (text or ""))
    for c in WS:
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def repeat_words(words, n=5):
    win = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
    many = Counter(win)
    return len({i + k for i, w in enumerate(win) if many[w] > 1 for k in range(n)})
