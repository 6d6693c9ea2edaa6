"""Documents with awkward rows, and brute-force versions of the operators."""

import hashlib
import random
import re
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, n string, akey string, kept string"
WORDS = re.compile("[^\x20\x09-\x0d]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeéß日") for _ in range(r.randint(2, 7))) for _ in range(n))


def rows(pairs):
    return [(i, t, "en", "src", None if t is None else len(t), "x", "y", "z", "k") for i, t in pairs]


def awkward(spark):
    """Nulls, empty and long texts, copies, near copies, shared passages,
    repeated rows, one id with two texts, and extra columns whose names the
    operators use themselves."""
    base, passage = prose(1, 300), prose(2, 120)
    near = base.split()
    near[150] = "changed"
    pairs = [(1, base), (2, base), (3, " ".join(near)), (4, prose(3, 90) + " " + passage + " " + prose(4, 60)), (5, passage),
             (6, prose(5, 40) + "\n" + passage + "\t" + prose(6, 10)), (7, None), (8, ""), (9, "  \n "), (10, "one two"), (11, "one two"),
             (12, "One TWO"), (13, prose(7, 20_000)), (14, "ab" * 900), (15, "word " * 400), (16, prose(8, 70)), (16, prose(8, 70)),
             (17, prose(9, 60)), (17, prose(10, 60)), (18, base + " " + base)]
    pairs += [(20 + i, " ".join(w if j != 7 * i % 300 else f"edit{i}" for j, w in enumerate(base.split()))) for i in range(12)]
    return spark.createDataFrame(rows(pairs), SCHEMA), pairs


def with_null_ids(pairs):
    return [*pairs, (None, pairs[0][1]), (None, None)]


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def brute_bytes(pairs, window=400):
    count = Counter()
    raw = [(t or "").encode() for _, t in pairs]
    for b in raw:
        count.update(b[i:i + window] for i in range(len(b) - window + 1))
    out = []
    for (d, _), b in zip(pairs, raw):
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if count[b[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((d, len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def brute_words(pairs, window=50):
    words = [WORDS.findall(t or "") for _, t in pairs]
    first = {}
    for (d, _), w in zip(pairs, words):
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i:i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for (d, _), w in zip(pairs, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if d is not None and first.get(tuple(w[i:i + window]), d) < d:
                gone[i:i + window] = [True] * window
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def shingle_set(text, k=5):
    w = WORDS.findall((text or "").translate(ASCII_LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_groups(pairs, percent=85):
    """Rows ``(doc_id, size, component, kept)``; ids are the nodes."""
    sets = [shingle_set(t) for _, t in pairs]
    up = {d: d for d, _ in pairs if d is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    where = defaultdict(list)
    for k, s in enumerate(sets):
        for h in s:
            where[h].append(k)
    for a, s in enumerate(sets):
        both = Counter(b for h in s for b in where[h] if b > a)
        for b, n in both.items():
            if None not in (pairs[a][0], pairs[b][0]) and 100 * n >= percent * (len(s) + len(sets[b]) - n):
                x, y = top(pairs[a][0]), top(pairs[b][0])
                up[max(x, y)] = min(x, y)
    return [(d, len(s), None if d is None else top(d), d is None or top(d) == d) for (d, _), s in zip(pairs, sets)]


def order(x):
    return sorted(x, key=repr)
