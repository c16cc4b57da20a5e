"""Plain versions of the corpus operators, and fixtures with awkward rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())
SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall(text or "")


def documents(seed=0, n=60):
    """Rows with shared lines and passages, exact and near copies, nulls, empties and odd white space."""
    rng = random.Random(seed)
    vocab = ["alpha", "Beta", "gamma", "Ünder", "été", "the", "of", "x1", "don't", "日本", "mañana", "delta,", "end."]
    sentence = lambda k: " ".join(rng.choice(vocab) + str(rng.randrange(400)) for _ in range(k))
    shared = [sentence(8) for _ in range(3)]
    passage = sentence(70)
    texts = [None, "", " ", "\n\n", "one two", "Ab\tC\x0bd\x0c\x1ce f", "\x1f", "!!! 123"]
    for i in range(n):
        lines = [sentence(rng.randrange(1, 14)) for _ in range(rng.randrange(1, 6))]
        for s in shared:
            if rng.random() < 0.4:
                lines.insert(rng.randrange(len(lines) + 1), rng.choice(["", " ", "\t"]) + (s.upper() if rng.random() < 0.3 and s.isascii() else s) + rng.choice(["", "  ", "\r"]))
        if rng.random() < 0.25:
            lines.append(passage + " " + sentence(5))
        texts.append("\n".join(lines))
        if i % 6 == 0:
            texts.append(texts[-1])
        if i % 7 == 0:
            texts.append(texts[-1].swapcase() if texts[-1].isascii() else texts[-1].translate(LOWER))
        if i % 5 == 0:
            long = sentence(120).split(" ")
            texts.append(" ".join(long))
            for _ in range(3):
                near = list(long)
                for _ in range(rng.randrange(1, 6)):
                    near[rng.randrange(len(near))] = "changed" + str(rng.randrange(1000))
                texts.append(" ".join(near))
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["b", "a", None, "ä", "z"]), len(t or "")) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def exact(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    return {(i, max(ids), len(ids), i == max(ids), sha(t)) for t, ids in groups.items() for i in ids}


def line_dedup(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            key = line.strip(SPACE).translate(LOWER)
            if len(key) >= min_chars:
                holders[key].add(doc_id)
    out = {}
    for doc_id, text, *_ in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            ids = holders.get(line.strip(SPACE).translate(LOWER), ())
            if len(ids) < min_docs or doc_id == max(ids):
                kept.append(line)
        out[doc_id] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def near(rows, k, per_cent):
    sets = {}
    for doc_id, text, *_ in rows:
        w = words((text or "").translate(LOWER))
        sets[doc_id] = {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= per_cent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def substring(rows, window=50):
    first = {}
    for doc_id, text, *_ in sorted(rows, key=lambda r: r[0]):
        w = words(text)
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), doc_id)
    out = {}
    for doc_id, text, *_ in rows:
        w, gone = words(text), set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < doc_id:
                gone |= set(range(i, i + window))
        out[doc_id] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def base_counts(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def mix_targets(sizes, max_repeats=3):
    """Targets by source, sharing the excess again until none is above its stop."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = {s: weight[s] for s in order if s not in fixed}
        left = total - sum(fixed.values())
        target = {s: left * w / sum(rest.values()) for s, w in rest.items()}
        over = [s for s in target if target[s] > max_repeats * sizes[s]]
        if not over:
            return fixed | target
        fixed |= {s: max_repeats * sizes[s] for s in over}
