"""Plain versions of the operators for small tables."""

import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\r\n\v\f"


def lines(text):
    return [x for x in re.split(r"(?<=\n)", text) if x]


def sentences(text):
    return [x for x in re.split(r"(?<=\n)|(?<=[.!?][ \t\r\v\f])", text) if x]


def sentence_runs(words, span=2, least=20):
    """From every sentence on the shortest run of enough sentences and words."""
    found = []
    for i in range(len(words)):
        for e in range(i + span, len(words) + 1):
            if sum(words[i:e]) >= least:
                found.append((i, e))
                break
    return found


def dedup_maximal(docs, least=8):
    """{(id, text): text without lines of repeated runs}, by the maximal common runs of every two places, without windows or hashes."""
    cut = {}
    for i, t in set(docs):
        parts = lines(t or "")
        cut[i, t] = [x.strip(SPACE) for x in parts], [len(WORD.findall(x)) for x in parts], parts
    order = lambda i: 1 << 63 if i is None else i
    out = {}
    for (i, t), (keys, words, parts) in cut.items():
        gone = set()
        for (j, u), (others, _, _) in cut.items():
            if order(j) > order(i) or (order(j) == order(i) and u != t):
                continue
            for a in range(len(keys)):
                for b in range(len(others) if (i, t) != (j, u) else a):
                    if keys[a] != others[b] or (a and b and keys[a - 1] == others[b - 1]):
                        continue
                    n = 0
                    while a + n < len(keys) and b + n < len(others) and keys[a + n] == others[b + n]:
                        n += 1
                    if sum(words[a : a + n]) >= least:
                        gone |= set(range(a, a + n))
        left = "".join(x for k, x in enumerate(parts) if k not in gone)
        out[i, t] = t if not t else left.rstrip(SPACE) if len(parts) - 1 in gone else left
    return out


def dedup(docs, split, runs):
    """{(id, text): text without repeated runs}; docs: (id, text) pairs."""
    seen, out = {}, {}
    for i, t in sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0)):
        if not t:
            out[i, t] = t
            continue
        parts = split(t)
        keys, words = [x.strip(SPACE) for x in parts], [len(WORD.findall(x)) for x in parts]
        gone, own = set(), {}
        order = 1 << 63 if i is None else i
        for s, e in runs(words):
            k = tuple(keys[s:e])
            if seen.get(k, order) < order or own.get(k, s) < s:
                gone |= set(range(s, e))
            own.setdefault(k, s)
        for k in own:
            seen[k] = min(seen.get(k, order), order)
        left = "".join(x for j, x in enumerate(parts) if j not in gone)
        out[i, t] = left.rstrip(SPACE) if len(parts) - 1 in gone else left
    return out


def shingles(text, n=5):
    words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def components(docs, percent=75):
    """The component of each row, by row number; docs: (id, text) pairs."""
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))
    changed = True
    pairs = [(i, j) for i in range(len(docs)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in pairs:
            if label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    out = []
    for k, (i, _) in enumerate(docs):
        ids = [docs[m][0] for m in range(len(docs)) if label[m] == label[k] and docs[m][0] is not None] if sets[k] else [i]
        out.append((len(sets[k]), min(ids) if ids else None))
    return out


def folded(text):
    return re.sub(f"[{SPACE}]+", " ", re.sub("[A-ZÀ-ÖØ-Þ]", lambda m: m[0].lower(), text))


def distance_in(piece, text):
    """Least edits of the piece against any part of the text, both as bytes."""
    chars, place = np.frombuffer(text, np.uint8), np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, int)
    for i, c in enumerate(piece, 1):
        below = np.minimum(row[:-1] + (chars != c), row[1:] + 1)
        row = np.minimum.accumulate(np.append(i, below) - place) + place
    return int(row.min())
