"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingle_set(text, words):
    found = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(found[k : k + words]) for k in range(max(1, len(found) - words + 1))) if found else frozenset()


def components(texts, words, percent):
    """Per row number: set size and the row numbers that hang together with it."""
    sets = [shingle_set(t, words) for t in texts]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i in range(len(sets)):
        groups[find(i)].append(i)
    return [(len(sets[i]), groups[find(i)]) for i in range(len(sets))]


def uncovered(data, starts, length):
    change = np.zeros(len(data) + 1, int)
    for s in starts:
        change[s] += 1
        change[s + length] -= 1
    return np.cumsum(change[:-1]) > 0


def repeats(texts, length):
    """Per text: bytes, removed bytes, spans and the digest of the rest."""
    seen, out = collections.Counter(), []
    texts = [(t or "").encode() for t in texts]
    for b in texts:
        seen.update(b[k : k + length] for k in range(len(b) - length + 1))
    for b in texts:
        gone = uncovered(b, [k for k in range(len(b) - length + 1) if seen[b[k : k + length]] > 1], length)
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0]) if len(gone) else 0
        rest = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return out


def first_kept(rows, length):
    """Texts by doc_id after repeats went from every place but the first; rows are (doc_id, text)."""
    first, owner = {}, {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        if len(b) >= length:
            if t in owner:
                continue
            owner[t] = i
        for k in range(len(b) - length + 1):
            first.setdefault(b[k : k + length], (i, k))
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        if len(b) >= length and owner[t] != i:
            out[i] = ""
            continue
        gone = uncovered(b, [k for k in range(len(b) - length + 1) if first[b[k : k + length]] != (i, k)], length)
        out[i] = t if not gone.any() else np.frombuffer(b, np.uint8)[~gone].tobytes().decode(errors="ignore")
    return out


def sentences(text):
    out, now = [], []
    found = list(WORD.finditer(text))
    for k, m in enumerate(found):
        now.append(m)
        after = found[k + 1] if k + 1 < len(found) else None
        if after is None or m.group()[-1] in ".!?" or "\n" in text[m.end() : after.start()]:
            out.append(now)
            now = []
    return out


def without_spans(rows, words=20, long=40):
    """Per doc_id: sentences, removed sentences and the text that stays; rows are (doc_id, text)."""
    cut, first, spans = {i: sentences(t or "") for i, t in rows}, {}, []
    for i in sorted(cut):
        s = cut[i]
        for a in range(len(s)):
            b = a if len(s[a]) >= long else a + 1
            while b > a and b < len(s) and sum(len(x) for x in s[a : b + 1]) < words:
                b += 1
            if b < len(s):
                key = tuple(m.group().translate(LOWER) for x in s[a : b + 1] for m in x)
                first.setdefault(key, (i, a))
                spans.append((key, i, a, b))
    gone = collections.defaultdict(set)
    for key, i, a, b in spans:
        if first[key] != (i, a):
            gone[i] |= set(range(a, b + 1))
    out = {}
    for i, t in rows:
        cuts = [x[0].start() for x in cut[i]] + [len(t or "")]
        cuts[0] = 0 if cut[i] else cuts[0]
        kept = "".join((t or "")[cuts[k] : cuts[k + 1]] for k in range(len(cut[i])) if k not in gone[i])
        out[i] = (len(cut[i]), len(gone[i]), kept if gone[i] else t)
    return out
