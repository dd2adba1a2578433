"""The operators' results by direct, slow Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
A_TO_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def words(text):
    return WORD.findall(text or "")


def repeated_words(rows, size=20):
    """op2: rows of (doc_id, text); equal rows are one document."""
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0])):
        found = words(text)
        gone = [False] * len(found)
        for i in range(len(found) - size + 1):
            window = tuple(found[i: i + size])
            if window in seen:
                gone[i: i + size] = [True] * size
            seen.add(window)
        kept = " ".join(w for w, g in zip(found, gone) if not g)
        out[doc_id, text] = (doc_id, len(found), sum(gone), sha(kept.encode()))
    return sorted((out[r] for r in rows), key=repr)


def without_repeated_bytes(texts, size=200):
    """For each text its bytes and the flags of those to remove."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i: i + size] for d in data for i in range(len(d) - size + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - size + 1):
            if count[d[i: i + size]] > 1:
                gone[i: i + size] = b"\1" * size
        out.append((d, bytes(gone)))
    return out


def repeated_bytes(rows, size=200):
    """op7."""
    out = []
    for (doc_id, _), (d, gone) in zip(rows, without_repeated_bytes([t for _, t in rows], size)):
        left = bytes(x for x, g in zip(d, gone) if not g)
        out.append((doc_id, len(d), sum(gone), len(re.findall(b"\1+", gone)), sha(left)))
    return sorted(out, key=repr)


def shingles(text, gram=4):
    found = words((text or "").translate(A_TO_Z))
    if len(found) < gram:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i: i + gram]) for i in range(len(found) - gram + 1))


def linked(rows, gram=4, percent=85):
    """op10: set sizes, and for each row the index of its group."""
    sets = [shingles(t, gram) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    places = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            places[g].append(i)
    for i, s in enumerate(sets):
        both = Counter(j for g in s for j in places[g] if j < i)
        for j, n in both.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                group[find(i)] = find(j)
    return sets, [find(i) for i in range(len(rows))]


def components(rows, gram=4, percent=85):
    sets, group = linked(rows, gram, percent)
    least = defaultdict(lambda: None)
    for (doc_id, _), g in zip(rows, group):
        if doc_id is not None and (least[g] is None or doc_id < least[g]):
            least[g] = doc_id
    return sorted(((d, len(s), least[g]) for (d, _), s, g in zip(rows, sets, group)), key=repr)
