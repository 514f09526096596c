"""Plain Python versions of the operators' contracts, for small fixtures."""

import hashlib
import re
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = WORD.findall(lower(text))
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k:k + n])].add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w = WORD.findall(lower(text))
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit)))
    return out


def shingles(text):
    w = SPACED.findall(lower(text))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_duplicates(docs, percent=75):
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_secrets(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def base_quality(text):
    text = text or ""
    w = SPACED.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            again += line in seen
            seen.add(line)
    runs = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    count = Counter(runs)
    covered = {p for k, r in enumerate(runs) if count[r] > 1 for p in (k, k + 1, k + 2)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), failed


def repeats(docs, width):
    """By doc_id: bytes, removed, spans, digest of what is kept."""
    seen, out = set(), {}
    for doc, text in sorted(docs, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - width + 1):
            if data[s:s + width] in seen:
                gone[s:s + width] = b"\1" * width
            seen.add(data[s:s + width])
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out
