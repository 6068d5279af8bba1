"""Plain-Python versions of the operators' contracts, for small inputs."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower_az(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(m):
    return re.sub("[^0-9]", "", m[0])


PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(_digits(m)) <= 19 and luhn(_digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(_digits(m)) <= 15),
)
SECRETS = (
    ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                          re.ASCII | re.IGNORECASE), lambda m: len(m[2]) >= 8),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
)


def spans(text, kinds):
    found = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, p, ok) in enumerate(kinds)
             for m in re.finditer(p, text or "") if ok(m)]
    return [s for *_, s in sorted(found)]


def shingles(text, k=5):
    w = words(lower_az(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near(rows, threshold=75):
    """doc_id -> (set size, smallest linked id), over all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def passages(rows, window=13):
    """doc_id -> (words, removed, sha of the kept words): windows that start in a smaller document."""
    seen = {}
    split = [(i, words(t)) for i, t in rows]
    for i, w in split:
        for j in range(len(w) - window + 1):
            k = tuple(w[j:j + window])
            seen[k] = min(seen.get(k, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if seen[tuple(w[j:j + window])] < i:
                gone[j:j + window] = [True] * window
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out)


def byte_strings(rows, length=400, keep_first=False):
    """(doc_id, bytes, removed, runs, sha of the rest): strings that also start elsewhere (or earlier)."""
    raw, seen = sorted((i, (t or "").encode()) for i, t in rows), {}
    for n, (_, b) in enumerate(raw):
        for j in range(len(b) - length + 1):
            seen.setdefault(b[j:j + length], []).append((n, j))
    out = []
    for n, (i, b) in enumerate(raw):
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            at = seen[b[j:j + length]]
            if at[0] < (n, j) if keep_first else len(at) > 1:
                gone[j:j + length] = b"\1" * length
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", gone)), sha(bytes(x for x, g in zip(b, gone) if not g))))
    return sorted(out)
