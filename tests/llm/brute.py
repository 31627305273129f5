"""Plain versions of the operators, over small tables."""

import hashlib
import re
import zlib

import numpy as np
import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, distance=3):
    """Label per value: the smallest position reachable."""
    u, inv = np.unique(np.array(values, np.uint64), return_inverse=True)
    near = [np.flatnonzero(np.bitwise_count(u ^ x) <= distance) for x in u]
    label = np.arange(len(u))
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return label[inv]
        label = new


def spans(text, kinds):
    found = []
    for k, (name, pattern, good) in enumerate(kinds):
        found += [(m.start(), k, m.end(), name) for m in re.finditer(pattern, text or "") if good(m)]
    return sorted(found)


def digest(found):
    return hashlib.sha256(",".join(f"{n}:{a}:{b}" for a, _, b, n in found).encode()).hexdigest()


def _luhn(text):
    d = [int(c) for c in re.sub("[^0-9]", "", text)][::-1]
    return 14 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


PERSONAL = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", "[0-9]([\x20-]?[0-9])+", lambda m: _luhn(m[0])),
    ("phone", "\\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15),
]


def _either(word):
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


SECRET = [
    ("assign", "(" + "|".join(map(_either, ("password", "passwd", "secret", "token"))) + "|" + _either("api") + "_?"
     + _either("key") + ")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 12),
    ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 16),
]


def held(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def chunks(text, divisor=4):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    ends = [False] + [(a * 1_000_003 + b) % divisor == 0 for a, b in zip(h, h[1:])]
    out, at = [], 0
    for i in range(len(lines)):
        if i == len(lines) - 1 or ends[i] and not ends[i - 1] and i < len(lines) - 2:
            out.append((at, i - at + 1, "\n".join(lines[at:i + 1])))
            at = i + 1
    return out


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]
