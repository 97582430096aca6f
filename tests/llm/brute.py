"""Plain Python versions of the contracts, for small inputs."""

import hashlib
import re
from collections import Counter
from fractions import Fraction

import xxhash

WHITE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact(docs):
    plain = {i: WHITE.sub(" ", t or "") for i, t in docs}
    groups = {}
    for i, t in plain.items():
        groups.setdefault(t, []).append(i)
    return {(i, min(groups[t]), len(groups[t]), i == min(groups[t]), sha(t)) for i, t in plain.items()}


def simhash(text, n=3):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def components(prints, bits=3):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def contamination(docs, items, n=13):
    windows = {}
    for item, text in items:
        words = PLAIN.findall(lower(text))
        for i in range(max(1, len(words) - n + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = set()
    for i, text in docs:
        words = PLAIN.findall(lower(text))
        hit, found = set(), set()
        for size in sizes:
            for at in range(len(words) - size + 1):
                if own := windows.get(tuple(words[at : at + size])):
                    found |= own
                    hit |= set(range(at, at + size))
        out.add((i, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(words)))
    return out


LICENCES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def licence_base(text):
    words = PLAIN.findall(lower(text))
    places = []
    for phrase, label in LICENCES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({x for _, x in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


SECRETS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def secret_base(text):
    text, out = text or "", []
    for n, (kind, pattern) in enumerate(SECRETS.items()):
        for m in pattern.finditer(text):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                out.append((m.start(), n, f"{kind}:{m.start()}:{m.end()}"))
    counts = [sum(1 for o in out if o[1] == n) for n in range(3)]
    return (*counts, sha(",".join(o[2] for o in sorted(out)))), {o[2] for o in out}


PERSONAL = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def _luhn(digits):
    doubled = [int(d) if n % 2 == 0 else sum(map(int, str(2 * int(d)))) for n, d in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


def personal_base(text):
    out, counts = [], []
    for kind, pattern in PERSONAL.items():
        own = []
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and _luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                own.append(f"{kind}:{m.start()}:{m.end()}")
        out += own
        counts.append(len(own))
    return (*counts, sha(",".join(out))), out


def runs(words):
    """All (start, length, period) by trying every period at every place."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(6, 4 * q):
                block = words[start : start + length]
                if not any(all(block[k] == block[k + p] for k in range(length - p)) for p in range(1, q)):
                    found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periods(docs, rewrite):
    out = set()
    for i, t in docs:
        words = rewrite(i, WORD.findall(t or ""))
        found = runs(words)
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        top = (None,) * 4 if best is None else (best[0], best[1], best[2], 1000 * best[1] // best[2])
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        out.add((i, len(found), *top, sha(lines), sha(collapsed(words, found))))
    return out


def licence_windows(text, licences):
    """Label -> share of the best window, of templates that some window of the text matches."""
    words, out = PLAIN.findall(lower(text)), {}
    for label, template in licences.TEMPLATES:
        target, telling = licences.template_words(template), licences.telling_word(label, template)
        size = licences.WINDOW * len(licences.notice(template))
        for at in (i for i, w in enumerate(words) if w in target):
            held = target & set(words[at : at + size])
            if (telling is None or telling in held) and len(held) / len(target) >= licences.THRESHOLD:
                out[label] = max(out.get(label, 0), len(held) / len(target))
    return out
