"""Plain Python versions of the training-data operators, for comparison on small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
BASE = [("assign", ASSIGN, 2, 8), ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile(r"[0-9a-f]+"), 0, 32)]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def secrets(text):
    """n_assign, n_access, n_hex, base_sha256 of one text."""
    spans = []
    for number, (kind, pattern, group, least) in enumerate(BASE):
        spans += [(m.start(), number, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text or "") if len(m[group]) >= least]
    counts = Counter(s[1] for s in spans)
    return counts[0], counts[1], counts[2], sha(",".join(s[2] for s in sorted(spans)))


def rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(3)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def targets(sizes, weights=(1, 2, 3), cap=3):
    """Target of every source by sharing out again and again; sizes: source to words."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target, free = sum(sizes.values()), dict.fromkeys(order, 0.0), set(order)
    left = float(total)
    while left > 1e-9 and free:
        share = left / sum(weight[s] for s in free)
        for s in free:
            target[s] += share * weight[s]
        over = {s for s in free if target[s] >= cap * sizes[s] - 1e-9}
        left = sum(target[s] - cap * sizes[s] for s in over)
        for s in over:
            target[s] = float(cap * sizes[s])
        free -= over
    return target


def simhash(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(links, nodes):
    """Smallest member of the component of every node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def ranked(docs, items, k=10):
    """(place of the item, rank, doc_id, score); docs: (doc_id, text) rows, items: texts."""
    counts = [(d, Counter(TERM.findall(ascii_lower(t)))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for place, text in enumerate(items):
        found = []
        for d, c, n in counts:
            score = 0
            for t in set(TERM.findall(ascii_lower(text))) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * (10 + 90 * n * n_docs // n_terms)))
            if score > 0:
                found.append((-score, d is None, d or 0))
        for rank, (score, none, d) in enumerate(sorted(found)[:k], 1):
            out.append((place, rank, None if none else d, -score))
    return out


def collocations(rows, least, top):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", ascii_lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for size in range(1, 6):
                f[lang or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            inside = any(
                len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in candidates.items()
            )
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)
