"""Plain Python versions of what the operators have to return."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def lower(s: str | None) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s or "")


def secret_base(text: str | None) -> list[tuple[int, int, int, str]]:
    text, found = text or "", []
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                        re.I | re.A)
    for order, (kind, pattern, group, least) in enumerate((
            ("assign", assign, 2, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
            ("hex", re.compile("[0-9a-f]+"), 0, 24))):
        found += [(m.start(), order, m.end(), kind) for m in pattern.finditer(text) if len(m.group(group)) >= least]
    return sorted(found)


def entropy_spans(text: str | None, members: str, least: int, window: int, bits: float, allowed,
                  examples: str) -> list[tuple[int, int]]:
    found = []
    for m in re.finditer(f"[{members}]{{{least},}}", text or ""):
        s, out = m.group(), []
        if any(re.search(a, s) for a in allowed):
            continue
        for i in range(len(s) - window + 1):
            n = Counter(s[i:i + window]).values()
            if -sum(c / window * math.log2(c / window) for c in n) >= bits - 1e-9:
                a, b = m.start() + i, m.start() + i + window
                if out and a <= out[-1][1]:
                    out[-1] = (out[-1][0], b)
                else:
                    out.append((a, b))
        for a, b in out:
            parts = [p for p in re.split("[/_=-]+", text[a:b]) if not re.search(examples, p)]
            if not re.search(examples, text[a:b]) or sum(map(len, parts)) >= least:
                found.append((a, b))
    return found


def repeats(docs: list[tuple], n: int) -> list[tuple]:
    texts = [SPACE.findall(t or "") for _, t in docs]
    seen = Counter(tuple(w[i:i + n]) for w in texts for i in range(len(w) - n + 1))
    out = []
    for (key, _), w in zip(docs, texts):
        gone = {j for i in range(len(w) - n + 1) if seen[tuple(w[i:i + n])] > 1 for j in range(i, i + n)}
        out.append((key, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def shingles(text: str | None, n: int) -> frozenset:
    w = SPACE.findall(lower(text))
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def groups(docs: list[tuple], n: int, percent: int = 80) -> list[tuple]:
    sets = [shingles(t, n) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (key, _) in enumerate(docs):
        ids[find(i)].append(key)
    out = []
    for i, (key, _) in enumerate(docs):
        known = [k for k in ids[find(i)] if k is not None]
        least = min(known) if known else None
        out.append((key, len(sets[i]), least, least is None or key == least))
    return out


def contamination(docs: list[tuple], items: list[tuple], n: int = 10) -> list[tuple]:
    windows = defaultdict(set)
    for key, text in items:
        w = ALNUM.findall(lower(text))
        m = min(n, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows[tuple(w[i:i + m])].add(key)
    sizes = {len(w) for w in windows}
    out = []
    for key, text in docs:
        w, hit, found = ALNUM.findall(lower(text)), set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                if tuple(w[i:i + m]) in windows:
                    hit |= set(range(i, i + m))
                    found |= {str(k) for k in windows[tuple(w[i:i + m])] if k is not None}
        out.append((key, len(w), len(hit), sorted(found)))
    return out


def targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = share * sum(sizes.values()), set()
    while True:
        open_ = sum(weight[s] for s in names if s not in stopped)
        left = total - sum(most * sizes[s] for s in stopped)
        target = {s: most * sizes[s] if s in stopped else left * weight[s] / open_ for s in names}
        above = {s for s in names if s not in stopped and target[s] > most * sizes[s] + 1e-9}
        if not above:
            return target
        stopped |= above
