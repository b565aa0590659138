"""Plain versions of the operators, to compare with."""

import hashlib
import re
from collections import defaultdict


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def contamination(docs, items, window=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        w = word.findall(low(text))
        for k in range(max(1, len(w) - window + 1) if w and item is not None else 0):
            windows[tuple(w[k:k + window])].add(item)
    out = []
    for doc, text in docs:
        w, hit, found = word.findall(low(text)), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[tuple(w[s:s + n])]
        ids = ",".join(sorted(map(str, found)))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def near_duplicates(docs, size, percent=80):
    sets = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(text))
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, (a, _) in enumerate(docs):
        for j in range(i):
            if a is None or docs[j][0] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if a == docs[j][0] or 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    smallest = {}
    for i, (a, _) in enumerate(docs):
        if a is not None and sets[i]:
            smallest[root(i)] = min(smallest.get(root(i), a), a)
    out = []
    for i, (a, _) in enumerate(docs):
        comp = a if not sets[i] or a is None else smallest[root(i)]
        out.append((a, len(sets[i]), comp, a is None or a == comp))
    return out
