"""Brute-force versions that tests hold the operators against."""

import re
from collections import Counter, defaultdict


def shingle_set(text, words):
    own = (text or "").encode().lower().split()
    if not own:
        return frozenset()
    if len(own) < words:
        return frozenset([tuple(own)])
    return frozenset(tuple(own[k : k + words]) for k in range(len(own) - words + 1))


def groups(rows, words, percent):
    """{doc_id: (set size, least doc_id reachable)} over rows of distinct (doc_id, text)."""
    sets = {i: shingle_set(t, words) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for a in sets:
        shared = Counter(b for s in sets[a] for b in holders[s])
        for b, n in shared.items():
            if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
        for s in sets[a]:
            holders[s].append(a)
    return {i: (len(sets[i]), find(i)) for i in sets}


ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    """(kind, start, end) of the fixed patterns, by start and kind."""
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(kind, start, end) for start, _, end, kind in sorted(out)]


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contamination(docs, items):
    """{doc_id: (n_words, n_hit, sorted item ids)}."""
    windows = defaultdict(set)
    for item, text in items:
        own = words_of(text)
        if own:
            size = min(10, len(own))
            for k in range(len(own) - size + 1):
                windows[tuple(own[k : k + size])].add(str(item))
    out = {}
    for doc, text in docs:
        own, hit, found = words_of(text), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(own) - size + 1):
                if (w := tuple(own[k : k + size])) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[w]
        out[doc] = (len(own), len(hit), sorted(found))
    return out


def repeated_words(words):
    seen = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    count, inside = Counter(seen), set()
    for k, w in enumerate(seen):
        if count[w] > 1:
            inside.update(range(k, k + 5))
    return len(inside)
