"""Plain reference versions the operators are tested against."""
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, words):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return frozenset()
    if len(w) < words:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + words]) for i in range(len(w) - words + 1))


def near_components(rows, words, percent):
    """{doc_id: (n_shingles, component_id)} by comparing every pair that shares a shingle."""
    sets = {i: shingles(t, words) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(x, y):
        x, y = find(x), find(y)
        parent[max(x, y)] = min(x, y)

    first = {}
    for i, s in sorted(sets.items()):
        if s:
            union(first.setdefault(s, i), i)
    inverted = defaultdict(list)
    for s, i in first.items():
        for x in s:
            inverted[x].append(i)
    for i in sorted(first.values()):
        common = defaultdict(int)
        for x in sets[i]:
            for j in inverted[x]:
                if j < i:
                    common[j] += 1
        for j, m in common.items():
            if 100 * m >= percent * (len(sets[i]) + len(sets[j]) - m):
                union(i, j)
    return {i: (len(s), find(i)) for i, s in sets.items()}


ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
                    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    """(start, kind number, kind, end) of the base kinds, in order."""
    text, out = text or "", []
    out += [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out)
