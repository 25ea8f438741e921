"""Plain-Python readings of the rules, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, width=5):
    words = WORD.findall(lowered(text or ""))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def similar(docs, num=80, den=100):
    """{doc_id: (set size, component)} by comparing all pairs."""
    sets = {i: shingles(t) for i, t in docs.items()}
    ids = sorted(sets)
    where = {}
    for i in ids:
        for s in sets[i]:
            where.setdefault(s, []).append(i)
    shared = {}
    for owners in where.values():
        for x, a in enumerate(owners):
            for b in owners[x + 1:]:
                shared[a, b] = shared.get((a, b), 0) + 1
    links = [(a, b) for (a, b), n in shared.items() if den * n >= num * (len(sets[a]) + len(sets[b]) - n)]
    part = components(ids, links)
    return {i: (len(sets[i]), part[i]) for i in ids}
