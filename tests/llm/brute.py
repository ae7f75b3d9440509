"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re


def words(text, low=True):
    text = text or ""
    if low:
        text = text.translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text, k):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def linked(x, y, percent):
    shared = len(x & y)
    return bool(x and y) and 100 * shared >= percent * (len(x) + len(y) - shared)


def groups(n, pairs):
    """Component number of each of n nodes."""
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in pairs:
        parent[find(a)] = find(b)
    return [find(a) for a in range(n)]


def copied_lines(rows, min_words):
    """{(id, sequence number, text): text without later copies} of (id, sequence number, text) rows."""
    docs = sorted({r for r in rows if r[2] is not None})
    lines = [t.split("\n") for _, _, t in docs]
    n_words = [[len(x.split()) for x in doc] for doc in lines]
    spots = [(d, p) for d in range(len(lines)) for p in range(len(lines[d]))]
    gone = [set() for _ in lines]
    for i, (d, p) in enumerate(spots):
        best = 0
        for e, q in spots[:i]:
            n = 0
            while p + n < len(lines[d]) and q + n < len(lines[e]) and lines[d][p + n] == lines[e][q + n]:
                n += 1
            best = max(best, n)
        if sum(n_words[d][p:p + best]) >= min_words:
            gone[d].update(range(p, p + best))
    return {doc: "\n".join(x for i, x in enumerate(own) if i not in gone[d])
            for d, (doc, own) in enumerate(zip(docs, lines))}


def poisson_copies(seed, doc_id, mean):
    u = int(hashlib.md5(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) / 2**52
    k, p = 0, math.exp(-mean)
    below = p
    while u >= below:
        k += 1
        p *= mean / k
        below += p
    return k


def rates(rows, weights, default, budget=1.0):
    """{source: mean copies} of (source, text) rows."""
    chars = {}
    for source, text in rows:
        chars[source] = chars.get(source, 0) + len(text or "")
    total = sum(chars.values())
    weight = {s: weights.get(s, default) for s, c in chars.items() if c}
    return {s: budget * total * weight[s] / sum(weight.values()) / c if c else 1.0 for s, c in chars.items()}


def best_fit(lengths, capacities, cost):
    """Room left in each bin when pieces are placed one by one: longest first, into an
    open bin with the least room, else a new bin of the least cost per word."""
    sizes, bins = sorted(capacities), []
    items = sorted(lengths, reverse=True)
    for i, length in enumerate(items):
        fitting = [b for b in bins if b[0] >= length]
        if fitting:
            b = min(fitting, key=lambda b: b[0])
        else:
            left = items.count(length) - (i - items.index(length))
            shorter = sum(x for x in items if x < length)

            def per_word(c):
                n = min(c // length, left)
                return cost(c) / (length * n + min(c - length * n, shorter))

            b = [min((c for c in sizes if c >= length), key=lambda c: (per_word(c), c)), []]
            bins.append(b)
        b[0] -= length
        b[1].append(length)
    return sorted(room for room, _ in bins)
