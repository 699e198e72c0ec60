"""Plain computations that the operators are held against."""

import re

from plumbline.llm.linedup import chunks_of

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def smallest(nodes, links):
    """Smallest reachable node of each node."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))} if words else set()


def brute_links(rows, percent=75):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    return [
        (a, b)
        for x, (a, s) in enumerate(sets)
        for b, t in sets[:x]
        if s and t and 100 * len(s & t) >= percent * len(s | t)
    ]


def brute_contamination(docs, items, n=10):
    out = {}
    cut = [(i, WORD.findall(plain(t))) for i, t in items]
    windows = {(tuple(w[a : a + min(n, len(w))]), i) for i, w in cut if w for a in range(max(len(w) - n, 0) + 1)}
    for i, t in docs:
        words, hit, names = WORD.findall(plain(t)), set(), set()
        for window, item in windows:
            for a in range(len(words) - len(window) + 1):
                if tuple(words[a : a + len(window)]) == window:
                    hit |= set(range(a, a + len(window)))
                    names.add(item)
        out[i] = (len(words), len(hit), len(names))
    return out


def brute_lines(docs, least=50):
    """What stays of each text when runs of chunks that occur earlier are taken out."""
    first, out = {}, {}
    for i, t in sorted(docs):
        if not t:
            out[i] = t
            continue
        parts, _, words = chunks_of(t.encode())
        later = [first.setdefault(p, (i, k)) != (i, k) for k, p in enumerate(parts)]
        keep, k = [], 0
        while k < len(parts):
            end = k
            while end < len(parts) and later[end]:
                end += 1
            if end > k and sum(words[k:end]) >= least:
                k = end
            else:
                keep.append(parts[k])
                k += 1
        out[i] = b"\n".join(keep).decode()
    return out
