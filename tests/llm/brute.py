"""Plain single-machine versions of the operators that SQL can't express."""

import re

import numpy as np


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_documents(docs):
    """{doc_id: (n_shingles, component_id)} of {doc_id: text}."""
    sets = {d: shingles(t) for d, t in docs.items()}
    by_shingle = {}
    for d, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(d)
    common = {}
    for group in by_shingle.values():
        for i, a in enumerate(group):
            for b in group[i + 1 :]:
                common[a, b] = common.get((a, b), 0) + 1
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    found = components(docs, links)
    return {d: (len(sets[d]), found[d]) for d in docs}


def near_vectors(rows, cosine=0.93):
    """{vec_id: (n_links, component_id)} of rows (vec_id, vector, label)."""
    good = {}
    for key, vector, label in rows:
        if vector is not None and label is not None and all(x is not None for x in vector):
            v = np.array(vector, float)
            if len(v) and np.isfinite(v).all() and v.any():
                good[key] = (v / np.linalg.norm(v), label)
    links, degree = [], {r[0]: 0 for r in rows}
    keys = list(good)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0]) and good[a][0] @ good[b][0] >= cosine:
                links.append((a, b))
                degree[a] += 1
                degree[b] += 1
    found = components([r[0] for r in rows], links)
    return {k: (degree[k], found[k]) for k in degree}


def without_repeats(docs, k=50):
    """Sorted (doc_id, n_bytes, n_removed, n_spans, kept_sha256) of pairs (doc_id, text)."""
    import hashlib

    least = {}
    for d, text in docs:
        data = (text or "").encode()
        for i in range(len(data) - k + 1):
            s = data[i : i + k]
            least[s] = min(least.get(s, d), d)
    out = []
    for d, text in docs:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - k + 1):
            if least[data[i : i + k]] < d:
                gone[i : i + k] = True
        gone = gone[: len(data)]
        kept = bytes(b for b, g in zip(data, gone.tolist()) if not g)
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((d, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)
