"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    words = [w.translate(LOWER) for w in WORD.findall(text or "")]
    if len(words) >= 5:
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def linked(docs, percent=80):
    """{doc_id: (set size, component)} of (doc_id, text)."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            same = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def without_repeats(docs, length=100):
    """{doc_id: (bytes, removed, spans, hash)} of (doc_id, text)."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            string = data[p : p + length]
            if string in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(string)
        kept = bytes(x for x, g in zip(data, gone) if not g)
        runs = sum(1 for p in range(len(gone)) if gone[p] and not (p and gone[p - 1]))
        out[i] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


PATTERNS = [
    (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    (re.compile(r"[0-9a-f]+"), 0, 24),
]


def secret_spans(text):
    return sorted(
        (m.start(), k, m.end())
        for k, (pattern, group, least) in enumerate(PATTERNS)
        for m in pattern.finditer(text or "")
        if len(m.group(group)) >= least
    )


def statistics(text):
    """(words, word characters, symbols, repeated lines, lines, repeated words, capitals, bangs)."""
    text = text or ""
    words = WORD.findall(text)
    places = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i : i + 3]), []).append(i)
    inside = {i + j for at in places.values() if len(at) > 1 for i in at for j in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(lines),
        len(inside),
        sum("A" <= c <= "Z" for c in text),
        text.count("!"),
    )


def vector(s):
    words, chars = max(s[0], 1), max(s[1], 1)
    return [np.log(chars / words), *np.sqrt([s[2] / chars, s[3] / max(s[4], 1), s[5] / words, s[6] / chars, s[7] / chars])]


def chi2_below(x, degrees, steps=20_000):
    """Share of a chi-square variable below ``x``, by adding up its density."""
    if x <= 0:
        return 0.0
    edges = np.linspace(0, x, steps + 1)
    middle = (edges[1:] + edges[:-1]) / 2
    half = degrees // 2
    density = middle ** (half - 1) * np.exp(-middle / 2) / (2**half * float(np.prod(np.arange(1, half))))
    return float(density.sum() * x / steps)


def chi2_at(share, degrees):
    low, high = 0.0, 200.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_below(middle, degrees) < share else (low, middle)
    return low


def least_determinant(x, floor):
    """(centre, scatter, share) of the half of the rows ``x`` whose scatter, with the floor, has the least determinant."""
    n, dims = x.shape
    scatter = lambda y: (y - y.mean(0)).T @ (y - y.mean(0)) / len(y)
    classes = np.floor(x / (floor / 8))
    q1, q2, q3 = ((np.sort(classes, axis=0)[-(-n * k // 4) - 1] + 0.5) * floor / 8 for k in (1, 2, 3))
    spread = np.maximum((q3 - q1) / 1.349, floor)
    away = (x - q2) / spread
    length = np.maximum((away**2).sum(1), 1e-12)
    turned = (away[:, :, None] * away[:, None, :] / length[:, None, None]).mean(0) * dims * np.outer(spread, spread)
    best = None
    for centre, s in ((x.mean(0), scatter(x)), (q2, np.diag(spread**2)), (q2, turned)):
        least = np.inf
        while True:
            far = np.einsum("ni,ij,nj->n", x - centre, np.linalg.inv(s + np.diag(floor**2)), x - centre)
            where = np.floor(32 * np.log2(far + 1e-9))
            inner = x[where <= np.sort(where)[-(-n // 2) - 1]]
            now = inner.mean(0), scatter(inner)
            value = np.linalg.det(now[1] + np.diag(floor**2))
            if value >= least * (1 - 1e-9):
                break
            least, (centre, s) = value, now
            if best is None or least < best[0]:
                best = least, centre, s, len(inner) / n
    return best[1:]


def outliers(at, groups, floor, parent_rows=100, tail=1e-7):
    """{id: squared robust distance <= cut-off} of {id: vector} and {id: (lang, source)}."""
    floor = np.array(floor)
    members = {}
    for i, v in at.items():
        for depth in range(3):
            members.setdefault(groups[i][:depth], []).append(v)
    dims = len(floor)
    models = {}
    for g in sorted(members, key=len):
        centre, s, share = least_determinant(np.array(members[g]), floor)
        factor = 1.0 if share >= 1 else share / chi2_below(chi2_at(share, dims), dims + 2)
        s = factor * s + np.diag(floor**2)
        if g:
            a, b = models[g[:-1]]
            w = len(members[g]) / (len(members[g]) + parent_rows)
            s = w * s + (1 - w) * b + w * (1 - w) * np.outer(centre - a, centre - a)
            centre = w * centre + (1 - w) * a
        models[g] = centre, s
    half = dims // 2
    low, high = 0.0, 500.0
    for _ in range(80):
        x = (low + high) / 2
        above = np.exp(-x / 2) * sum((x / 2) ** i / float(np.prod(np.arange(1, i + 1))) for i in range(half))
        low, high = (x, high) if above > tail else (low, x)
    out = {}
    for i, v in at.items():
        centre, s = models[groups[i]]
        out[i] = bool((v - centre) @ np.linalg.inv(s) @ (v - centre) <= low)
    return out


def quality(docs, floor, **options):
    """{doc_id: (base_failed, kept)} of (doc_id, text, lang, source)."""
    stats = {i: statistics(t) for i, t, _, _ in docs}
    failed = {i: s[0] < 50 or 100 * s[5] > 50 * s[0] for i, s in stats.items()}
    at = {i: np.array(vector(s)) for i, s in stats.items() if not failed[i]}
    fine = outliers(at, {i: (lang, source) for i, _, lang, source in docs}, floor, **options)
    return {i: (f, fine.get(i, False)) for i, f in failed.items()}


def water_filled(budget, children):
    """{name: share} of {name: (weight, room)}, by raising the level until a child is full, again and again."""
    share = {c: 0 for c in children}
    active = {c for c, (w, _) in children.items() if w > 0}
    while active:
        weights = sum(children[c][0] for c in active)
        full = {c for c in active if children[c][1] * weights <= budget * children[c][0]}
        if not full:
            for c in active:
                share[c] = budget * children[c][0] // weights
            break
        c = min(full, key=lambda c: (children[c][1] / children[c][0], c))
        share[c] = children[c][1]
        budget -= children[c][1]
        active.remove(c)
    return share


def mixed(docs, weights, share, epochs, seed=0):
    """Sorted (doc_id, epoch) of (doc_id, text, path of three levels)."""
    tokens = {i: len(WORD.findall(t or "")) for i, t, _ in docs}
    supply = {}
    for i, _, path in docs:
        for depth in range(1, 4):
            supply[path[:depth]] = supply.get(path[:depth], 0) + tokens[i]
    budgets = {(): int(sum(tokens.values()) * share)}
    for depth in range(1, 4):
        for parent in [p for p in budgets if len(p) == depth - 1]:
            children = {p: (weights[depth - 1].get(p[-1], 1), n * epochs) for p, n in supply.items() if len(p) == depth and p[:-1] == parent}
            budgets |= water_filled(budgets[parent], children)
    out = []
    for leaf in [p for p in budgets if len(p) == 3]:
        own = [i for i, _, path in docs if path == leaf]
        whole = budgets[leaf] // supply[leaf] if supply[leaf] else 0
        out += [(i, e) for i in own for e in range(whole)]
        rest = budgets[leaf] - whole * supply[leaf]
        if rest > 0:
            for i in sorted(own, key=lambda i: hashlib.md5(f"{seed}:{whole}:{i}".encode()).hexdigest()):
                rest -= tokens[i]
                if rest < 0:
                    break
                out.append((i, whole))
    return sorted(out)


def best_fit(items, capacity):
    """(bin, offset) of (size, source, cluster): of all bins with room, the tightest that is compatible."""
    bins, out = [], []
    for size, source, cluster in items:
        fits = [
            (room, b)
            for b, (room, sources, clusters) in enumerate(bins)
            if room >= size and not (source is not None and source in sources) and not (cluster is not None and cluster in clusters)
        ]
        if fits:
            b = min(fits)[1]
        else:
            bins.append([capacity, set(), set()])
            b = len(bins) - 1
        out.append((b, capacity - bins[b][0]))
        bins[b][0] -= size
        bins[b][1].add(source)
        bins[b][2].add(cluster)
    return out


def merged_tokens(data, merges):
    """Symbols left after merging the lowest-ranked pair, leftmost first, until none is left."""
    symbols = list(data)
    while True:
        found = [(merges[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in merges]
        if not found:
            return len(symbols)
        _, i = min(found)
        symbols[i : i + 2] = [merges[symbols[i], symbols[i + 1]][1]]


