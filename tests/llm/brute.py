"""Plain single-machine versions of the operators' contracts, for comparison."""

import hashlib
import re
import zlib

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def low(text):
    return (text or "").translate(LOWER)


def quality(text):
    text = text or ""
    words = BLANK.findall(text)
    lines = [x for x in text.split("\n") if BLANK.search(x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = {}
    for g in grams:
        times[g] = times.get(g, 0) + 1
    hit = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), n < 50 or 100 * len(hit) > 50 * n


def shingles(text, k):
    words = BLANK.findall(low(text))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def components(rows, k=4, percent=85):
    """{id: (n_shingles, component)} of (id, text) rows."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_token = {}
    for at, (_, s) in enumerate(sets):
        for t in s:
            by_token.setdefault(t, []).append(at)
    near = {(a, b) for v in by_token.values() for x, a in enumerate(v) for b in v[x + 1 :]}
    for a, b in near:
        (i, s), (j, t) = sets[a], sets[b]
        both = len(s & t)
        if 100 * both >= percent * (len(s) + len(t) - both):
            i, j = sorted((root(i), root(j)))
            parent[j] = i
    return {i: (len(s), root(i)) for i, s in sets}


def decontaminate(docs, items, window=13):
    """{id: (n_words, n_hit, n_items, sha256, contaminated)}."""
    windows = {}
    for item, text in items:
        words = ALNUM.findall(low(text))
        for a in range(max(1, len(words) - window + 1) if words else 0):
            windows.setdefault(tuple(words[a : a + window]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in docs:
        words = ALNUM.findall(low(text))
        hit, found = set(), set()
        for n in sizes:
            for a in range(len(words) - n + 1):
                if (w := tuple(words[a : a + n])) in windows:
                    hit |= set(range(a, a + n))
                    found |= windows[w]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[i] = len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)
    return out


PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))


def licenses(text):
    words = ALNUM.findall(low(text))
    places, labels = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        found = [a for a in range(len(words)) if words[a : a + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def secrets(text):
    """Base spans (kind, start, end), sorted."""
    text = text or ""
    kinds = ("assign", "access", "hex")
    out = [("assign", m.start(), m.end()) for m in re.finditer(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 8]
    out += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], kinds.index(s[0])))


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sized(text):
    data = (text or "").encode()
    return len(data) + 8, zlib.crc32(data)


def host_verdicts(rows, z=3.0, max_odds=4.0, least=0.3):
    """{host: kept} of (text, host) rows."""
    counts = {}
    for text, host in rows:
        n, _, symbols, dup, repeat, _ = quality(text)
        lines = sum(bool(BLANK.search(x)) for x in (text or "").split("\n"))
        bad = [n < 50, 100 * repeat > 50 * n, 100 * symbols > 10 * n, 100 * dup > 30 * max(lines, 1)]
        c = counts.setdefault(host or "", [0] * 6)
        for i, x in enumerate([1, *bad, any(bad)]):
            c[i] += x
    out = dict.fromkeys(counts, True)
    n, k = sum(c[0] for c in counts.values()), len(counts)
    for i in range(1, 6):
        f = sum(c[i] for c in counts.values())
        m = (f + 0.5) / (n + 1)
        scale = n - sum(c[0] ** 2 for c in counts.values()) / n
        between = (sum(c[i] ** 2 / c[0] for c in counts.values()) - f * f / n - (k - 1) * m * (1 - m)) / scale if k > 1 else 0
        for host, c in counts.items():
            if between > 0:
                w = max(2, m * (1 - m) / between - 1)
                r = (c[i] + m * w) / (c[0] + w)
                out[host] &= r - z * (r * (1 - r) / (c[0] + w + 1)) ** 0.5 <= max(least, max_odds * m / (1 - m + max_odds * m))
    return out


def url_tree(pages, p):
    """Shapes whose template is rejected: pages are (host, shape, bad or None, side)."""
    leaves = {}
    for host, shape, bad, side in pages:
        c = leaves.setdefault((host, tuple(shape)), [[0, 0], [0, 0]])
        c[side][0] += bad is not None
        c[side][1] += bad or 0
    every = [sum(c[side][i] for c in leaves.values() for side in (0, 1)) for i in (0, 1)]
    prior = (every[1] + 0.5) / (every[0] + 1)
    rejected = set()

    def smooth(c):
        return (c[1] + prior * p.prior_weight) / (c[0] + p.prior_weight)

    def total(keys, side):
        return [sum(leaves[k][side][i] for k in keys) for i in (0, 1)]

    def judge(keys):
        c = total(keys, 1)
        s = smooth(c)
        if c[0] >= p.min_labels and s - p.reject_z * (s * (1 - s) / (c[0] + p.prior_weight + 1)) ** 0.5 > p.max_odds * prior / (1 - prior + p.max_odds * prior):
            rejected.update(keys)

    def split(keys, level):
        ends = [k for k in keys if len(k[1]) <= level]
        if ends:
            judge(ends)
        kids = {}
        for k in keys:
            if len(k[1]) > level:
                kids.setdefault(k[1][level], []).append(k)
        bins = {}
        for v in kids.values():
            bins.setdefault(min(int(smooth(total(v, 0)) * p.bins), p.bins - 1), []).extend(v)
        groups, at, n, b = {}, 0, 0, 0
        for i in sorted(bins):
            x, y = total(bins[i], 0)
            if n and x:
                q = (b + y + 1) / (n + x + 2)
                if (y / x - b / n) / (q * (1 - q) * (1 / x + 1 / n)) ** 0.5 > p.merge_z:
                    at, n, b = at + 1, 0, 0
            n, b = n + x, b + y
            groups.setdefault(at, []).extend(bins[i])
        for v in groups.values():
            split(v, level + 1)

    for host in {k[0] for k in leaves}:
        split([k for k in leaves if k[0] == host], 0)
    return rejected
