"""Plain-Python counterparts of the operators, for small inputs."""

import collections
import hashlib
import math
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = [("assign", ASSIGN, 1, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = collections.Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    symbols = sum(text.count(c) for c in "#*$%&|<>") if words else 0
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def base_spans(text):
    found = [
        (m.start(), k, m.end(), kind)
        for k, (kind, pattern, group, least) in enumerate(KINDS)
        for m in re.finditer(pattern, text or "")
        if len(m[group]) >= least
    ]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def components(rows, n, percent):
    """{id: (set size, component)} by comparing all sets that share an n-gram."""
    sets = {d: shingles(t, n) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    having = collections.defaultdict(set)
    for d, s in sets.items():
        for x in s:
            having[x].add(d)
    for d, s in sets.items():
        for e in {e for x in s for e in having[x] if e > d}:
            both = len(s & sets[e])
            if 100 * both >= percent * (len(s) + len(sets[e]) - both):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return {d: (len(s), find(d)) for d, s in sets.items()}


def without_boilerplate(rows, spreads):
    """rows of (id, text, site); the cleaned texts in the same order. spreads: (words, share, least, most)."""
    blanks = " \t\n\x0b\x0c\r"
    n_sites = len({site or "" for _, _, site in rows})
    sites, first = collections.defaultdict(set), {}
    for d, text, site in rows:
        for line in (text or "").split("\n"):
            key = line.strip(blanks)
            if key:
                sites[key].add(site or "")
                if d is not None:
                    first[key] = min(d, first.get(key, d))

    def limit(key):
        _, share, least, most = max(s for s in spreads if s[0] <= len(WORD.findall(key)))
        return min(max(least, math.ceil(round(share * n_sites, 6))), most)

    shared = {k for k, s in sites.items() if len(s) >= limit(k) and k in first}
    return [
        None
        if text is None
        else "\n".join(x for x in text.split("\n") if x.strip(blanks) not in shared or first[x.strip(blanks)] == d)
        for d, text, _ in rows
    ]


def word_distance(a, b):
    """Least edit distance of word list a to any part of word list b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def url_rule(host, path, rules):
    fitting = []
    for verdict, rule in rules:
        rule_host, slash, rule_path = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rule_path):
            fitting.append((len(rule), rule, verdict))
    return max(fitting)[1:] if fitting else (None, None)




def simhash(text, words=3):
    found = [w.encode() for w in WORD.findall(text or "")]
    found = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in found]
    grams = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(rows, radius=3):
    """One (id, fingerprint, component) for each of the rows (id, text)."""
    prints = [simhash(t) for _, t in rows]
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in root:
        for b in root:
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    smallest = {}
    for (d, _), p in zip(rows, prints, strict=True):
        if d is not None:
            smallest[find(p)] = min(d, smallest.get(find(p), d))
    return [(d, f"{p:016x}", smallest.get(find(p))) for (d, _), p in zip(rows, prints, strict=True)]


def term_counts(rows):
    """{(lang, source, term): [occurrences, documents]} of rows (lang, source, text)."""
    counts = collections.defaultdict(lambda: [0, 0])
    for lang, source, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        for term, n in collections.Counter(found).items():
            counts[lang or "", source or "", term][0] += n
            counts[lang or "", source or "", term][1] += 1
    return {k: tuple(v) for k, v in counts.items()}
