"""Plain Python versions of the corpus operators, for comparison."""

import collections
import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def joined(spans, kinds):
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(spans))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    count = collections.Counter(k for _, k, _ in out)
    return (*[count[k] for k in range(4)], sha(joined(out, ["email", "ip", "card", "phone"])))


def secrets(text):
    text, out = text or "", []
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text, re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 24:
            out.append((m.start(), 2, m.end()))
    count = collections.Counter(k for _, k, _ in out)
    return (*[count[k] for k in range(3)], sha(joined(out, ["assign", "access", "hex"])))


def quality(text):
    text = text or ""
    w = WORD.findall(text)
    count = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    again = set()
    for i in range(len(w) - 7):
        if count[tuple(w[i:i + 8])] > 1:
            again.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again),
            len(w) < 20 or 100 * len(again) > 30 * len(w))


def shingles(text, k=5):
    w = WORD.findall(lower(text))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def near(docs, percent=85):
    """[(id, text)] -> {id: (size, component)}; ids unique."""
    sets = {d: shingles(t) for d, t in docs}
    where, shared = collections.defaultdict(list), collections.Counter()
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    for ds in where.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1:]:
                shared[min(a, b), max(a, b)] += 1
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def repeats(docs, length=13):
    """[(id, text)] -> [(id, words, removed, sha)] in the order given; ids not NULL."""
    first = {}
    for d, t in docs:
        w = WORD.findall(t or "")
        for i in range(len(w) - length + 1):
            key = tuple(w[i:i + length])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t in docs:
        w, gone = WORD.findall(t or ""), set()
        for i in range(len(w) - length + 1):
            if first[tuple(w[i:i + length])] < d:
                gone.update(range(i, i + length))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def contamination(text, items, size=13):
    wins = collections.defaultdict(set)
    for i, t in items:
        w = BENCH_WORD.findall(lower(t))
        for k in range(max(1, len(w) - size + 1) if w else 0):
            wins[tuple(w[k:k + size])].add(str(i))
    w, hit, found = BENCH_WORD.findall(lower(text)), set(), set()
    for n in {len(k) for k in wins}:
        for k in range(len(w) - n + 1):
            if tuple(w[k:k + n]) in wins:
                hit.update(range(k, k + n))
                found |= wins[tuple(w[k:k + n])]
    return (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w))


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def divergence(docs, min_docs=30, top=50):
    """[(text, lang, source)] -> sorted rows (lang, source, part, item, value, rank)."""
    docs = [(t or "", g or "", s or "") for t, g, s in docs]
    counts, seen = collections.Counter(), collections.Counter()
    for t, g, s in docs:
        w = TERM.findall(lower(t))
        counts.update((g, s, x) for x in w)
        seen.update((g, x) for x in set(w))
    out = []
    for g in {x[1] for x in docs}:
        sources = {s for _, h, s in docs if h == g}
        kept = [x for (h, x), n in seen.items() if h == g and n >= min_docs]
        n = {s: {x: counts[g, s, x] for x in kept} for s in sources}
        whole = {x: sum(n[s][x] for s in sources) for x in kept}

        def p(c, kept=kept):
            total = sum(c.values())
            return {x: 1 + 10**9 * (c[x] + 5) // (total + 5 * len(kept)) for x in kept}

        ps, q = {s: p(n[s]) for s in sources}, p(whole)
        for s in sources:
            pair = [(-sum(abs(ps[s][x] - ps[o][x]) for x in kept), o) for o in sources if o != s]
            term = [(q[x] - ps[s][x], x) for x in kept if n[s][x] and ps[s][x] > q[x]]
            for part, items in (("pair", pair), ("term", sorted(term, key=lambda i: (i[0], i[1].encode()))[:top])):
                items = sorted(items, key=lambda i: (i[0], i[1].encode()))
                out += [(g, s, part, item, -v, r + 1) for r, (v, item) in enumerate(items)]
    return sorted(out)


def merkle(rows):
    """[(doc_id, source, lang, n_chars, text)] -> rows (doc_id, leaf, subroot, root, proof, folded, verified)."""
    def leaf(r):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def climb(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
        return out

    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        langs[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = climb([leaf(r) for r in langs[g]])
    high = climb([trees[g][-1][0] for g in order]) if order else []
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(langs[g]):
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None
            node, proof = leaf((*r[:4], lower(r[4]))) if changed else leaf(r), ""
            for tree, at in ((trees[g], i), (high, k)):
                for level in tree[:-1]:
                    lo = at - at % 8
                    before, after = "".join(level[lo:at]), "".join(level[at + 1:lo + 8])
                    proof, node, at = proof + before + after, sha(before + node + after), at // 8
            out.append((r[0], leaf(r), trees[g][-1][0], high[-1][0], sha(proof), node, node == high[-1][0]))
    return sorted(out, key=str)


def line_dedup(docs, least=10):
    """[(id, text)] -> [(id, lines, dropped, sha)]; a NULL id comes last."""
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    def place(d):
        return (d is None, d or 0)

    first = {}
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(k := key(line)) >= least:
                first[k] = min(first.get(k, place(d)), place(d))
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        left = [x for x in lines if len(key(x)) < least or first[key(x)] == place(d)]
        out.append((d, len(lines), len(lines) - len(left), sha("\n".join(left))))
    return sorted(out, key=str)
