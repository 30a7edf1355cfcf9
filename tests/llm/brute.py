"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def substring(rows, width=20):
    """{doc_id: (n_words, n_removed, sha)} for unique non-null ids."""
    first, docs = {}, {d: WORD.findall(t or "") for d, t in rows}
    for d in sorted(docs):
        w = docs[d]
        for i in range(len(w) - width + 1):
            first.setdefault(tuple(w[i : i + width]), (d, i))
    out = {}
    for d, w in docs.items():
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] != (d, i):
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def shingle_set(text, k):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    if not w:
        return frozenset()
    k = min(k, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def near_duplicates(rows, k, percent=80):
    """{doc_id: (n_shingles, component_id)}"""
    sets = {d: shingle_set(t, k) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    common = Counter()
    at = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            at[x].append(d)
    for ds in at.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                common[min(a, b), max(a, b)] += 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def rules(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = set()
    for i in range(len(w) - 2):
        if seen[tuple(w[i : i + 3])] > 1:
            hit.update((i, i + 1, i + 2))
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed


def hits(text, items):
    """(n_words, n_hit, sorted ids of items that occur)"""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def split(t):
        return word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    w, covered, found = split(text), set(), set()
    for item, t in items:
        v = split(t)
        for i in range(max(len(v) - 12, 1) if v else 0):
            window = v[i : i + 13]
            for j in range(len(w) - len(window) + 1):
                if w[j : j + len(window)] == window:
                    covered.update(range(j, j + len(window)))
                    found.add(item)
    return len(w), len(covered), sorted(found, key=str)


def gram_counts(texts, order):
    """{n-gram of folded bytes as a number: in how many texts it is}"""
    out = Counter()
    for t in texts:
        raw = b" " * (order - 1) + bytes(48 if 48 <= c <= 57 else c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in t.encode())
        out.update({int.from_bytes(raw[i : i + order], "big") for i in range(len(raw) - order + 1)})
    return dict(out)


def kneser_ney(top, order):
    """{(k, n-gram): probability}, {(k, context): back-off weight}, by the textbook."""
    levels = {order: dict(top)}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g & ((1 << (8 * k)) - 1) for g in levels[k + 1])
    p, gamma = {}, {}
    for k in range(1, order + 1):
        c = levels[k]
        n = [max(sum(v == i for v in c.values()), 1) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2])
        cut = [0.0] + [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i - 0.05) for i in (1, 2, 3)]
        total, held = Counter(), Counter()
        for g, v in c.items():
            total[g >> 8] += v
            held[g >> 8] += cut[min(v, 3)]
        for h in total:
            gamma[k, h] = held[h] / total[h]
        for g, v in c.items():
            low = p[k - 1, g & ((1 << (8 * (k - 1))) - 1)] if k > 1 else 1 / 256
            p[k, g] = (v - cut[min(v, 3)]) / total[g >> 8] + gamma[k, g >> 8] * low
    return p, gamma


def page_texts(pages, blocks, long, one_in, article_pages):
    """[text of each page] for pages (host, html): what repeats is found by comparing all windows of a host."""
    parsed = [(h, [(z, t.split()) for z, t in blocks(html or "")]) for h, html in pages]

    def substrings(page, inside):
        """(place, width, words) of windows over block borders, and of short blocks"""
        own = [t for z, t in page if (z == 2) == inside]
        flat, out, at = [w for t in own for w in t], [], 0
        out += [(i, long, tuple(flat[i : i + long])) for i in range(len(flat) - long + 1)]
        for t in own:
            if 0 < len(t) < long:
                out.append((at, len(t), tuple(t)))
            at += len(t)
        return out

    texts = []
    for h, page in parsed:
        own = [p for g, p in parsed if g == h]
        gone = []
        for inside in (False, True):
            side = [p for p in own if any((z == 2) == inside for z, _ in p)]
            key = (lambda p: str([t for z, t in p if z == 2])) if inside else str
            distinct = {key(p): p for p in side}.values()
            # a whole block is counted as such, a window as such
            seen = Counter(x for p in distinct for x in {(w, s) for _, w, s in substrings(p, inside)})
            rule = (lambda n, d=distinct: n >= article_pages and 2 * n >= len(d)) if inside else (lambda n, d=distinct: n >= 2 and one_in * n >= len(d))
            gone.append([(a, w) for a, w, s in substrings(page, inside) if rule(seen[w, s])])
        at, kept = [0, 0], []
        for z, t in page:
            side = int(z == 2)
            a, b = at[side], at[side] + len(t)
            at[side] = b
            covered = {i for x, w in gone[side] for i in range(x, x + w)}
            drop = {i for x, w in gone[side] if a <= x and x + w <= b for i in range(x, x + w)}
            if set(range(a, b)) <= covered:
                drop = set(range(a, b))
            if z >= 0:
                kept += [w for i, w in enumerate(t, a) if i not in drop]
        texts.append(" ".join(kept))
    return texts


def ppm_bits(labelled, lang, text, order):
    """Bits of a text by PPM (escape method C, no exclusion), from the labelled texts themselves."""
    streams = {x: b"\n" + b"\n".join(t for y, t in labelled if y == x) for x, _ in labelled}
    after = defaultdict(lambda: defaultdict(Counter))
    for x, s in streams.items():
        for k in range(order + 1):
            for i in range(len(s) - k):
                after[s[i : i + k]][x][s[i + k]] += 1

    def cost(context, c):
        counts = after[context][lang]
        total, kinds = sum(counts.values()), len(counts)
        if counts[c]:
            return math.log2((total + kinds) / counts[c])
        escape = math.log2((total + kinds) / kinds) if total else 0.0
        return escape + (cost(context[1:], c) if context else 8.0)

    known, bits, context = set(after), 0.0, b""
    for c in text:
        bits += cost(context, c)
        context = (context + bytes([c]))[-order:]
        while context not in known:
            context = context[1:]
    return bits
