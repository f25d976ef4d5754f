"""Plain versions of the operators, for small inputs only. Rows are (doc_id, text) pairs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def secrets(text):
    text = text or ""
    found = []
    assign = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found += [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, a, b) for a, _, b, k in sorted(found)]


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    text = text or ""
    bare = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 13 <= len(bare(m[0])) <= 19 and luhn(bare(m[0])):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(bare(m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def quality(text):
    text = text or ""
    w = words(text)
    windows = defaultdict(list)
    for i in range(len(w) - 2):
        windows[tuple(w[i : i + 3])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    n, repeat = len(w), len(covered)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat, n < 50 or 100 * repeat > 50 * n)


def repeats(rows, length):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256 of the rest), rows in order."""
    texts = [(text or "").encode() for _, text in rows]
    starts = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if starts[t[p : p + length]] > 1:
                gone[p : p + length] = b"\x01" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        rest = bytes(c for c, g in zip(t, gone) if not g)
        out.append((doc, len(t), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def shingle_set(text, size):
    w = words(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def near(rows, size, percent):
    """(doc_id, n_shingles, component, kept) for rows with distinct ids."""
    sets = {d: shingle_set(t, size) for d, t in rows}
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    pairs = Counter()
    for held in holders.values():
        for i, a in enumerate(held):
            for b in held[i + 1 :]:
                pairs[a, b] += 1
    for (a, b), shared in pairs.items():
        if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return [(d, len(sets[d]), find(d), find(d) == d) for d, _ in rows]


def held_out(doc, modulus):
    return zlib.crc32(str(doc).encode()) % modulus == 2


def tokens(text):
    return [*words(lower(text or "")), None]


def language_model(rows):
    """(doc_id, held_out, n_tokens, n_known, N, base_score, score) of the bigram model."""
    training = [tokens(t) for d, t in rows if not held_out(d, 7)]
    c = Counter(x for t in training for x in t)
    total, size = sum(c.values()), len(c)
    pairs = Counter((a, b) for t in training for a, b in zip([None, *t], t))
    follow, before = defaultdict(Counter), Counter()
    context = Counter()
    for (a, b), n in pairs.items():
        follow[a][min(n, 3)] += 1
        before[b] += 1
        context[a] += n

    def discounts(counts):
        n = [sum(1 for x in counts if x == k) for k in (1, 2, 3, 4)]
        if not n[0]:
            return 0, 0, 0
        y = n[0] / (n[0] + 2 * n[1])
        d = [1 - 2 * y * n[1] / n[0]]
        for k in (2, 3):
            d.append(k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else d[-1])
        return tuple(min(max(x, 0), k) for k, x in enumerate(d, 1))

    high, low = discounts(list(pairs.values())), discounts(list(before.values()))
    take = lambda n, d: 0 if n == 0 else max(n - d[min(n, 3) - 1], 0)
    all_before = sum(before.values())
    gamma1 = sum(low[min(n, 3) - 1] for n in before.values()) / all_before if all_before else 1

    def p(a, b):
        one = take(before[b], low) / max(all_before, 1) + gamma1 / (size + 1)
        if not context[a]:
            return one
        gamma = sum(high[k - 1] * n for k, n in follow[a].items()) / context[a]
        return take(pairs[a, b], high) / context[a] + gamma * one

    out = []
    for d, t in rows:
        x = tokens(t)
        base = sum(math.log10((c[w] + 1) / (total + size + 1)) for w in x)
        out.append((d, held_out(d, 7), len(x), sum(c[w] > 0 for w in x), total, base, sum(math.log10(p(a, b)) for a, b in zip([None, *x], x))))
    return out


def leaks(rows, items, size=5, least=0.8):
    """(doc_id, item_id) -> best weighted similarity over all windows of the item's length."""
    out = {}
    grams = lambda w, n: Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    for d, t in rows:
        w = words((t or "").lower())
        for i, it in items:
            v = words((it or "").lower())
            if not v or not w:
                continue
            n = min(size, len(v))
            theirs = grams(v, n)
            best = 0
            if not theirs.keys() & grams(w, n).keys():
                continue
            for at in range(max(1, len(w) - len(v) + 1)):
                mine = grams(w[at : at + len(v)], n)
                shared = sum((mine & theirs).values())
                best = max(best, shared / max(1, sum((mine | theirs).values())))
            if best >= least:
                out[d, i] = best
    return out


def archive(pages, least=100):
    first = {}
    for page, html in sorted(pages):
        body = (html or "").encode()
        if len(body) >= least:
            first.setdefault(body, page)
    out = []
    for page, html in pages:
        body = (html or "").encode()
        to = first.get(body, page)
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "response" if to == page else "revisit", None if to == page else to))
    return out
