"""Plain versions of the text operators."""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections import Counter

LOW = {c: c + 32 for c in range(65, 91)}
WS = " \t\n\x0b\x0c\r"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def shingles(text, width=5):
    w = words(text)
    if len(w) >= width:
        return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def components(rows, percent=80):
    """{doc_id: (set size, smallest linked id)} of (doc_id, text) with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders: dict = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in sets.items():
        for j, k in Counter(j for x in s for j in holders[x] if j < i).items():
            if k * 100 >= percent * (len(s) + len(sets[j]) - k):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def dedup_lines(rows, least=10):
    """{doc_id: (n_lines, n_dropped, text)}."""
    key = lambda x: x.strip(WS).translate(LOW)
    held: dict = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= least:
                held.setdefault(key(x), set()).add(i)
    out = {}
    for i, t in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if len(held.get(key(x), ())) < 2 or min(held[key(x)]) == i]
        out[i] = (len(own), len(own) - len(kept), "\n".join(kept))
    return out


def shard_of(rows, limit):
    """{doc_id: prefix} by splitting every oversized bucket on its next bit."""
    bits = {i: format(int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), "060b") for i, _ in rows}
    size = {i: len((t or "").encode()) for i, t in rows}
    out, todo = {}, [("", list(bits))]
    while todo:
        prefix, ids = todo.pop()
        if sum(size[i] for i in ids) <= limit or len(ids) == 1:
            out |= dict.fromkeys(ids, prefix)
        else:
            for b in "01":
                own = [i for i in ids if bits[i].startswith(prefix + b)]
                if own:
                    todo.append((prefix + b, own))
    return out


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n, hit = Counter(tri), set()
    for i, x in enumerate(tri):
        if n[x] > 1:
            hit |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def entropy(text):
    n = Counter(text)
    return -sum(c / len(text) * math.log2(c / len(text)) for c in n.values())


def leaks(docs, items, percent=80, width=5):
    """{(doc_id, item_id): (n_item, n_found)}."""
    out = {}
    for j, text in items:
        w = words(text)
        k = min(width, len(w))
        own = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
        for i, t in docs:
            d = words(t)
            n = len(own & {tuple(d[x : x + k]) for x in range(len(d) - k + 1)})
            if own and n * 100 >= percent * len(own):
                out[(i, j)] = (len(own), n)
    return out


def passages(text, size, classes, extra=4):
    """Features of each passage of a text, counted character by character."""
    text, table = text or "", {}
    for k, chars in enumerate(("aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "0123456789", ".", ",", "!", "?", "|", "*#$%&", "<>{}[]\\", "'\"-;:()"), 1):
        table |= dict.fromkeys(map(ord, chars), k)
    kind = lambda b: 0 if chr(b) in WS and b < 128 else table.get(b, 14 if b < 128 else 15)
    data = text.encode()
    starts = [i for i, b in enumerate(data) if kind(b) and (i == 0 or not kind(data[i - 1]))]
    cuts = [0, *starts[size::size], len(data)]
    out = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        part, own = data[a:b], data[a:b].decode()
        pairs = Counter((kind(x), kind(y)) for x, y in zip(part, part[1:]))
        w, n = [x for x in re.split("[ \t\n\x0b\x0c\r]+", own) if x], max(1, sum(pairs.values()))
        x = [math.sqrt(pairs[(i, j)] / n) for i in range(classes) for j in range(classes)]
        out.append([*x, len(set(w)) / max(1, len(w)), sum(p == q for p, q in zip(w, w[1:])) / max(1, len(w)), math.log1p(n) / 8, max(1, len(w)) / size])
    return out


def attention_score(w, rows):
    """The score of one document from its passages' features, term by term."""
    sig, codes, weights = lambda v: 1 / (1 + math.exp(-v)), [], []
    dot = lambda x, m: [sum(a * float(m[i][j]) for i, a in enumerate(x) if a) for j in range(len(m[0]))]
    for row in rows:
        x = [(a - float(m)) / float(s) for a, m, s in zip(row, w["mean"], w["std"], strict=True)]
        h = [math.tanh(a + float(b)) for a, b in zip(dot(x, w["W"]), w["b"], strict=True)]
        codes.append(h)
        weights.append(math.exp(sum(math.tanh(t) * sig(g) * float(k) for t, g, k in zip(dot(h, w["V"]), dot(h, w["U"]), w["w"], strict=True))))
    z = [sum(a * h[j] for a, h in zip(weights, codes, strict=True)) / sum(weights) for j in range(len(codes[0]))]
    return sig(sum(a * float(b) for a, b in zip(z, w["c"], strict=True)) + float(w["d"][0]))


def rule_verdict(rules, text):
    """kept of a text by ordered rules [(ratio, above, bound), ...]."""
    n_words, chars, symbols, dup, repeat = counts(text)
    text = text or ""
    lines = len([x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)])
    if n_words < 50 or 100 * repeat > 50 * n_words:
        return False
    upper, digits = sum(c.isupper() and unicodedata.category(c) == "Lu" for c in text), len(re.findall("[0-9]", text))
    ratio = {"word_length": (chars, n_words), "symbols": (symbols, n_words), "dup_lines": (dup, lines), "repeats": (repeat, n_words), "bangs": (text.count("!"), n_words), "upper": (upper, chars), "digits": (digits, chars), "line_words": (n_words, lines)}
    value = lambda name: ratio[name][0] / max(1, ratio[name][1])
    return not any(all(value(r) > b if above else value(r) <= b for r, above, b in rule) for rule in rules)
