"""What the operators must give, said plainly and slowly in Python."""

from __future__ import annotations

import math
import re
import zlib
from base64 import b32encode
from collections import Counter, defaultdict
from hashlib import sha1, sha256

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def hexed(text):
    return sha256(text.encode()).hexdigest()


def bpe(rows):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        out.append((i, len(ids), hexed(",".join(map(str, ids))), hexed(t.decode(ids, skip_special_tokens=False))))
    return out


def grouped(n, pairs):
    top = list(range(n))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        top[find(a)] = find(b)
    return [find(x) for x in range(n)]


def near(rows, size):
    sets = []
    for _, text in rows:
        w = WORD.findall(lower(text))
        sets.append({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    at = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            at[x].append(i)
    both = Counter()
    for members in at.values():
        both.update((a, b) for k, a in enumerate(members) for b in members[k + 1 :])
    links = [p for p, n in both.items() if 100 * n >= 80 * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    root = grouped(len(rows), links)
    least = defaultdict(lambda: math.inf)
    for (i, _), r in zip(rows, root, strict=True):
        least[r] = min(least[r], i)
    return [(i, len(s), least[r], i == least[r]) for (i, _), s, r in zip(rows, sets, root, strict=True)]


def exact(rows):
    by = defaultdict(list)
    for i, text in rows:
        by[lower(text)].append(i)
    return [(i, max(by[lower(t)]), len(by[lower(t)]), i == max(by[lower(t)]), hexed(lower(t))) for i, t in rows]


def base_scores(rows):
    found = [(i, WORD.findall(lower(t)) + ["\n"], zlib.crc32(str(i).encode()) % 10 == 0) for i, t in rows]
    c = Counter(w for _, ws, held in found if not held for w in ws)
    n, norm = c.total(), c.total() + 0.1 * (len(c) + 1)
    return [
        (i, held, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.1) / norm) for w in ws))
        for i, ws, held in found
    ]


def warc(rows):
    by = defaultdict(list)
    for i, html in rows:
        by[html or ""].append(i)
    out = []
    for i, html in rows:
        data, top = (html or "").encode(), max(by[html or ""])
        out.append((i, len(data), b32encode(sha1(data).digest()).decode(), "response" if i == top else "revisit", None if i == top else top))
    return out


def luhn(d):
    return sum(sum(divmod(int(c) * 2, 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0


def personal(rows):
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m, d: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m, d: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m, d: 14 <= len(d) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, d: 10 <= len(d) <= 15),
    }
    out = []
    for i, text in rows:
        spans = []
        for k, (name, (pattern, good)) in enumerate(kinds.items()):
            for m in re.finditer(pattern, text or ""):
                if good(m[0], re.sub("[^0-9]", "", m[0])):
                    spans.append((m.start(), k, m.end(), name))
        spans.sort()
        told = ",".join(f"{name}:{s}:{e}" for s, _, e, name in spans)
        out.append((i, *(sum(x[1] == k for x in spans) for k in range(4)), hexed(told), told))
    return out


def vectors(rows, cosine=0.95):
    good = []
    for k, (_, v) in enumerate(rows):
        x = None if v is None or any(c is None for c in v) else np.array(v, float)
        if x is not None and len(x) and np.isfinite(x).all() and np.linalg.norm(x) > 0:
            good.append((k, x / np.linalg.norm(x)))
    pairs = [
        (a, b) for n, (a, x) in enumerate(good) for b, y in good[n + 1 :] if len(x) == len(y) and x @ y >= cosine - 1e-12
    ]
    count = Counter(x for p in pairs for x in p)
    root = grouped(len(rows), pairs)
    least = defaultdict(lambda: math.inf)
    for k, (i, _) in enumerate(rows):
        least[root[k]] = min(least[root[k]], i)
    return [(i, count[k], least[root[k]], i == least[root[k]]) for k, (i, _) in enumerate(rows)]


ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminated(rows, items, window=10):
    cut = lambda t: ITEM_WORD.findall(lower(t))
    wanted = defaultdict(set)
    for i, text in items:
        w = cut(text)
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            wanted[tuple(w[k : k + size])].add("" if i is None else str(i))
    sizes = {len(w) for w in wanted}
    out = []
    for i, text in rows:
        w, hit, names = cut(text), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if (found := wanted.get(tuple(w[k : k + size]))) is not None:
                    hit.update(range(k, k + size))
                    names |= found
        out.append((i, len(w), len(hit), len(names), hexed(",".join(sorted(names))), bool(hit)))
    return out


def merkle(rows, fanout=8):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: hexed("".join(map(field, r)))

    def tree(hashes):
        """The root, and for each leaf the steps (left siblings, right ones) on its way."""
        steps, level, at = [[] for _ in hashes], list(hashes), list(range(len(hashes)))
        while len(level) > 1:
            for k, place in enumerate(at):
                run = level[place // fanout * fanout :][:fanout]
                steps[k].append(("".join(run[: place % fanout]), "".join(run[place % fanout + 1 :])))
            at = [place // fanout for place in at]
            level = [hexed("".join(level[k : k + fanout])) for k in range(0, len(level), fanout)]
        return level[0], steps

    by = defaultdict(list)
    for r in rows:
        by[r[2]].append(r)
    langs = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    done, subroots = {}, []
    for g in langs:
        own = sorted(by[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        done[g] = (own, *tree([leaf(r) for r in own]))
        subroots.append(done[g][1])
    if not rows:
        return []
    root, above = tree(subroots)
    out = []
    for g, up in zip(langs, above, strict=True):
        own, subroot, steps = done[g]
        for r, path in zip(own, steps, strict=True):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None
            h = leaf((*r[:4], lower(r[4]))) if tampered else leaf(r)
            for left, right in path + up:
                h = hexed(left + h + right)
            proof = hexed("".join(left + right for left, right in path + up))
            out.append((r[0], leaf(r), subroot, root, proof, h, h == root))
    return out


def codes(rows, parts=16, entries=64, rounds=2):
    """Rows of (vec_id, vector, label)."""
    kept = []
    for i, v, label in rows:
        if v and None not in v and all(math.isfinite(x) for x in v) and all(abs(math.floor(256 * x)) <= 1 << 26 for x in v):
            kept.append((i, [math.floor(256 * x) for x in v], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = -(-len(kept[0][1]) // parts)
    cut = [[(v + [0] * (parts * width - len(v)))[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[cut[k][p] for k in range(min(entries, len(cut)))] for p in range(parts)]

    def assign():
        apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
        return [[min((apart(c[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        own = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, o in zip(cut, own, strict=True) if o[p][1] == k]
                if mine:
                    books[p][k] = [math.floor(sum(x) / len(mine)) for x in zip(*mine, strict=True)]
    told = hexed(",".join(str(x) for book in books for e in book for x in e))
    own, sums = assign(), Counter()
    for (_, _, label), o in zip(kept, own, strict=True):
        sums[label] += sum(d for d, _ in o)
    return [
        (i, "".join(f"{k:02x}" for _, k in o), sum(d for d, _ in o), sums[label], told)
        for (i, _, label), o in zip(kept, own, strict=True)
    ]


def spelled(text):
    """The symbols of a text: its words with a space after each, and the end."""
    return b" ".join([*lower(text).encode().split(), b"\n"])


def suffix_scores(rows, depth, min_count, min_bits):
    """log10 probability of each text, and the retained contexts, by the definition: symbol by symbol, in dictionaries."""
    after = defaultdict(Counter)
    for i, text in rows:
        if i is None or zlib.crc32(str(i).encode()) % 10:
            s = b"\n" * depth + spelled(text)
            for at in range(depth, len(s)):
                for k in range(depth + 1):
                    after[s[at - k : at]][s[at]] += 1
    kept = set()
    for context, n in after.items():
        if context and n.total() >= min_count:
            up = after[context[1:]]
            bits = sum(m * math.log2(m / n.total() / (up[x] / up.total())) for x, m in n.items())
            if len(context) <= 2 or bits >= min_bits:
                kept |= {context[k:] for k in range(len(context))}

    def p(context, x):
        if not context:
            return (after[b""][x] + 0.1) / (after[b""].total() + 0.1 * 252)
        shorter = p(context[1:], x)
        if context not in kept:
            return shorter
        n = after[context]
        return (n[x] + len(n) * shorter) / (n.total() + len(n))

    out = []
    for i, text in rows:
        s = b"\n" * depth + spelled(text)
        out.append((i, sum(math.log10(p(s[at - depth : at], s[at])) for at in range(depth, len(s)))))
    return out, kept
