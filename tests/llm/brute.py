"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
from collections import defaultdict
from zlib import crc32

import numpy as np
import xxhash

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\x0c\r"


def line_dedup(docs, min_docs=10):
    """docs: (doc_id, text) -> list of (doc_id, n_lines, n_dropped, kept text); a document is an (id, text) pair."""
    where = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            where[line.strip(BLANKS).translate(LOW)].add((i, t or ""))
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (x.strip(BLANKS) and len(where[x.strip(BLANKS).translate(LOW)]) >= min_docs)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def fingerprint(text, width=4, seed=42):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def near_links(fps, radius):
    f = np.array(fps, np.uint64)
    for i in range(len(f)):
        for j in np.nonzero(np.bitwise_count(f[i] ^ f[i + 1:]) <= radius)[0]:
            yield i, i + 1 + int(j)


def simhash_components(docs, radius=4):
    """docs: (doc_id, text) -> list of (fingerprint, smallest id of the component)."""
    fps = [fingerprint(t) for _, t in docs]
    roots = components(len(docs), near_links(fps, radius))
    least = {}
    for (i, _), r in zip(docs, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [(f, least.get(r)) for f, r in zip(fps, roots)]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def contamination(docs, items, window=10):
    """-> list of (doc_id, n_words, n_hit, sorted item ids as text)."""
    windows = defaultdict(set)
    for item, t in items:
        w = words(t)
        size = min(window, len(w))
        for s in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[s:s + size])].add(item)
    sizes = {len(k) for k in windows}
    out = []
    for i, t in docs:
        w = words(t)
        hit, found = set(), set()
        for size in sizes:
            for s in range(len(w) - size + 1):
                got = windows.get(tuple(w[s:s + size]))
                if got:
                    hit.update(range(s, s + size))
                    found.update(got)
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def targets(sizes, weights=(5, 2, 1), most=3):
    """sizes: source -> words; water-filled targets by repeated sharing."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, out, open_ = sum(sizes.values()), {}, set(order)
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * share >= most * sizes[s]}
        if not full:
            return out | {s: weight[s] * share for s in open_}
        for s in full:
            out[s] = float(most * sizes[s])
            left -= most * sizes[s]
        open_ -= full
    return out


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def phrases(docs, least=30, longest=4, covered=80, top=2000):
    """docs: (lang, text) -> list of (lang, rank, phrase, a, l, r, n, score)."""
    counts, total = defaultdict(lambda: defaultdict(int)), defaultdict(int)
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = {k: a for k, a in f.items() if len(k) >= 2 and a >= least}
        longer = defaultdict(int)
        for k, a in found.items():
            for size in range(2, len(k)):
                for i in range(len(k) - size + 1):
                    longer[k[i:i + size]] = max(longer[k[i:i + size]], a)
        rows = []
        for k, a in found.items():
            if 100 * longer[k] < covered * a:
                score, cut = min((2000000 * a // (f[k[:j]] + f[k[j:]]), j) for j in range(1, len(k)))
                rows.append((-score, -a, " ".join(k).encode(), f[k[:cut]], f[k[cut:]]))
        out += [(lang, rank, phrase.decode(), -a, left, right, total[lang], -score)
                for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1)]
    return out


def trie(rows, every=20, spread=4):
    """rows: (conv_id, turn, role, text) -> the nodes of the rebuilt conversations' prefixes."""
    logged = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            logged[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v)] for c, v in logged.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = crc32(str(c).encode()) % spread
        base = abs(c) // every * every * (1 if c > 0 else -1)  # the remainder has the sign of c, as in SQL
        seq = tuple(own.get(base, [])[:h] + turns[h:])
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    out = []
    for k, m in members.items():
        below = [x for x in members if x[:len(k)] == k]
        saved = sum((len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) for x in below if x)
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], sum(not children[x] for x in below),
                    saved, sha256(",".join(map(str, sorted(ends[k]))))))
    return out


def _long(x, seed=42):
    return xxhash.xxh64_intdigest((x & (1 << 64) - 1).to_bytes(8, "little"), seed)


def minhash(text, shingle=5, bins=256, bits=8, probes=8):
    """The lanes of a text's one-permutation MinHash, densified; [] for a text without words."""
    words = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))]
    if not words:
        return []
    shift, least = 64 - (bins.bit_length() - 1), {}
    for i in range(max(1, len(words) - shingle + 1)):
        h = 42
        for w in words[i:i + shingle]:
            h = _long(w, h)
        j = ((h >> shift) + bins // 2) % bins  # bins in the order of signed numbers
        least[j] = min(h, least.get(j, h))
    lanes = []
    for j in range(bins):
        walk = [j] + [_long(j, _long(r)) & bins - 1 for r in range(probes)]
        found = next((b for b in walk if b in least), None)
        if found is None:
            found = min(least, key=lambda b: _signed(_long(b - bins // 2, _long(j, _long(probes)))))
        lanes.append(_long(j, _long(least[found])) & (1 << bits) - 1)
    return lanes


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def packed(lanes, bins=256, bits=8):
    per = 64 // bits
    lanes = lanes or [0] * bins
    return "".join(f"{sum(x << i * bits for i, x in enumerate(lanes[k:k + per])):016x}" for k in range(0, bins, per))


def alike(a, b, bits=8):
    if not a or not b:
        return float(not a and not b)
    chance = 2.0 ** -bits
    return max(0.0, (sum(x == y for x, y in zip(a, b)) / len(a) - chance) / (1 - chance))


def edits(docs, **kind):
    """docs: (doc_id, text) -> list of (doc_id, n_chars, edited sha, fingerprint, edited fingerprint, near_edited, near_next)."""
    rows = sorted(((i, t or "") for i, t in docs),
                  key=lambda r: (r[0] is not None, r[0] or 0, _signed(xxhash.xxh64_intdigest(r[1].encode(), 42))))
    prints = {t: minhash(t, **kind) for _, t in rows}
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        e = minhash(edited, **kind)
        size = {x: v for x, v in kind.items() if x in ("bins", "bits")}
        bits = kind.get("bits", 8)
        out.append((i, len(t), sha256(edited), packed(prints[t], **size), packed(e, **size),
                    round(alike(prints[t], e, bits), 9), round(alike(prints[t], prints[after], bits), 9)))
    return out
