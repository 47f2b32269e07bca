"""Plain Python versions of the operators, for small tables."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import xxhash

SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def drop_lines(docs):
    """[(doc_id, text)] -> [(doc_id, n_lines, n_dropped, kept)]; a null id is the smallest."""
    order = lambda i: -(2**63) if i is None else i
    key = lambda line: lower(line.strip(SPACES))
    holders = collections.defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(order(i))
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == order(i)]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def simhash(text):
    words = re.findall(WORD, lower(text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, linked):
    """Smallest reachable id of each position under the boolean link matrix."""
    label = list(ids)
    while True:
        new = [min([label[i], *[label[j] for j in np.flatnonzero(linked[i])]]) for i in range(len(ids))]
        if new == label:
            return label
        label = new


def repeats(docs, length):
    """[(doc_id, text)] -> [(doc_id, n_bytes, n_removed, n_spans, kept)]"""
    raws = [(i, (t or "").encode()) for i, t in docs]
    count = collections.Counter(r[p:p + length] for _, r in raws for p in range(len(r) - length + 1))
    out = []
    for i, r in raws:
        covered = [False] * len(r)
        for p in range(len(r) - length + 1):
            if count[r[p:p + length]] > 1:
                covered[p:p + length] = [True] * length
        spans = sum(1 for k, c in enumerate(covered) if c and (k == 0 or not covered[k - 1]))
        out.append((i, len(r), sum(covered), spans, bytes(x for x, c in zip(r, covered, strict=True) if not c)))
    return out


def base_features(text):
    text = text or ""
    words = re.findall(WORD, text)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    count = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if count[tuple(words[i:i + 5])] > 1 for k in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def chained(*words):
    """XXH64 of several strings as Spark takes it: each hash is the seed of the next."""
    h = 42
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), seed=h)
    return h


def cell(h, buckets):
    return (h - 2**64 if h >= 2**63 else h) % buckets


def crc(data: bytes) -> int:
    return zlib.crc32(data)


def one_error(a, b):
    """a and b differ by one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def word_counts(docs, least, every=None):
    """Counter of the runs of letters of [(doc_id, text)]; every so many-th (document, run) loses a letter."""
    total = collections.Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += len(run) >= least
    return {w: n for w, n in total.items() if n}


def variants(counts, least=5, ratio=5):
    """{word: n} -> [(word, form, root, n, n_near, form_n)]"""
    words = {w: n for w, n in counts.items() if n >= least}
    form, near = {}, {w: [v for v in words if one_error(v, w)] for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def negatives(rows, every):
    """Distinct usable [(vec_id, label, [int])] -> [(anchor, positive, rank, negative, positive score, negative score)]"""
    out = []
    dot = lambda a, b: max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(a, b, strict=True))))
    for i, label, v in rows:
        if i % every:
            continue
        scored = sorted(((-dot(v, w), j, k == label) for j, k, w in rows if j != i and len(v) == len(w)))
        for p, j, _ in [x for x in scored if x[2]][:5]:
            found = [(s, k) for s, k, same in scored if not same and 50 * -p <= 100 * -s <= 95 * -p][:3]
            out += [(i, j, r + 1, k, -p, -s) for r, (s, k) in enumerate(found)]
    return out


def bottom_k(text, k, shingle=5):
    """Smallest distinct hashes of the shingles, as signed numbers."""
    words = re.findall(WORD, text or "")
    parts = [words[i:i + shingle] for i in range(len(words) - shingle + 1)] or ([[" ".join(words)]] if words else [])
    hashes = {chained(*p) for p in parts}
    return sorted(h - 2**64 if h >= 2**63 else h for h in hashes)[:k]


def alike(a, b, k):
    union = sorted({*a, *b})[:k]
    return len({*union} & {*a} & {*b}) / len(union) if union else 1.0


def grams(text, cells):
    w = re.findall(WORD, text or "")
    return [cell(chained(x), cells) for x in w] + [cells + cell(chained(x, y), cells) for x, y in zip(w, w[1:], strict=False)]


def quality_kept(docs, labels, cells, threshold=-0.1, smooth=10, prior=16):
    """Flags of [(doc_id, text)]: not failed by the base rules, and likely enough. Labels: [(doc_id, quality, toxic)]."""
    bad = {i for i, q, t in labels if q == 0 or t == 1}
    trusted = {i for i, q, _ in labels if i is not None and q == 1} - bad
    raw, target = collections.Counter(), collections.Counter()
    for i, t in docs:
        raw.update(grams(t, cells))
        if i in trusted:
            target.update(grams(t, cells))
    total = [[sum(n for g, n in c.items() if g // cells == kind) for c in (raw, target)] for kind in (0, 1)]
    out = []
    for _, t in docs:
        n, *_, repeated = base_features(t)
        gs = grams(t, cells)
        score = sum(math.log((target[g] + smooth) / (raw[g] * total[g // cells][1] / total[g // cells][0] + smooth)) for g in gs)
        out.append(n >= 10 and 100 * repeated <= 20 * n and score / (len(gs) + prior) >= threshold)
    return out


def mixed(docs, seed, most=3):
    """Epochs of [(doc_id, text, source)]: sources by code point, null last, weigh 1, 2, 3, repeating."""
    size = lambda t: len(re.findall(WORD, t or ""))
    names = sorted({s for *_, s in docs if s is not None}, key=lambda s: s.encode()) + [None] * any(s is None for *_, s in docs)
    have = {n: sum(size(t) for _, t, s in docs if s == n) for n in names}
    weight, capped = {n: 1 + k % 3 for k, n in enumerate(names)}, {}
    while True:
        free = [n for n in names if n not in capped]
        level = (sum(have.values()) - sum(capped.values())) / sum(weight[n] for n in free) if free else 0
        over = [n for n in free if level * weight[n] > most * have[n]]
        if not over:
            break
        capped |= {n: most * have[n] for n in over}

    def key(i, t):
        text = f"{'null' if i is None else i}:{hashlib.md5((t or '').encode()).hexdigest()}:{seed}"
        u = (int(hashlib.md5(text.encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        share = len(re.findall(r"[#*$%&|<>]", t or "")) / max(1, len(t or ""))
        return -math.log(u) / (max(0.1, 1.0 - 10.0 * share) if t is not None else 0.1)

    epochs = {}
    for n in names:
        target = capped.get(n, level * weight[n])
        whole = int(target // have[n]) if have[n] else 0
        rest, cum = target - whole * have[n], 0
        rows = collections.Counter((key(i, t), i is not None, i or 0, t) for i, t, s in docs if s == n)
        for row in sorted(rows, key=lambda r: r[:3]):
            words = size(row[3]) * rows[row]
            cum += words
            epochs[n, row[2] if row[1] else None, row[3]] = whole + (cum - words / 2 <= rest)
    return [epochs[s, i, t] for i, t, s in docs]
