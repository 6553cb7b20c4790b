"""Sequential readings of the operators' rules, for small data."""

import collections
import hashlib
import math
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, n: int, words: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(words)}" for _ in range(n))


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def byte_repeats(docs, width):
    seen = collections.Counter()
    texts = [(i, (t or "").encode()) for i, t in docs]
    for _, b in texts:
        seen.update(b[p : p + width] for p in range(len(b) - width + 1))
    out = []
    for i, b in texts:
        gone = [False] * len(b)
        for p in range(len(b) - width + 1):
            if seen[b[p : p + width]] > 1:
                gone[p : p + width] = [True] * width
        spans = sum(g and (q == 0 or not gone[q - 1]) for q, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def word_repeats(docs, width):
    first = {}
    texts = [(i, (t or "").encode().split()) for i, t in docs]
    for i, w in texts:
        for p in range(len(w) - width + 1):
            if i is not None:
                key = tuple(w[p : p + width])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in texts:
        gone = [False] * len(w)
        for p in range(len(w) - width + 1):
            if i is not None and first[tuple(w[p : p + width])] < i:
                gone[p : p + width] = [True] * width
        out.append((i, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def recurring_lines(docs, least, depth=3, fixed=0.5, most=0.5):
    rows = []
    for i, (_, text) in enumerate(docs):
        seen = set()
        for no, line in enumerate([] if text is None else text.split("\n")):
            masked = tuple("\0" if re.search("[0-9]", x) else x for x in WORD.findall(line))
            if masked:
                rows.append((i, no, masked, masked not in seen))
                seen.add(masked)
    counts = collections.Counter()
    for _, _, masked, once in rows:
        counts[masked] += once
    leaves = collections.defaultdict(list)
    for masked in counts:
        leaves[len(masked), masked[:depth]].append(masked)
    template = {}
    for leaf, lines in leaves.items():
        having = collections.Counter()
        for line in lines:
            for at, x in enumerate(line):
                having[at, x] += counts[line]
        if sum(counts[line] for line in lines) >= least:
            for line in lines:
                kept = line if len(lines) == 1 else tuple(x if having[at, x] >= least else "\0" for at, x in enumerate(line))
                n = sum(x != "\0" for x in kept)
                if n and n >= fixed * len(line):
                    template[line] = (leaf, kept)
    documents = collections.defaultdict(set)
    for i, _, masked, _ in rows:
        if masked in template:
            documents[template[masked]].add(docs[i])
    drop = collections.defaultdict(set)
    for i, no, masked, _ in rows:
        if masked in template and len(documents[template[masked]]) >= least:
            drop[i].add(no)
    out = []
    for i, (doc, text) in enumerate(docs):
        lines = [] if text is None else text.split("\n")
        gone = drop[i] if sum(len(lines[x]) for x in drop[i]) <= most * len(text or "") else set()
        out.append((doc, len(lines), sorted(gone), "\n".join(x for j, x in enumerate(lines) if j not in gone) if gone else text))
    return out


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def near_classes(texts, similarity=0.8):
    """Class number of each text: linked if similar enough by word edits."""
    words = [WORD.findall(t or "") for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            longer = max(len(words[i]), len(words[j]))
            if longer and edits(words[i], words[j]) <= int((1 - similarity) * longer + 1e-9):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


def base_spans(text):
    kinds = (
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 12),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
    )
    found = sorted((m.start(), i, m.end(), kind) for i, (kind, p, ok) in enumerate(kinds) for m in p.finditer(text or "") if ok(m))
    return [f"{kind}:{a}:{b}" for a, _, b, kind in found]


def item_scores(items, passage, k1=1.2, b=0.75):
    """BM25 of each item for a passage as its query, as a share of the item's own highest score."""
    having = collections.Counter(w for item in items for w in set(item))
    mean = sum(map(len, items)) / len(items)
    out = []
    for item in items:
        total = part = 0.0
        for w, n in collections.Counter(item).items():
            idf = math.log(1 + (len(items) - having[w] + 0.5) / (having[w] + 0.5))
            x = idf * n * (k1 + 1) / (n + k1 * (1 - b + b * len(item) / mean))
            total += x
            part += x if w in passage else 0.0
        out.append(part / total)
    return out


def targets(sizes, weights, share, most):
    """Targets of sources by repeated resharing. ``sizes`` by source, in order."""
    want = dict.fromkeys(sizes, 0.0)
    left, open_ = share * sum(sizes.values()), dict(zip(sizes, (weights[i % len(weights)] for i in range(len(sizes)))))
    while open_ and left > 1e-9:
        total = sum(open_.values())
        over = 0.0
        for s, w in list(open_.items()):
            want[s] += left * w / total
            if want[s] >= most * sizes[s]:
                over += want[s] - most * sizes[s]
                want[s] = most * sizes[s]
                del open_[s]
        left = over
    return want
