"""Plain Python versions of the operators, for small tables, and a fixture that makes documents."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

SF_SMALL = "/root/testdata/sf0.001"

FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text, fold=True):
    raw = (text or "").encode()
    return WORD.findall(raw.translate(FOLD) if fold else raw)


def shingle_sets(rows, width=5):
    out = []
    for i, t in rows:
        w = words(t)
        out.append((i, {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())))
    return out


def components(rows, percent=75):
    """[(doc_id, n_shingles, component_id)] by comparing all pairs that share a shingle."""
    sets = shingle_sets(rows)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    inverted = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for g in s:
            inverted[g].append(k)
    for k, (_, s) in enumerate(sets):
        shared = Counter(j for g in s for j in inverted[g] if j < k)
        for j, o in shared.items():
            if 100 * o >= percent * (len(s) + len(sets[j][1]) - o):
                parent[find(k)] = find(j)
    least = {}
    for k, (i, _) in enumerate(sets):
        r = find(k)
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [(i, len(s), (least.get(find(k)) if s else i)) for k, (i, s) in enumerate(sets)]


ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def contamination(docs, items, width=10):
    """[(doc_id, n_words, n_hit, n_items, sha, contaminated)]"""
    grams = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(ASCII_FOLD))
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            grams[tuple(w[k:k + n])].add(item)
    sizes = {len(g) for g in grams}
    out = []
    for i, text in docs:
        w = ALNUM.findall((text or "").translate(ASCII_FOLD))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                own = grams.get(tuple(w[k:k + n]))
                if own is not None:
                    hit.update(range(k, k + n))
                    found |= {str(x) for x in own if x is not None}
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), sha, bool(hit)))
    return out


def repeated(rows, n=50):
    """{doc_id: word places inside a run of n words that a document with a smaller id has}"""
    first, texts = {}, {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = texts[i] = words(t)
        for k in range(len(w) - n + 1):
            first.setdefault(tuple(w[k:k + n]), i)
    out = {}
    for i, w in texts.items():
        places = set()
        for k in range(len(w) - n + 1):
            if first[tuple(w[k:k + n])] < i:
                places.update(range(k, k + n))
        out[i] = places
    return out


def statistics(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    w = words(text, fold=False)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
    count = Counter(grams)
    inside = {k + j for k, g in enumerate(grams) if count[g] > 1 for j in range(5)}
    return (len(w), sum(len(x.decode()) for x in w), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(inside))


def water_fill(sizes, weights, total, epochs):
    """Targets by clamping and resharing until none is above its cap."""
    target, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = total
    while open_:
        weight = sum(weights[k] for k in open_)
        over = {k for k in open_ if left * weights[k] / weight >= epochs * sizes[k]}
        if not over:
            for k in open_:
                target[k] = left * weights[k] / weight
            break
        for k in over:
            target[k] = epochs * sizes[k]
            left -= target[k]
        open_ -= over
    return target


@pytest.fixture()
def docs_of(spark):
    """Documents from (id, text) pairs or full rows; ``parts`` spreads them over tasks."""
    def make(rows, parts=3):
        full = [tuple(r) + (None,) * (5 - len(r)) if len(r) < 5 else tuple(r) for r in rows]
        full = [(i, t, lang, src, n if n is not None else (len(t) if t is not None else None)) for i, t, lang, src, n in full]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(parts)
    return make
