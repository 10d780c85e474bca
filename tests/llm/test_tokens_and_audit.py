"""Alignment of two tokenizers, byte-level BPE and the filter audit against the libraries and brute force."""

import hashlib
import itertools
import os
import random
import re
import struct
import sys
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelrec.llm import align, audit, bpe, gallop
from reelrec.llm.queries import QUERIES

sys.path.insert(0, os.path.dirname(__file__))
from brute import SF_SMALL, docs_of  # noqa: E402, F401

HOSTILE = list("  \n\t\x1c\x85  ​▁ab'sRé01٣!?#—你好ж՘\U00018e00\U00012550\U0001f600́") + [
    "  ", "\n\n", "'s", "'ll", "<|endoftext|>", "<s>", "<0x41>", "<unk>", " word", " the", "ing", "zzz"]


def hostile(seed, n, longest=25):
    r = random.Random(seed)
    return ["".join(r.choice(HOSTILE) for _ in range(r.randint(0, longest))) for _ in range(n)]


def clashing(df):
    for name in ("ids", "row", "part", "pair", "n_a", "fails", "h1", "weight", "decoded", "groups"):
        df = df.withColumn(name, F.lit("x"))
    return df


# --- galloping -----------------------------------------------------------------------------------

def test_gallop():
    r = np.random.default_rng(1)
    for _ in range(400):
        a, b, c = (np.unique(r.integers(0, r.integers(1, 300), r.integers(0, 150))) for _ in range(3))
        assert (gallop.ranks(a, b) == np.searchsorted(b, a)).all()
        ia, ib = gallop.common(a, b)
        assert a[ia].tolist() == b[ib].tolist() == np.intersect1d(a, b).tolist()
        assert gallop.merge([a, b, c]).tolist() == np.unique(np.concatenate([a, b, c])).tolist()
    assert gallop.merge([]).tolist() == []


# --- byte-level BPE ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.load_ranks(), bpe.newer_characters(), public_tokenizers.PATTERN)


def ids_of(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_bpe_is_the_library(encoder, reference):
    texts = hostile(1, 3000) + ["a" * 5000, "ab" * 5000, " " * 3000, "\n" * 500 + "x", "你" * 2000]
    r = random.Random(2)
    texts += ["".join(r.choice("abcdefgh") for _ in range(20000))]        # one very long pre-token
    got = encoder.encode(texts)
    assert [ids_of(x) for x in got] == [reference.encode_ordinary(t) for t in texts]
    assert [encoder.decode(x) for x in got] == [t.encode() for t in texts]
    assert [ids_of(encoder.encode([t])[0]) for t in texts[:300]] == [reference.encode_ordinary(t) for t in texts[:300]]


def test_bpe_classes(encoder, reference):
    """Every code point between letters, numbers and marks."""
    texts = [f"a{c}b 1{c}2 !{c}! {c}{c}" for c in map(chr, [*range(0x3000), *range(0x18D00, 0x18E10), *range(0x12540, 0x12560)])]
    assert [ids_of(x) for x in encoder.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_bpe_long_texts_in_groups(encoder, reference, monkeypatch):
    monkeypatch.setattr(bpe, "GROUP", 3)
    for text in hostile(3, 300, 60):
        assert ids_of(encoder.encode_long(text)) == reference.encode_ordinary(text)


def test_queue_takes_a_lesser_rank_made_by_a_merge_first():
    """Ranks whose joined parts may rank before their parts, against the leftmost least pair."""
    r = random.Random(4)
    for _ in range(300):
        ranks = {bytes([b]): b for b in range(256)}
        words = {bytes(r.choice(b"abc") for _ in range(r.randint(2, 5))) for _ in range(12)}
        ranks.update(zip(sorted(words), r.sample(range(256, 400), len(words))))
        pieces = [bytes(r.choice(b"abc") for _ in range(r.randint(1, 12))) for _ in range(20)]
        expected = []
        for piece in pieces:
            parts = [piece] if piece in ranks else [bytes([b]) for b in piece]
            while True:
                found = [(ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in ranks]
                if not found:
                    break
                i = min(found)[1]
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            expected.append([ranks[p] for p in parts])
        assert [ids_of(x) for x in bpe.Merger(ranks).encode(pieces)] == expected


def test_kept_generations():
    kept = bpe.Kept(4)
    for word in "abcdefgab":
        for new in kept.missing({word}):
            kept.young[new] = new
        assert kept.young[word] == word and len(kept.young) <= 4 and len(kept.old) <= 4


def test_bpe_edges(docs_of, reference, monkeypatch):
    rows = [(1, None), (2, ""), (3, " "), (None, "no id"), (4, "twice"), (4, "twice"), (4, "other"), (5, "long words " * 3000)]
    df = clashing(docs_of(rows))
    out = bpe.round_trip(df).collect()
    expected = sorted(((i, reference.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows), key=str)
    assert sorted(((r[0], ids_of(r[1]), bytes(r[2])) for r in out), key=str) == expected
    assert bpe.round_trip(docs_of(rows).limit(0)).collect() == []
    apart = bpe.decode(clashing(docs_of(rows)).drop("ids").join(bpe.encode(docs_of(rows[7:])), "doc_id"))
    assert [bytes(r["decoded"]) for r in apart.collect()] == [rows[7][1].encode()]


def test_op12(spark, reference):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = set()
    for i, t in docs:
        ids = reference.encode_ordinary(t or "")
        expected.add((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert {tuple(r) for r in QUERIES["op12_byte_bpe"](spark, SF_SMALL).collect()} == expected


# --- alignment -----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path(align.MODEL_A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(align.MODEL_B))
    byte, words = align.byte_alphabet(), a.get_vocab()
    bytes_a = {i: bytes(byte[c] for c in w) for w, i in words.items() if all(c in byte for c in w)}
    bytes_b = {i: bytes([int(re.fullmatch("<0x(..)>", b.id_to_piece(i))[1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in range(b.get_piece_size())}
    return a, b, bytes_a, bytes_b


def aligned_by_hand(libraries, text):
    """Ids of both, written groups, and linked id pairs with repeats; None without tokens."""
    tok_a, tok_b, bytes_a, bytes_b = libraries
    if not text:
        return None
    a, b = tok_a.encode(" " + text, add_special_tokens=False).ids, tok_b.encode(text)
    if not b"".join(bytes_a[x] for x in a) == b"".join(bytes_b[x] for x in b) == (" " + text).encode():
        return None
    ends_a, ends_b = (list(itertools.accumulate(len(of[x]) for x in ids)) for of, ids in ((bytes_a, a), (bytes_b, b)))
    links, groups, i, j, ga, gb = [], [], 0, 0, [], []
    while i < len(a):
        links.append((a[i], b[j]))
        step_a, step_b = ends_a[i] <= ends_b[j], ends_b[j] <= ends_a[i]
        if step_a:
            ga.append(a[i])
            i += 1
        if step_b:
            gb.append(b[j])
            j += 1
        if step_a and step_b:
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            ga, gb = [], []
    return a, b, ";".join(groups), links, len(groups)


def alignment(libraries, rows):
    """What the operator must return for ``(doc_id, text)``."""
    found = [(i, aligned_by_hand(libraries, t)) for i, t in rows]
    docs = Counter(p for _, f in found if f for p in set(f[3]))
    top = defaultdict(int)
    for (a, _), n in docs.items():
        top[a] = max(top[a], n)
    return sorted(((i, len(f[0]), len(f[1]), f[4], len(f[3]), sum(docs[p] == top[p[0]] for p in f[3]), sum(docs[p] for p in f[3]), f[2])
                   if f else (i, 0, 0, 0, 0, 0, 0, "") for i, f in found), key=str)


def test_alignment_edges(docs_of, libraries):
    rows = [(1, None), (2, ""), (3, " "), (4, "  two  spaces "), (None, "the same text"), (5, "the same text"), (5, "the same text"),
            (6, "a▁b"), (7, "Unbelievably 你好 \U0001f600 naïve"), (8, "word" * 400), (8, "the the the")]
    rows += list(enumerate(hostile(5, 300), 100))
    expected = alignment(libraries, rows)
    assert sum(r[1] == 0 for r in expected) > 20 < sum(r[1] > 0 for r in expected)
    # all counts sent to every task, a few of them, and none
    for most in (align.COMMON, 40, 0):
        got = align.align(clashing(docs_of(rows)), common_pairs=most).collect()
        assert sorted((tuple(r) for r in got), key=str) == expected
    assert align.align(docs_of(rows).limit(0)).collect() == []
    assert [tuple(r)[1:] for r in align.align(docs_of(rows[:1])).collect()] == [(0, 0, 0, 0, 0, 0, "")]


def test_alignment_of_long_texts_in_parts(libraries, monkeypatch):
    pair = align.Pair(align.MODEL_A, align.MODEL_B)
    monkeypatch.setattr(align, "GROUP_UNITS", 3)
    for text in [t for t in hostile(6, 300, 60) if t]:
        f, got = aligned_by_hand(libraries, text), pair.in_parts(text)
        assert (f is None) == (got is None)
        if f:
            assert got[:5] == (len(f[0]), len(f[1]), f[4], len(f[3]), f[2].encode())
            assert dict(zip(got[5].tolist(), got[6].tolist())) == Counter(a * len(pair.sizes[1]) + b for a, b in f[3])


def test_op11(spark, libraries):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[1] else "") for r in alignment(libraries, docs)]
    got = QUERIES["op11_token_alignment"](spark, SF_SMALL).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(expected, key=str)


# --- filter audit --------------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def audit_by_hand(docs, labels):
    rows = []
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    for i, text, lang in docs:
        text = text or ""
        words = WORD.findall(text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text),
                 "E": i is not None and i > least[text]}
        rows.append((lang or "", {f for f, x in fails.items() if x}, i in good, i in toxic))
    out = []
    for part in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == part]
        steps, shapley = [], Counter()
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                before = set(order[:step - 1])
                gone = [r for r in own if f in r[0] and not r[0] & before]
                shapley[f] += len(gone)
                steps.append((f, (part, "".join(order), step, sum(not r[0] & (before | {f}) for r in own), len(gone),
                                  sum(f in r[0] and bool(r[0] & before) for r in own), sum(r[0] == {f} for r in own),
                                  sum(r[1] for r in gone), sum(r[2] for r in gone))))
        out += [(*s, shapley[f]) for f, s in steps]
    return sorted(out)


def test_audit_edges(spark):
    r = random.Random(7)
    texts = [None, "", " ", "word " * 300, "Loud " * 250, " ".join(f"w{i}" for i in range(250)), " ".join(f"w{i}" for i in range(250)) + " #",
             "ÀÉ " * 100, " ".join(f"W{i}" for i in range(220)), "x\x0by\x1cz", "short $"]
    docs = [(r.choice([None, *range(40)]), r.choice(texts), r.choice([None, "", "en", "fr", "fr", "fr"])) for _ in range(400)]
    docs += [(50 + i, texts[5], "fr") for i in range(200)]                    # a hot text
    docs += [(7, texts[3], "fr")] * 150                                       # a hot id
    labels = [(i % 60, i % 3 - 1, (i // 3) % 3 - 1) for i in range(200)] + [(None, 1, 1), (3, None, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(5)
    for c in ("part", "fails", "weight", "good", "h1", "chosen"):
        d = d.withColumn(c, F.lit("x"))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit("x"))
    expected = audit_by_hand(docs, labels)
    for stretch, hot in ((audit.STRETCH, audit.HOT), (7, 1), (1, 3)):
        got = sorted(tuple(x) for x in audit.audit(d, marks, stretch, hot).collect())
        assert got == expected
    assert audit.audit(d.limit(0), marks).collect() == []
    alone = audit.audit(d, marks.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(alone) == (0, 0)
