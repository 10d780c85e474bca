"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelrec.llm import (decontaminate, graph, langid, licenses, mixing, ngram_join, quality, substring, tokens, url_filter, warc)

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
from brute import docs_of  # noqa: E402, F401

rng = random.Random(3)
VOCABULARY = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(600)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def odd_rows():
    base = prose(200, 1).split(" ")
    edited = base.copy()
    edited[50] = "changed"
    far = base[:100] + prose(100, 2).split(" ")
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One  two"), (6, " ".join(base)), (7, " ".join(edited)),
            (8, " ".join(base).upper()), (9, " ".join(far)), (6, " ".join(base)), (None, " ".join(base)), (10, "a b c d e"),
            (11, "a b c d e f"), (12, "Été über 你好 " * 3), (13, "été über 你好 " * 3), (None, None)]


def clashing(df):
    """Extra columns named like the operators' own."""
    for name in ("size", "n", "cid", "target", "start", "stop", "k", "share", "token", "llr", "digest", "words", "verdict"):
        df = df.withColumn(name, F.lit("x"))
    return df


# --- n-gram join ---------------------------------------------------------------------------------

def near(df, **kw):
    return sorted(((r[0], r[1], r[2]) for r in ngram_join.near_duplicates(df, **kw).collect()), key=str)


def test_ngram_join_edges(docs_of):
    rows = odd_rows()
    assert near(clashing(docs_of(rows))) == sorted(brute.components(rows), key=str)
    assert near(docs_of(rows).limit(0)) == []


def test_ngram_join_chain_of_near_copies(docs_of):
    """Each text is similar to the next one only: one component through links, whatever the pivots."""
    base, rows = prose(120, 5).split(" "), []
    for i in range(60):
        rows.append((i, " ".join(base)))
        base = base.copy()
        base[(i * 7) % 120] = f"new{i}"
    rows += [(100 + i, prose(80, 50 + i)) for i in range(20)]
    assert near(docs_of(rows)) == sorted(brute.components(rows), key=str)


def test_ngram_join_hot_passage_and_many_fragments(docs_of):
    """A passage in most documents links none of them; copies of one document are one class."""
    shared = prose(40, 9)
    rows = [(i, shared + " " + prose(20 + i % 7 * 10, 200 + i)) for i in range(120)]
    rows += [(500 + i, rows[3][1]) for i in range(40)] + [(600 + i, rows[5][1] + f" tail{i}") for i in range(40)]
    expected = sorted(brute.components(rows), key=str)
    assert near(docs_of(rows, 5)) == expected
    assert near(docs_of(rows, 2), fragment=500) == expected


def test_ngram_join_at_the_threshold(docs_of):
    """75 % exactly links; one shingle less does not."""
    w = [f"w{i}" for i in range(400)]
    rows = []
    for k, cut in enumerate((60, 61, 62, 63, 64, 65, 66, 67, 68, 70)):
        rows += [(10 * k, " ".join(f"g{k}{x}" for x in w[:200])),
                 (10 * k + 1, " ".join([f"g{k}{x}" for x in w[:200 - cut]] + [f"h{k}{x}" for x in w[:20]]))]
    assert near(docs_of(rows)) == sorted(brute.components(rows), key=str)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    e = spark.createDataFrame(edges, "a long, b long")
    got = {r["v"]: r["c"] for r in graph.merge(spark.createDataFrame([], "v long, c long"), e).collect()}
    assert {got[i] for i in range(1, 41)} == {1} and {got[i] for i in range(100, 130)} == {100}
    again = graph.merge(spark.createDataFrame(list(got.items()), "v long, c long"), spark.createDataFrame([(40, 129)], "a long, b long"))
    assert {r["c"] for r in again.collect()} == {1}


# --- substring dedup --------------------------------------------------------------------------

def covered(df, **kw):
    out = {}
    for r in substring.passages(df, **kw).collect():
        assert r["ref_id"] < r["doc_id"]
        out.setdefault(r["doc_id"], set()).update(range(r["start"], r["stop"]))
    return out


def test_substring_edges(docs_of):
    assert covered(docs_of(odd_rows()).limit(0)) == {}
    got = covered(clashing(docs_of(odd_rows())))
    assert set(got) == {7, 8, 9} and len(got[8]) == 200 and len(got[7]) == 200 and 95 <= len(got[9]) <= 110


def test_substring_fuzzy_passage_found_whole(docs_of):
    passage = prose(80, 11).split(" ")
    edited = passage.copy()
    edited[20], edited[55] = "xx", "yy"
    del edited[40]
    rows = [(1, prose(100, 12) + " " + " ".join(passage) + " " + prose(60, 13)), (2, prose(70, 14) + " " + " ".join(edited) + " " + prose(90, 15)),
            (3, prose(300, 16)), (4, prose(50, 17) + " " + " ".join(passage[:30]) + " " + prose(50, 18))]
    got = covered(docs_of(rows))
    assert set(got) == {2} and got[2] >= set(range(72, 147)) and got[2] <= set(range(66, 153))


def test_substring_parts_that_occur_earlier_elsewhere(docs_of):
    """The passage's halves first occur in two other documents, the whole in a third."""
    p = prose(90, 21).split(" ")
    rows = [(1, prose(40, 22) + " " + " ".join(p[:45])), (2, " ".join(p[45:]) + " " + prose(40, 23)),
            (3, prose(30, 24) + " " + " ".join(p) + " " + prose(30, 25)), (4, prose(35, 26) + " " + " ".join(p) + " " + prose(20, 27))]
    assert covered(docs_of(rows))[4] >= set(range(35, 125))


def test_substring_whole_behind_halves(docs_of):
    """Only one earlier document has the whole passage; of each half the first and the last earlier document have no more."""
    p = prose(60, 51).split(" ")
    halves = [" ".join(p[:30]), " ".join(p[30:]), " ".join(p)] * 2
    rows = [(i + 1, prose(20 + i, 520 + i) + " " + t + " " + prose(25 + i, 540 + i)) for i, t in enumerate(halves)]
    need = {i: n for i, n in brute.repeated(rows).items() if n}
    assert set(need) == {6}
    for parts, fragment in ((1, substring.FRAGMENT), (4, 20)):
        got = covered(docs_of(rows, parts), fragment=fragment)
        assert set(got) == {6} and got[6] >= need[6] and len(got[6]) <= 66


def test_substring_hot_passage(docs_of):
    p = prose(70, 31)
    rows = [(i, prose(30, 300 + i) + " " + p + " " + prose(30, 400 + i)) for i in range(150)]
    for parts, fragment in ((1, substring.FRAGMENT), (6, 20)):
        got = covered(docs_of(rows, parts), fragment=fragment)
        assert set(got) == set(range(1, 150)) and all(c >= set(range(30, 100)) and len(c) <= 76 for c in got.values())


def test_substring_frequent_passages_whose_halves_come_first(docs_of):
    rows = []
    for g in range(8):
        p = prose(60, 560 + g).split(" ")
        texts = [" ".join(p[:30]), " ".join(p[30:])] + [" ".join(p)] * 40
        rows += [(100 * g + i, prose(21, 6000 + 100 * g + i) + " " + t + " " + prose(22, 7000 + 100 * g + i)) for i, t in enumerate(texts)]
    need = {i: n for i, n in brute.repeated(rows).items() if n}
    assert len(need) == 8 * 39
    for parts in (1, 5):
        got = covered(docs_of(rows, parts))
        assert set(got) == set(need) and all(got[i] >= n and len(got[i]) <= 66 for i, n in need.items())


def test_substring_passage_quoted_more_often_than_before(docs_of):
    p = prose(60, 571)
    rows = [(1, prose(20, 572) + " " + p + " " + prose(30, 573)), (2, p + " " + prose(90, 574) + " " + p + " " + prose(70, 575) + " " + p),
            (3, prose(25, 576) + " " + p + " " + prose(80, 577) + " " + p)]
    need = {i: n for i, n in brute.repeated(rows).items() if n}
    assert {i: len(n) for i, n in need.items()} == {2: 180, 3: 120}
    got = covered(docs_of(rows))
    assert set(got) == {2, 3} and all(got[i] >= n and len(got[i]) <= len(n) + 18 for i, n in need.items())


def between(copies):
    """An edited passage whose seeds all occur earlier in pieces too short for a chain, before and behind the one document that has it."""
    p = prose(100, 581).split(" ")
    pieces = [" ".join(p[k:k + 20]) for k in range(0, 90, 10)] * copies
    lone = lambda first, t, k: (first + k, prose(20, first + k) + " " + t + " " + prose(20, 5 * first + k))
    edited = [f"x{k}" if k % 20 == 10 else w for k, w in enumerate(p)]
    return ([lone(10_000, t, k) for k, t in enumerate(pieces)] + [lone(30_000, t, k) for k, t in enumerate(pieces)] +
            [(20_000, prose(30, 582) + " " + " ".join(p) + " " + prose(30, 583)), (40_000, prose(25, 584) + " " + " ".join(edited) + " " + prose(25, 585))])


@pytest.mark.parametrize("copies", [1, 3, 12])
def test_substring_edited_passage_between_first_and_previous(docs_of, copies):
    for parts, fragment in ((1, substring.FRAGMENT), (4, 300)):
        got = covered(docs_of(between(copies), parts), fragment=fragment)
        assert set(got) == {40_000} and got[40_000] >= set(range(25, 125)) - {35} and len(got[40_000]) <= 106


def test_substring_keys_of_what_links_leave_out():
    """A frequent seed makes keys with those 16 to 104 words away only, and asks where no passage has it."""
    place, key = np.array([0, 8, 20, 130, 300]), np.array([4, 8, 12, 16, 20]) + [substring.MANY, substring.MANY, substring.MANY, substring.MANY, substring.FEW]
    keys, places, asks = substring.candidate_keys(place, key, None)
    assert sorted(places) == [0, 300] and asks.all() and 20 + substring.FEW in keys
    assert not substring.candidate_keys(place, key, [{"start": 0, "stop": 400}])[2].any()
    near = substring.candidate_keys(np.array([0, 30]), np.array([4 + substring.NONE, 8 + substring.MANY]), [{"start": 0, "stop": 10}])
    assert near[2].tolist() == [True] and near[0].tolist() == [4]


def test_substring_candidates_of_a_frequent_text(docs_of, monkeypatch):
    """Documents that share 30 words only are no candidates; one that goes on alike, without a further seed, is found."""
    pairs, write = [], substring.written

    def counted(df, tag):
        out = write(df, tag)
        if tag == "rest-pairs":
            pairs.extend((r["doc_id"], r["ref_id"]) for r in out.collect())
        return out

    monkeypatch.setattr(substring, "written", counted)
    p = prose(90, 591).split(" ")
    edited = [f"x{k}" if k >= 30 and k % 6 == 0 else w for k, w in enumerate(p)]
    lone = [(i, prose(30, 1300 + i) + " " + " ".join(p[:30]) + " " + prose(30, 1400 + i)) for i in (*range(30), *range(100, 130))]
    rows = lone + [(50, prose(20, 592) + " " + " ".join(p)), (150, prose(25, 593) + " " + " ".join(edited))]
    got = covered(docs_of(rows))
    assert set(got) == {150} and got[150] >= set(range(25, 110))
    assert (150, 50) in pairs and len(pairs) < len(rows)


def test_substring_ends_of_runs():
    """Two documents with a run of 24 words meet at its end only if two words agree again behind unlike ones."""
    words = np.arange(100, 200, dtype="<u4")
    other, third = words.copy(), words.copy()
    other[60], third[60:] = 7, np.arange(300, 340)

    def met(a, b):
        ends = [substring._run_ends(w.astype(np.uint64), np.array([30, 45, 52]), np.array([45])) for w in (a, b)]
        forks = {k: m for k, m in zip(*ends[0][:2])}
        unlike = [np.array([k in forks and forks[k] != m for k, m in zip(*e[:2])]) for e in ends[1:]]
        at = ends[1][2][unlike[0]]
        keys = [dict(zip(*substring.end_keys(w, at, np.ones(len(at), dtype=bool))[:2])) for w in (a, b)]
        return len(at), sum(k in keys[1] and keys[1][k] != m for k, m in keys[0].items())

    assert met(words, other)[0] and met(words, other)[1]
    assert met(words, third)[0] and not met(words, third)[1]
    assert met(words, words) == (0, 0)


def test_substring_cut(docs_of):
    p = prose(60, 41)
    rows = [(1, "start " + p + " end"), (2, "Keep this,\n" + p + "\n  and that. "), (3, p), (4, None), (None, p)]
    docs = docs_of(rows)
    left = {r["doc_id"]: r for r in substring.cut(docs, substring.passages(docs)).collect()}
    assert set(left) == {1, 2, 4, None}
    assert left[1]["text"] == rows[0][1] and left[2]["text"] == "Keep this,\nand that. " and left[2]["n_chars"] == len(left[2]["text"])


def test_substring_rows_of_one_id_with_other_texts(docs_of):
    p, other = prose(60, 41), prose(300, 42)
    rows = [(1, p), (5, "start " + p + " end"), (5, other), (5, other), (6, other[:1500]), (None, p), (7, None), (7, p)]
    docs = docs_of(rows)
    got = sorted(((r["doc_id"], r["text"]) for r in substring.without_repeats(docs).collect()), key=str)
    assert got == sorted([(1, p), (5, "start end"), (5, other), (5, other), (None, p), (7, None)], key=str)
    found = {(r["doc_id"], r["ref_id"]) for r in substring.passages(docs).collect()}
    assert found == {(5, 1), (6, 5), (7, 1)}


def test_fenwick_chains_equal_quadratic_ones():
    r = random.Random(7)
    for _ in range(60):
        seg = sorted({(r.randrange(200), r.randrange(200), r.randrange(8, 20)) for _ in range(r.randint(1, 14))})
        best = [0.0] * len(seg)
        for j, (p, q, n) in enumerate(seg):
            gains = [best[i] - 0.25 * (p - a - m + q - b - m) for i, (a, b, m) in enumerate(seg[:j]) if a + m <= p and b + m <= q]
            best[j] = n + max([0.0, *gains])
        chain = substring.chains(seg)[0]
        score = sum(n for *_, n in chain) - 0.25 * sum(c[0] - a[0] - a[2] + c[1] - a[1] - a[2] for a, c in zip(chain, chain[1:]))
        assert score == pytest.approx(max(best))


# --- decontamination ---------------------------------------------------------------------------

def test_decontamination_edges(spark, docs_of):
    long = prose(30, 61)
    items = [(1, long), (2, "two words"), (3, "solo"), (4, ""), (None, None), (5, long), (None, "null id here"), (2, "two words"),
             (6, "ÉCOLE über alles")]
    docs = odd_rows() + [(20, "x " + long + " y " + long), (21, "Two, WORDS! two-words"), (22, "a solo b"), (23, "null id here"),
                         (24, "École Über alles"), (25, "ÉCole üBer ALLES"), (26, long.upper()), (20, "x " + long + " y " + long)]
    b = spark.createDataFrame(items, "item_id long, text string")
    for block in (200_000, 7):
        out = decontaminate.contamination(clashing(docs_of(docs)), clashing(b), block=block)
        got = [tuple(r)[:6] for r in out.collect()]
        assert sorted(got, key=str) == sorted(brute.contamination(docs, items), key=str)
    nothing = decontaminate.contamination(docs_of(docs), b.limit(0)).collect()
    assert len(nothing) == len(docs) and not any(r["contaminated"] for r in nothing)
    assert decontaminate.contamination(docs_of(docs).limit(0), b).count() == 0


# --- URL filters ----------------------------------------------------------------------------------

def test_url_filter_edges(spark):
    urls = [None, "", "no scheme", "http://", "https://A.Example.COM:443/Path/x.html?q#f", "http://a.example.com/Path/x", "ftp://net/es/x", "http://b.net/fr/",
            "http://xnet/es/", "http://www.example.com/en/p", "http://example.com/en/p", "http://example.com", "http://org/a", "http://org/a/", "https://org/a?x=1",
            "http://org/b", "http://u@org/a", "http://x.org/p\n", "http://x.org/p"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] * 2, "page_id long, url string")
    listed = spark.createDataFrame([("https://org/a/#z",), (None,), ("junk",), ("https://org/a",), ("http://x.org/p",)], "url string")
    for limit in (1 << 20, 0):
        out = url_filter.judge(clashing(pages), clashing(listed), broadcast_bytes=limit).collect()
        assert len(out) == 2 * len(urls)
        by = {r["page_id"]: r for r in out}
        assert (by[0]["host"], by[0]["path"], by[0]["rule"], by[0]["verdict"]) == ("", "", None, "allow")
        assert (by[4]["host"], by[4]["path"], by[4]["rule"]) == ("a.example.com:443", "/Path/x.html", None)
        assert by[6]["rule"] == "net/es/" and by[7]["verdict"] == "block" and by[8]["rule"] is None
        assert by[9]["rule"] == "www.example.com/en/" and by[10]["verdict"] == "block" and by[11]["rule"] is None
        assert [by[k]["verdict"] for k in (12, 13, 14, 15, 16, 18)] == ["block", "block", "block", "allow", "allow", "block"]
        assert by[18]["listed"] and not by[17]["listed"]
    assert url_filter.judge(pages.limit(0), listed).count() == 0
    assert {r["verdict"] for r in url_filter.judge(pages, listed.limit(0)).where("rule is null").collect()} == {"allow"}


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    listed = spark.range(4000).select(F.concat(F.lit("h/"), "id").alias("url"))
    blocks = -(-4000 * url_filter.BITS_PER_URL // 256)
    bloom = url_filter.bloom_filter(listed, blocks)
    asked = spark.range(12000).select(F.concat(F.lit("h/"), "id").alias("_canon"), "id")
    out = url_filter.possible_hits(asked, bloom, blocks).select("id", "_maybe").collect()
    assert all(r["_maybe"] for r in out if r["id"] < 4000)
    assert sum(r["_maybe"] for r in out if r["id"] >= 4000) < 80


# --- mixing ----------------------------------------------------------------------------------------

def test_water_filling_equals_clamping_rounds(spark):
    r = random.Random(9)
    for n in (1, 2, 5, 17):
        sizes = [r.choice([0, 1, 10, 1000, 5000]) * r.randint(1, 9) for _ in range(n)]
        s = spark.createDataFrame([(f"s{k:02}", x) for k, x in enumerate(sizes)], "source string, source_size long")
        got = [x["target"] for x in mixing.source_targets(s).orderBy("source").collect()]
        assert got == pytest.approx(brute.water_fill(sizes, [mixing.WEIGHTS[k % 3] for k in range(n)], 1.5 * sum(sizes), 2.0))


def test_mixing_edges(docs_of):
    rows = [(i, t, None, s) for (i, t), s in zip(odd_rows(), ["a", "b", None] * 9)] + [(90 + i, prose(40, i), None, "a") for i in range(40)]
    out = mixing.mix(clashing(docs_of(rows))).collect()
    assert len(out) == len(rows)
    total = {}
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"]
        t = total.setdefault(r["source"], [0, r["target"]])
        t[0] += r["taken"]
    assert all(abs(got - target) <= 0.5 for got, target in total.values())
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(docs_of(rows, 7)).collect()))
    assert mixing.mix(docs_of(rows).limit(0)).count() == 0


def test_mixing_rest_rounds_up_to_the_whole_source(docs_of):
    rows = [(1, "one two three", None, "a"), (2, "four five", None, "a")]
    out = mixing.mix(docs_of(rows), weights=(1,), share=0.92).collect()        # target 4.6 of 5
    assert {r["doc_id"]: r["taken"] for r in out} == {1: 3, 2: 2}


# --- tokens -----------------------------------------------------------------------------------------

def test_spliced_counts_equal_whole_ones():
    enc = tokens.Encoder()
    r = random.Random(4)
    texts = [prose(3000, 1), "a" * 5000, " " * 3000, "x  y   z " * 700, "é你 " * 900 + "q" * 900, "line\n" * 800, "▁ ▁a" * 500,
             "".join(r.choice("ab ü\n你 <s>") for _ in range(6000)), prose(300, 2) + " " + "xé" * 4000 + " " + prose(300, 3)]
    for text in texts:
        for chunk, overlap in ((200, 10), (1000, 40), (777, 1)):
            assert tokens.spliced_count(enc, text.encode(), chunk, overlap) == enc.counts([text])[0]


def test_long_stretch_without_spaces_is_not_encoded_again_and_again(monkeypatch):
    enc, seen = tokens.Encoder(), []
    starts = enc.starts
    monkeypatch.setattr(enc, "starts", lambda text: seen.append(len(text)) or starts(text))
    text = (prose(300, 2) + " " + "q" * 40000 + " " + prose(300, 3)).encode()
    assert tokens.spliced_count(enc, text, 500, 50) == enc.counts([text.decode()])[0]
    assert sum(seen) < 8 * len(text)


def test_token_edges(docs_of):
    rows = odd_rows() + [(30, prose(40000, 3))]
    enc = tokens.Encoder()
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in tokens.count_tokens(clashing(docs_of(rows))).collect()), key=str)
    assert got == sorted(((i, len((t or "").encode()), enc.counts([t or ""])[0]) for i, t in rows), key=str)
    assert tokens.count_tokens(docs_of(rows).limit(0)).count() == 0


# --- quality ---------------------------------------------------------------------------------------

def test_quality_edges(spark, docs_of):
    rows = odd_rows() + [(40, "a b c d e " * 3 + "\nx\nx\n \n \nx #*|"), (41, prose(200_000, 8)), (42, ("same line here now ok\n" * 60_000))]
    labels = spark.createDataFrame([(6, 1, 0), (9, 0, 0), (40, 0, 1), (None, 1, 0), (12, None, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality.judge(clashing(docs_of(rows)), clashing(labels)).collect()
    got = sorted((tuple(r[c] for c in ("doc_id", *quality.STAT_COLUMNS)) for r in out), key=str)
    assert got == sorted(((i, *brute.statistics(t)) for i, t in rows), key=str)
    assert quality.judge(docs_of(rows).limit(0), labels).count() == 0
    assert all(r["kept"] != r["base_failed"] for r in quality.judge(docs_of(rows), labels.limit(0)).collect())


# --- language ID -----------------------------------------------------------------------------------

def test_gradients_by_differences():
    r = np.random.default_rng(0)
    net = {k: v.astype(np.float64) for k, v in langid.new_network(3).items()}
    data, label, weight = r.integers(0, 256, (6, 5)).astype(np.uint8), np.array([0, 1, 2, 0, 1]), np.ones((6, 5))
    weight[4:, 2] = 0
    _, grad = langid.gradients(net, data, label, weight)
    for k in net:
        at = (int(data[2, 1]), 7) if k.endswith("_in") else tuple(int(r.integers(s)) for s in net[k].shape)
        net[k][at] += 1e-4
        up, _ = langid.gradients(net, data, label, weight)
        net[k][at] -= 2e-4
        down, _ = langid.gradients(net, data, label, weight)
        net[k][at] += 1e-4
        assert (up - down) / 2e-4 == pytest.approx(grad[k][at], rel=2e-2, abs=2e-5)


def test_every_language_is_trained(monkeypatch):
    seen, real = set(), langid.gradients
    monkeypatch.setattr(langid, "gradients", lambda net, data, label, weight: (seen.update(int(x) for x in label), real(net, data, label, weight))[1])
    languages = langid.TRAIN_BATCH + 10
    langid.train([(b"some words", k) for k in range(languages)], languages, steps=2)
    assert seen == set(range(languages))


def test_pooling_does_not_depend_on_the_batch(monkeypatch):
    net = langid.new_network(4)
    texts = [prose(n, n).encode() for n in (1, 5, 60, 300)] + [b"z", b""]
    whole = langid.pooled(net, texts)
    monkeypatch.setattr(langid, "BATCH", 3)
    assert np.allclose(whole, langid.pooled(net, texts), atol=1e-6)
    assert np.allclose(whole[2], langid.pooled(net, [texts[2]])[0], atol=1e-6)


def test_language_edges(docs_of):
    rows = [(i, " ".join(["the and of"] * 20), "en", None) for i in range(30)] + [(100 + i, " ".join(["über und der"] * 20), "de", None) for i in range(30)]
    rows += [(200, None, "en", None), (201, "", None, None), (202, "123 ... !!", "de", None), (None, "the and of the and", "en", None), (203, "the and of " * 60_000, None, None)]
    docs = clashing(docs_of(rows))
    out = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.classify(docs, langid.fit(docs)).collect()}
    assert out[200] == out[201] == out[202] == ("und", 0.0)
    assert out[0][0] == out[203][0] == out[None][0] == "en" and out[100][0] == "de"
    empty = docs.limit(0)
    assert langid.fit(empty) is None and langid.classify(empty, None).count() == 0
    assert {r["lang_pred"] for r in langid.classify(docs, None).collect()} == {"und"}


# --- licences ----------------------------------------------------------------------------------------

def test_license_edges(docs_of):
    rows = odd_rows() + [(50 + i, prose(30, i) + "\n" + prose(12, 900 + i)) for i in range(40)]
    rows += [(300, "Intro.\nReleased under the MIT License.\nmore"), (301, "all rights reserved"), (302, "rights of the public"),
             (300, "Intro.\nReleased under the MIT License.\nmore"), (None, "Licensed under the Apache License, Version 2.0.")]
    docs = clashing(docs_of(rows))
    model = licenses.fit(docs)
    got = {(r["doc_id"], r["line"], r["family"]) for r in licenses.scan(docs, model).collect() if r["confirmed"]}
    assert got == {(300, 1, "MIT"), (301, 0, "Proprietary"), (None, 0, "Apache-2.0")}
    assert licenses.scan(docs.limit(0), model).count() == 0
    assert licenses.fit(docs.limit(0)).classes == model.classes


def test_no_notice_is_confirmed_without_its_tell_tale_words():
    for text in (t for family in licenses.TEMPLATES.values() for t in family):
        words = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower()).split()
        grams = {" ".join(words[k:k + n]) for n in (2, 3) for k in range(len(words) - n + 1)}
        for confirm in (0.3, licenses.CONFIRM, 1.0):
            tell = licenses.tell_tale(words, sorted(grams), confirm)
            assert tell and sum(tell.isdisjoint(g.split()) for g in grams) < confirm * len(grams)


def test_license_wrapped_notices(docs_of):
    mit = ("# Permission is hereby granted, free of charge, to any person\n# obtaining a copy of this software and associated documentation\n"
           "# files (the \"Software\"), to deal in the Software without restriction.")
    gpl = "This program is free software:\nyou can redistribute it and/or modify it\nunder the terms of the GNU General Public\nLicense as published by the Free\nSoftware Foundation."
    rows = [(50 + i, prose(30, i) + "\n" + prose(12, 900 + i)) for i in range(40)]
    rows += [(300, "Intro words.\n\n" + mit + "\n\nmore"), (301, "Intro\n" + gpl + "\nmore\n" + prose(30, 3) + "\n" + gpl),
             (302, mit.replace("\n", "\n\n")), (303, "Released under\nthe MIT License."), (300, "Intro words.\n\n" + mit + "\n\nmore"),
             (304, " ".join(gpl.split("\n")) + "\nend"), (305, None)]
    docs = clashing(docs_of(rows))
    model = licenses.fit(docs)
    got = licenses.wrapped(docs, model).collect()
    assert sorted((r["doc_id"], r["line"], r["last_line"], r["family"]) for r in got) == [
        (300, 2, 4, "MIT"), (301, 1, 5, "GPL"), (301, 8, 12, "GPL"), (303, 0, 1, "MIT")]
    assert all(r["confirmed"] and 0 <= r["probability"] <= 1 for r in got)
    assert licenses.wrapped(docs.limit(0), model).count() == 0


# --- WARC ---------------------------------------------------------------------------------------------

def test_warc_round_trip(spark, scratch):
    big = prose(300, 71)
    rows = [(5, "http://a/é x\r\ny", big), (3, None, big), (9, "u", "short"), (10, "u", "short"), (11, "u", None), (12, "u", ""),
            (None, "u", big), (3, "u", big), (13, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (14, "u", "x" * 3_000_000)]
    pages = clashing(spark.createDataFrame(rows, "id long, uri string, body string").repartition(3))
    path = os.path.join(scratch, "archives")
    warc.write_archives(pages, path, per_archive=2)
    back = warc.read_archives(spark, path, glob="part-*").collect()
    assert len(back) == len(rows) and all(r["error"] is None for r in back)
    kinds = sorted(((r["record_id"], r["record_type"], r["refers_to"]) for r in back), key=str)
    responses = ["3", "3", "9", "10", "11", "12", "13", "14"]
    assert kinds == sorted([(i, "response", None) for i in responses] + [("5", "revisit", "3"), ("null", "revisit", "3")], key=str)
    bodies = {str(i): (b or "").encode() for i, _, b in rows if i is not None}
    for r in back:
        if r["record_type"] == "response":
            assert bytes(r["payload"]) == bodies[r["record_id"]] and r["payload_bytes"] == len(bodies[r["record_id"]])
        else:
            assert r["refers_to"] == "3" and r["payload_bytes"] == len(big)
    empty = os.path.join(scratch, "empty")
    warc.write_archives(pages.limit(0), empty)
    assert warc.read_archives(spark, empty, glob="part-*").count() == 0


def test_warc_reader_reports_damage():
    import zstandard

    record = warc.record_bytes("1", "u", b"hello" * 40, __import__("hashlib").sha256(b"hello" * 40).hexdigest(), "response", None)
    assert warc.parse_record(record)["error"] is None
    for bad in (record[:-1], record.replace(b"WARC/1.1", b"HTTP/1.1"), record.replace(b"WARC-Date", b"X-Date"), record.replace(b"hellohello", b"hellohellp", 1),
                record.replace(b"Content-Length: 2", b"Content-Length: 3"), record + b"x"):
        assert warc.parse_record(bad)["error"]
    frame = zstandard.ZstdCompressor(write_checksum=True).compress(record)
    archive = warc.dictionary_frame(b"hello world " * 50) + frame
    assert [e for *_, e in warc.frames(archive)] == [None]
    assert [bool(e) for *_, e in warc.frames(archive + frame[:-3])] == [False, True]
    assert [bool(e) for *_, e in warc.frames(archive + b"junkjunkjunk")] == [False, True]
    assert list(warc.frames(b"")) == []
