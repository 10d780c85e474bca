"""Registered queries against DuckDB or brute force, over the whole tables of sf0.001."""

import os
import sys

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as entry_mod
from reelrec.llm.queries import ORACLE, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(__file__)))
sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
import brute  # noqa: E402
from brute import SF_SMALL  # noqa: E402
from check_oracle import digest, type_mismatches  # noqa: E402

TABLES = ("documents", "pages", "benchmark", "labels")


def rows_of(spark, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/{name}.parquet").select(*columns).collect()]


def test_registered():
    names = entry_mod.queries()
    assert set(QUERIES) <= set(names)
    assert {f"op{n}" for n in range(1, 14)} <= {q.split("_")[0] for q in QUERIES}
    assert "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    got, columns = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(ORACLE[name])
    expected_columns = [d[0] for d in res.description]
    assert type_mismatches(df, res) == []
    expected = res.fetchall()
    assert sorted(columns) == sorted(expected_columns)
    assert len(got) == len(expected) > 0
    assert digest(got, columns)[0] == digest(expected, expected_columns)[0]


def test_op2_brute(spark):
    got = sorted(tuple(r) for r in QUERIES["op2_ngram_join"](spark, SF_SMALL).collect())
    assert got == sorted(brute.components(rows_of(spark, "documents", "doc_id", "text")))


def test_op3_brute(spark):
    got = sorted(tuple(r) for r in QUERIES["op3_decontaminate"](spark, SF_SMALL).collect())
    assert got == sorted(brute.contamination(rows_of(spark, "documents", "doc_id", "text"), rows_of(spark, "benchmark", "item_id", "text")))
    assert any(r[5] for r in got)


def test_op4_brute(spark):
    rows = rows_of(spark, "documents", "doc_id", "text")
    found = QUERIES["op4_substring_dedup"](spark, SF_SMALL).collect()
    assert all(r["ref_doc_id"] < r["doc_id"] and r["stop"] - r["start"] >= 50 for r in found)
    covered = {}
    for r in found:
        covered.setdefault(r["doc_id"], set()).update(range(r["start"], r["stop"]))
    need = brute.repeated(rows)
    assert sum(map(len, need.values())) > 1000
    missed = {i: len(n - covered.get(i, set())) for i, n in need.items() if n - covered.get(i, set())}
    assert missed == {}
    loose = brute.repeated(rows, 12)
    assert [i for i, c in covered.items() if not loose[i] & c] == []


def test_op5_finds_every_notice_line(spark):
    notices = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC", "Released under the MIT License.": "MIT", "All rights reserved.": "Proprietary",
               "This work is licensed under the GNU General Public License, version 3.": "GPL",
               "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
    sf = SF_SMALL.replace("0.001", "0.01")
    expected = {(r["doc_id"], k, notices[line]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
                for k, line in enumerate(r["text"].split("\n")) if line in notices}
    got = {(r["doc_id"], r["line"], r["family"]) for r in QUERIES["op5_license_scan"](spark, sf).collect() if r["confirmed"]}
    assert got == expected and expected


def test_op6_held_out_accuracy(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    lang = dict(rows_of(spark, "documents", "doc_id", "lang") if sf == SF_SMALL else
                [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()])
    rows = QUERIES["op6_language_id"](spark, sf).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and len(held) > 150
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_op9_whole_texts(spark):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    expected = {(i, len(t.encode()), len(sp.encode(t)), len(sp.encode(t)) > 4096) for i, t in rows_of(spark, "documents", "doc_id", "text")}
    assert {tuple(r) for r in QUERIES["op9_token_counts"](spark, SF_SMALL).collect()} == expected


def test_op9_long_documents_are_spliced(spark, monkeypatch):
    from reelrec.llm import tokens

    calls, enc = [], tokens.Encoder()
    monkeypatch.setattr(tokens, "Encoder", lambda model: enc)
    spliced = tokens.spliced_count
    monkeypatch.setattr(tokens, "spliced_count", lambda e, text, chunk, overlap: calls.append(text) or spliced(e, text, chunk, overlap))
    texts = [t for _, t in rows_of(spark, "documents", "doc_id", "text")]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array([0] * len(texts), pa.int64()), pa.array(texts)],
                                       names=["doc_id", "n_bytes", "text"])
    out = next(tokens._count_batches(tokens.MODEL, tokens.CHUNK, tokens.OVERLAP)([batch]))
    assert out.column("n_tokens").to_pylist() == enc.counts(texts)
    assert len(calls) >= 0.9 * sum(len(t) > 1.5 * tokens.CHUNK for t in texts) > 0


def test_op10_statistics_and_verdicts(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op10_quality_rules"](spark, SF_SMALL).collect()}
    for i, t in rows_of(spark, "documents", "doc_id", "text"):
        r, s = rows[i], brute.statistics(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == s
        assert r["base_failed"] == (s[0] < 10 or 100 * s[4] > 20 * s[0])
        assert not (r["base_failed"] and r["kept"])
    quality = dict(rows_of(spark, "labels", "doc_id", "quality"))
    good = [rows[i]["kept"] for i, q in quality.items() if q == 1 and not rows[i]["base_failed"]]
    bad = [rows[i]["kept"] for i, q in quality.items() if q == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.2 * len(bad)
