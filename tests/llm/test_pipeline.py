"""Registered corpus queries and the pipeline, each stage against a brute-force
version on its own input."""

from __future__ import annotations

import collections
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hazrank.llm import exact_dedup, simhash
from hazrank.llm.common import documents, staged
from hazrank.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for name_ in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name_} AS SELECT * FROM '{SF}/{name_}.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_queries_have_one_row_per_document(spark):
    n = documents(spark, SF).count()
    for name in ("op4_simhash", "op6_pii", "op7_fingerprints", "op8_token_files", "op9_suffix_dedup", "op10_toxicity"):
        assert QUERIES[name](spark, SF).count() == n, name


def test_stages_do_their_work(spark):
    docs = documents(spark, SF)
    columns = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF))
        out[name] = docs
        if name != "packing":
            assert docs.columns == columns
    ids = {k: [(r.doc_id, r.text) for r in v.collect()] for k, v in out.items() if k != "packing"}
    assert set(ids["toxicity"]) <= {(r.doc_id, r.text) for r in documents(spark, SF).collect()}

    groups = collections.defaultdict(list)
    for d, t in ids["toxicity"]:
        groups[exact_dedup.normal(t)].append(d)
    assert sorted(d for d, _ in ids["exact_dedup"]) == sorted(max(g) for g in groups.values())

    prints = [(d, simhash.fingerprint(t)) for d, t in ids["exact_dedup"]]
    low = {d: d for d, _ in prints}
    for _ in range(len(prints)):
        before = dict(low)
        for d, p in prints:
            for e, q in prints:
                if (p ^ q).bit_count() <= 2:
                    low[d] = low[e] = min(low[d], low[e])
        if low == before:
            break
    assert sorted(d for d, _ in ids["simhash_near_dedup"]) == sorted(set(low.values()))

    times = collections.Counter(d for d, _ in ids["mix_sources"])
    assert set(times) <= {d for d, _ in ids["simhash_near_dedup"]} and max(times.values()) <= 2

    pieces = out["packing"].collect()
    assert {r.doc_id for r in pieces} == set(times)
    tokens = sum(r.length for r in pieces)
    whole = collections.Counter()
    for r in pieces:
        whole[r.doc_id] = r.doc_tokens
    assert tokens == sum(whole[d] * n for d, n in times.items())


def test_rows_that_repeat_and_nulls_pass_every_stage(spark):
    schema = documents(spark, SF).schema
    rows = [(7, "the same text", "en", "a", 13)] * 3 + [(None, None, None, None, None), (None, "x", None, "b", 1), (8, "", "en", None, 0), (9, "other words here", "en", "b", 16)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF))
    assert {r.doc_id for r in docs.collect()} >= {7, 9}
    empty = spark.createDataFrame([], schema)
    for name, stage in corpus_pipeline.STAGES:
        empty = staged(stage(spark, empty, SF))
        assert empty.count() == 0 and (name == "packing" or empty.columns == schema.names)


def test_columns_of_any_name_pass_every_stage(spark):
    """Names that the stages use themselves."""
    extra = ["row", "_id", "_at", "text_key", "_text_key", "digest", "n", "score", "kept", "keep_id", "size", "slot", "part", "own", "passes", "length", "uid", "fingerprint", "row_number"]
    docs = documents(spark, SF).limit(60)
    wide = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in extra])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        wide = staged(stage(spark, wide, SF))
        assert wide.columns == docs.columns + extra, name
    rows = wide.collect()
    assert rows and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in extra)
    assert corpus_pipeline.STAGES[-1][1](spark, wide, SF).count() > 0


def test_exact_dedup_digest_is_of_the_normalised_text(spark):
    r = QUERIES["op2_exact_dedup"](spark, SF).first()
    text = {x.doc_id: x.text for x in documents(spark, SF).collect()}[r.doc_id]
    assert r.text_sha256 == hashlib.sha256(exact_dedup.normal(text)).hexdigest()
