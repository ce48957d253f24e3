"""Registered queries against SQL, and the pipeline's stages against their operators and brute force."""

from __future__ import annotations

import os
import zlib

import numpy as np
import oracle
import public_tokenizers
import pytest
from test_simhash import brute_components
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from sluice.llm import decontaminate, quality
from sluice.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} and len(QUERIES) == 13
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert oracle.compare(oracle.connect(SF_DIR), QUERIES[name](spark, SF_DIR), ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op12_spelling_variants"}))
def test_rows_of_queries_without_sql(spark, name):
    table = "pages" if name.startswith("op10") else "documents"
    column = "page_id" if table == "pages" else "doc_id"
    ids = {r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(column).collect()}
    assert {r[column] for r in QUERIES[name](spark, SF_DIR).collect()} == ids


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into and comes out of each stage."""
    rows, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = corpus_pipeline.materialise(stage(spark, rows, SF_DIR), name)
        out[name] = (rows, made)
        rows = made
    return out


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_stages_keep_the_columns(stages):
    for name, (before, after) in stages.items():
        if name != "best_fit_packing":
            assert after.dtypes == before.dtypes, name


def test_language_stage(stages):
    before, after = stages["language_id"]
    assert as_set(after) <= as_set(before)
    gone = as_set(before) - as_set(after)
    assert len(gone) <= 2  # the tables have texts in learned languages only


def test_quality_stage(stages):
    before, after = stages["quality_rules"]
    want = set()
    for r in before.collect():
        raw = (r.text or "").encode()
        words = raw.split()
        bad = len(words) < 20 or 100 * quality.repeat_words(words) > 30 * len(words)
        if not bad and not any(rule(raw, words) for rule in quality.RULES.values()):
            want.add(tuple(r))
    assert as_set(after) == want and 0 < len(want) < before.count()


def test_near_duplicate_stage(stages):
    before, after = stages["simhash_near_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    keep = {d for d, _, c in brute_components(rows, 4) if d == c}
    assert as_set(after) == {tuple(r) for r in before.collect() if r.doc_id in keep} and len(keep) < len(rows)


def test_decontamination_stage(spark, stages):
    before, after = stages["benchmark_decontamination"]
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    block = decontaminate.Items([(str(r.item_id), (r.text or "").encode()) for r in items.collect()], 10)
    old, new = ({r.doc_id: r for r in df.collect()} for df in (before, after))
    assert set(new) <= set(old)
    for doc_id, r in old.items():
        words = decontaminate.words_of((r.text or "").encode())
        spans, _ = block.hits(words)
        left = [w for i, w in enumerate(words) if not any(a <= i < b for a, b in spans)]
        if not spans:
            assert new[doc_id] == r
        elif left:
            assert decontaminate.words_of(new[doc_id].text.encode()) == left and new[doc_id].n_chars == len(new[doc_id].text)


def test_packing_stage_and_run(spark, stages):
    before, after = stages["best_fit_packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = set()
    for r in before.collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        first, at, number = len(ids) % 2048 or 2048, 0, 0
        while at < len(ids):
            size = 2048 if number else first
            want.add((r.doc_id, number, at, size, zlib.crc32(ids[at : at + size].tobytes())))
            at, number = at + size, number + 1
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert as_set(after.select(*columns)) == want
    assert as_set(entry.queries()["pipeline"](spark, SF_DIR).select(*columns)) == want


def test_stages_with_odd_rows(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, "", "en", "s", 0), (5, None, "xx", None, 1), (9_999, "1 2 3", "en", "s", 5)], documents.schema
    )
    good = documents.filter("length(text) > 400").limit(3)
    nameless = good.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "lang", "source", "n_chars")
    docs = documents.union(odd).union(good).union(nameless).withColumns({c: documents["doc_id"] for c in ("score", "kept", "row", "spans", "n_words")})
    rows = corpus_pipeline.materialise(docs, "odd")
    names = rows.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = corpus_pipeline.materialise(stage(spark, rows, SF_DIR), name)
        assert rows.columns == names
    ids = [r.doc_id for r in rows.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and None not in ids and len(ids) > 50
    empty = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).collect() == []
