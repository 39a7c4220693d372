"""Registered queries against their SQL, and the pipeline against a brute-force version."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import check_oracles
import corpus_pipeline
from basketry.llm import contamination, language_crf
from basketry.llm.queries import ORACLES, QUERIES
from test_dedup import brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracles.connect(SF)


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, con, name):
    outcome = check_oracles.compare(spark, con, SF, name)
    assert isinstance(outcome, int), outcome


def test_every_operator_is_registered():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert entry_point.queries()["pipeline"] is corpus_pipeline.run


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language_crf.identified(docs, language_crf.fitted(docs)).collect()
    spoken = {r.doc_id for r in found if r.lang_pred != "und" and r.confidence >= corpus_pipeline.LEAST_CONFIDENCE}
    texts = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id in spoken}
    last = {}
    for doc_id in sorted(texts):
        last[texts[doc_id]] = doc_id
    ids = sorted(last.values())
    roots, _ = brute_components([texts[i] for i in ids], 5, 80)
    ids = [i for k, i in enumerate(ids) if roots[k] == k]
    windows = {}
    for row in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        for phrase in contamination.phrases_of(row.text):
            windows.setdefault(len(phrase), set()).add(phrase)
    expected = {}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i in ids:
        words = contamination.words_of(texts[i])
        if not any(tuple(words[k : k + n]) in own for n, own in windows.items() for k in range(len(words) - n + 1)):
            coded = tokenizer.encode(texts[i], add_special_tokens=False).ids
            expected[i] = hashlib.sha256(np.array(coded, "<u4").tobytes()).hexdigest()
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: hashlib.sha256(bytes(r.ids)).hexdigest() for r in rows} == expected
    assert len(rows) == len(expected) and all(r.round_trip for r in rows)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
