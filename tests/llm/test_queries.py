"""The registered queries on whole given tables."""

import hashlib
import zlib

import pytest
from oracle import connect, difference

import __spark_entry__ as contract
from starfold.llm.queries import ORACLES, QUERIES

from .test_dedup import brute_components, brute_fingerprint
from .test_text_operators import PII, SECRETS, joined, pii_holds

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def result(spark, name):
    return contract.queries()[name](spark, SF_DIR)


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_against_its_sql(spark, name):
    assert difference(result(spark, name), connect(SF_DIR), ORACLES[name]) is None


def test_op1_finds_every_item_that_stands_in_a_document(spark, texts):
    bench = {r.item_id: " ".join(r.text.split()) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    held = {(d, i) for d, t in texts.items() for i, b in bench.items() if b in " ".join(t.split())}
    got = {(r.doc_id, r.item_id) for r in result(spark, "op1_decontamination").collect()}
    assert held <= got and len(got - held) <= 2


def test_op3_and_op7_spans(spark, texts):
    def secret_holds(kind, match):
        import re

        if kind == "assign":
            return len(re.search(SECRETS["assign"], match)[1]) >= 6
        return len(match) >= (20 if kind == "access" else 24)

    for name, patterns, holds in (("op3_pii_spans", PII, pii_holds), ("op7_secret_scan", SECRETS, secret_holds)):
        rows = result(spark, name).collect()
        assert {r.doc_id for r in rows} == set(texts)
        for row in rows:
            base, kinds = joined(texts[row.doc_id], patterns, holds)
            assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
            assert [row[f"n_{k}"] for k in patterns] == [kinds.count(k) for k in patterns]


def test_op5_judges_every_page(spark):
    rows = result(spark, "op5_url_filter").collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/pages.parquet").count()
    assert {r.verdict for r in rows} <= {"allow", "block"}


def test_op6_components(spark, texts):
    ids = sorted(texts)
    values = [brute_fingerprint(texts[i]) for i in ids]
    expected = brute_components(values, ids)
    for row in result(spark, "op6_simhash_near_dedup").collect():
        assert row.fingerprint == f"{values[ids.index(row.doc_id)]:016x}"
        assert row.component_id == expected[row.doc_id]


def test_op9_and_op10_columns(spark, texts):
    for name in ("op9_toxicity", "op10_language_id"):
        rows = result(spark, name).collect()
        assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)


def test_op9_held_out_accuracy(spark):
    sf = SF_DIR.replace("0.001", "0.1")
    scored = contract.queries()["op9_toxicity"](spark, sf)
    labelled = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (labelled.predicted == labelled.toxic).mean() > 0.97
    assert labelled[labelled.toxic == 1].predicted.mean() > 0.85
