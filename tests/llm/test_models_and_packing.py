"""Language, toxicity and packing, and the pipeline as a whole."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starfold.llm.language_id import identify, keep_identified, letter_stream, prototypes
from starfold.llm.packing import _encoders, best_fit_decreasing, bins_needed, cuts, pack, pack_documents, token_ids
from starfold.llm.simhash import RADIUS
from starfold.llm.toxicity import chain, chain_back, fit, marginals, score_documents, train

from .conftest import by_id, words
from .test_dedup import brute_components, brute_fingerprint, normal

SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoders():
    import public_tokenizers

    return _encoders(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def exact_ids(text, exact):
    return exact.encode(text, add_special_tokens=False).ids


def test_both_tokenizers_give_the_same_ids(encoders):
    plain = "".join(chr(c) for c in [10, *range(32, 127), *range(0xA1, 0x250)])
    texts = [f"{c}{c} a{c}b {c}1 '{c}" for c in plain] + [plain, "it's  we'll\n\n x\n ", " ", "", "<|endoftext|> x", "\t　 ", "😀é漢", "a" * 5000, " " * 5000, "\n " * 3000]
    for text in texts:
        assert token_ids(text, *encoders).tolist() == exact_ids(text, encoders[0]), text[:40]


def test_cuts():
    assert cuts(1) == [(0, 1)] and cuts(1024) == [(0, 1024)]
    assert cuts(2500) == [(0, 452), (452, 1024), (1476, 1024)]


def test_best_fit_fills_bins_and_the_bound_holds():
    rng = np.random.default_rng(1)
    for size in (1, 7, 500):
        lengths = rng.integers(1, 1025, size)
        bins, offsets = best_fit_decreasing(lengths)
        filled = np.bincount(bins, lengths)
        assert filled.max() <= 1024 and bins_needed(lengths) <= len(filled)
        for number in range(len(filled)):
            own = sorted(zip(offsets[bins == number].tolist(), lengths[bins == number].tolist(), strict=True))
            assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False)) and own[0][0] == 0
    assert bins_needed(np.array([600] * 5)) == 5 and bins_needed(np.array([], int)) == 0


def test_partitions_with_gaps_exchange_pieces(spark):
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 1024, 3000).tolist()
    rows = spark.createDataFrame(list(enumerate(lengths)), "row long, length long")
    alone = pack(rows, size=100, rounds=0).select("part", "bin").distinct().count()
    packed = pack(rows, size=100, rounds=3).toPandas()
    assert sorted(packed.row) == list(range(3000))
    groups = packed.groupby(["round", "part", "bin"])
    assert groups.length.sum().max() <= 1024
    assert len(groups) < alone and len(groups) >= -(-sum(lengths) // 1024)
    ordered = packed.sort_values("offset").groupby(["round", "part", "bin"]).length
    assert (ordered.cumsum() - packed.sort_values("offset").length == packed.sort_values("offset").offset).all()


def check_packing(rows, got, exact):
    """Pieces rebuild their documents and lie gapless in sequences of 1024 at most."""
    assert got.groupby("sequence_id").length.sum().max() <= 1024
    ordered = got.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    for doc_id, text in rows:
        ids = np.array([*exact_ids(text or "", exact), 2], "<u4")
        own = got[got.doc_id == doc_id].sort_values("piece")
        assert own.piece.tolist() == list(range(len(own))) and own.length.sum() == len(ids)
        for piece in own.itertuples():
            assert zlib.crc32(ids[piece.start : piece.start + piece.length].tobytes()) == piece.ids_crc32


def test_pack_documents(docs, encoders):
    rows = [(i, " ".join(words(i, 40 * i))) for i in range(1, 30)] + [(100, None), (101, ""), (102, "b " * 30_000), (103, "<|endoftext|> é漢😀")]
    check_packing(rows, pack_documents(docs(*rows)).toPandas(), encoders[0])
    assert pack_documents(docs()).collect() == []
    twice = pack_documents(docs((1, "a"), (1, "a"), (None, "b"))).toPandas()
    assert len(twice) == 3 and twice.sequence_id.nunique() == 1


def test_language(docs, spark):
    langs = {"aa": "the ring was shining over the old house ", "bb": "der alte schuh und eine wurst auf dem tisch ", "cc": None}
    rows = [(k, langs["aa" if k % 2 else "bb"] * (1 + k % 5), "aa" if k % 2 else "bb") for k in range(40)]
    rows += [(90, None, "aa"), (91, "1234 !!", "bb"), (92, langs["aa"], None), (93, "ß", None), (94, "shining house " * 9000, None)]
    table = docs(*rows)
    known = prototypes(table)
    assert list(known) == ["aa", "bb"]
    got = by_id(identify(table, known))
    assert all(got[k].lang_pred == lang and 0 < got[k].score <= 1 for k, _, lang in rows[:40])
    assert [(got[k].lang_pred, got[k].score) for k in (90, 91)] == [("und", 0.0)] * 2
    assert got[92].lang_pred == "aa" and got[94].lang_pred == "aa"
    kept = keep_identified(table)
    assert kept.columns == table.columns and kept.count() == len(rows) - 2
    assert {r.lang_pred for r in identify(table, {}).collect()} == {"und"}
    assert keep_identified(docs()).collect() == [] and identify(docs(), known).collect() == []
    assert identify(docs((1, "a"), (1, "a")), known).count() == 2


def test_letter_stream_bounds_words():
    assert letter_stream("12 -").tolist() == []
    assert letter_stream("Ab, c!").tolist() == [0, 97, 98, 0, 99, 0]


def test_language_held_out_accuracy(spark):
    from starfold.llm.language_id import language_table

    documents = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    got = language_table(documents).join(documents.select("doc_id", "lang"), "doc_id").toPandas()
    assert (got[got.held_out].lang_pred == got[got.held_out].lang).mean() > 0.95
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == h for i, h in zip(got.doc_id, got.held_out, strict=True))


def test_marginals_match_enumeration():
    rng = np.random.default_rng(5)
    transition, start = np.exp(rng.normal(size=(2, 2))), 0.3
    sequences = [rng.normal(size=n) * 2 for n in (1, 4, 7, 7, 0)]
    for emission, got in zip(sequences, marginals(sequences, transition, start), strict=True):
        n, total, ones = len(emission), 0.0, np.zeros(len(emission))
        for state in range(2**n if n else 0):
            path = [state >> t & 1 for t in range(n)]
            weight = (start if path[0] else 1.0) * np.exp(sum(e for e, s in zip(emission, path, strict=True) if s))
            for a, b in zip(path, path[1:], strict=False):
                weight *= transition[a, b]
            total += weight
            ones += weight * np.array(path)
        assert np.allclose(got, ones / total if n else ones)


def test_chain_stays_in_bounds():
    odds = np.exp(np.tile([[12.0], [-12.0]], (5000, 1)))
    transition = np.array([[1.2, 0.002], [0.7, 0.02]])
    assert np.isfinite(chain(odds, transition, 0.1)).all() and np.isfinite(chain_back(odds, transition)).all()


def test_toxicity(docs, frame):
    bad = ["vile", "nasty", "rotten"]
    rows, labels = [], []
    for k in range(240):
        text = words(k, 40)
        if k % 4 == 0:
            text[5], text[20] = bad[k // 4 % 3], bad[(k // 4 + 1) % 3]
        rows.append((k, " ".join(text)))
        labels.append((k, 0, int(k % 4 == 0)))
    extra = [(500, None), (501, ""), (502, "123"), (503, "so VILE and Nasty, rotten"), (504, "clean words " * 30_000), (504, "clean")]
    table = docs(*rows, *extra)
    field = train(table, frame("doc_id long, quality int, toxic int", *labels, (0, 1, None), (None, 0, 1), (4, 0, 0)))
    got = {}
    for r in score_documents(table, field).collect():
        got.setdefault(r.doc_id, []).append(r)
    right = sum(got[k][0].predicted == int(k % 4 == 0) for k in range(240))
    assert right >= 230
    assert all(0 <= r.score <= 1 for own in got.values() for r in own)
    assert [got[k][0].predicted for k in (500, 501, 502)] == [0, 0, 0] and len(got[504]) == 2
    assert got[503][0].predicted == 1 and got[503][0].spans.startswith("3:7")
    assert score_documents(docs(), field).collect() == []


def test_toxicity_without_labels(docs, frame):
    field = train(docs((1, "a")), frame("doc_id long, quality int, toxic int"))
    assert [r.predicted for r in score_documents(docs((1, "a b")), field).collect()] == [0]
    assert fit([], np.zeros(0, np.int64)).score(np.zeros(0)) < 0.1


def test_pipeline_against_brute_force(spark, encoders):
    """Every stage on what its predecessor kept."""
    documents = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{SAMPLE}/benchmark.parquet").collect()}
    rows = sorted((r.doc_id, r.text) for r in documents.collect())

    def run(name, docs):
        out = dict(corpus_pipeline.STAGES)[name](spark, docs, SAMPLE)
        assert name == "packing" or out.columns == docs.columns
        return out.cache()

    one = run("language_id", documents)
    expected = [(i, t) for i, t in rows if any(c.isalpha() for c in t or "")]
    assert sorted((r.doc_id, r.text) for r in one.collect()) == expected

    two = run("exact_dedup", one)
    seen: dict[str, int] = {}
    for i, t in expected:
        seen.setdefault(normal(t), i)
    expected = [(i, t) for i, t in expected if seen[normal(t)] == i]
    assert sorted((r.doc_id, r.text) for r in two.collect()) == expected

    three = run("near_dedup", two)
    component = brute_components([brute_fingerprint(t) for _, t in expected], [i for i, _ in expected], RADIUS)
    expected = [(i, t) for i, t in expected if component[i] == i]
    assert sorted((r.doc_id, r.text) for r in three.collect()) == expected

    four = run("decontamination", three)
    spread = {k: f" {' '.join(t.split())} " for k, t in bench.items()}
    expected = [(i, t) for i, t in expected if not any(b in f" {' '.join(t.split())} " for b in spread.values())]
    got = sorted((r.doc_id, r.text) for r in four.collect())
    assert set(got) <= set(expected) and len(expected) - len(got) <= 2  # an item beside other signs

    five = run("packing", four).toPandas()
    check_packing(got, five, encoders[0])
    for cached in (one, two, three, four):
        cached.unpersist()


def test_pipeline_handles_odd_tables(spark, tmp_path):
    spark.read.parquet(f"{SAMPLE}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    documents = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    odd = documents.limit(0).unionByName(
        spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (2, "a b", "en", "s", 3), (2, "a b", "en", "s", 3)], documents.schema)
    ).withColumns({"row": F.lit(1), "fp": F.lit("x"), "size": F.lit(2)})
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [(r.doc_id, r.length) for r in rows] == [(2, 3)]
    odd.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
