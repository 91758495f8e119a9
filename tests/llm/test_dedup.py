"""Exact and near deduplication against brute force."""

import hashlib
import re

import numpy as np
import xxhash

from starfold.llm.components import roots
from starfold.llm.exact_dedup import drop_exact_copies, duplicate_groups
from starfold.llm.simhash import RADIUS, drop_near_copies, fingerprint, links, near_duplicates, tile_links

from .conftest import by_id, words


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_groups_match_brute_force(docs):
    texts = [None, "", " ", "a b", "a\tb", "a  b", "A b", "x y", "x y", "a b ", "z" * 200_000, "z" * 200_000]
    rows = [(len(texts) - i, t) for i, t in enumerate(texts)]
    got = by_id(duplicate_groups(docs(*rows)))
    for doc_id, text in rows:
        same = [i for i, t in rows if normal(t) == normal(text)]
        row = got[doc_id]
        assert (row.keep_id, row.group_size, row.kept) == (min(same), len(same), doc_id == min(same))
        assert row.text_sha256 == hashlib.sha256(normal(text).encode()).hexdigest()


def test_heavy_digests_are_split_from_the_rest(docs):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i // 2}") for i in range(300)]
    few = duplicate_groups(docs(*rows), counters=5).collect()
    many = duplicate_groups(docs(*rows), counters=1000).collect()
    assert sorted(few) == sorted(many)
    assert sum(r.kept for r in few) == len({t for _, t in rows})


def test_one_of_repeated_rows_and_null_ids_stays(docs):
    table = docs((5, "a"), (5, "a"), (None, "a"), (None, "b"), (None, "b"), (6, "b"), (5, "c"))
    got = duplicate_groups(table).collect()
    assert len(got) == 7 and sum(r.kept for r in got) == 3
    assert {r.keep_id for r in got if r.kept} == {5, 6}
    kept = drop_exact_copies(table)
    assert kept.columns == table.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(5, "a"), (5, "c"), (6, "b")]
    only_null = drop_exact_copies(docs((None, None), (None, ""))).collect()
    assert len(only_null) == 1


def test_empty_tables(docs):
    assert duplicate_groups(docs()).collect() == []
    assert drop_exact_copies(docs()).collect() == []
    assert near_duplicates(docs()).collect() == []
    assert drop_near_copies(docs()).collect() == []


def brute_fingerprint(text):
    found = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(found[k : k + 4]) for k in range(max(1, len(found) - 3))] if found else []
    counts = [0] * 64
    for shingle in shingles:
        value = xxhash.xxh64(shingle.encode(), seed=42).intdigest()
        for bit in range(64):
            counts[bit] += value >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def brute_components(values, ids, radius=RADIUS):
    component = dict(zip(ids, ids, strict=True))
    changed = True
    while changed:
        changed = False
        for i, a in zip(ids, values, strict=True):
            for j, b in zip(ids, values, strict=True):
                if (a ^ b).bit_count() <= radius and component[i] != component[j]:
                    component[i] = component[j] = min(component[i], component[j])
                    changed = True
    return component


def test_near_duplicates_match_brute_force(docs):
    rows = [(0, None), (1, ""), (2, "one two"), (3, "One  TWO"), (4, "ÀB c d e f"), (5, "àB c d e f"), (6, "x" * 100_000)]
    for k in range(8):
        base = words(k, 120)
        rows.append((10 + 10 * k, " ".join(base)))
        for copy in range(1, 4):
            base[17 * copy] = f"changed{k}{copy}"
            rows.append((10 + 10 * k + copy, " ".join(base)))
    table = docs(*rows)
    got = by_id(near_duplicates(table))
    values = [brute_fingerprint(text) for _, text in rows]
    expected = brute_components(values, [i for i, _ in rows])
    for (doc_id, text), value in zip(rows, values, strict=True):
        assert fingerprint(text or "") == value
        assert got[doc_id].fingerprint == f"{value:016x}"
        assert got[doc_id].component_id == expected[doc_id]
    kept = drop_near_copies(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))


def test_repeated_ids_leave_one_document(docs):
    table = docs((1, "a b c d e"), (1, "a b c d e"), (1, "quite other words here now"), (None, "a b c d e"))
    kept = [(r.doc_id, r.text) for r in drop_near_copies(table).collect()]
    assert len(kept) in (1, 2) and len(set(kept)) == len(kept)


def test_unlinked_texts_of_one_id_or_none_all_stay(docs):
    texts = ["a b c d e", "quite other words here now", *(" ".join(words(k, 40)) for k in range(3))]
    values = [brute_fingerprint(text) for text in texts]
    assert all((a ^ b).bit_count() > RADIUS for k, a in enumerate(values) for b in values[:k])
    for doc_id in (1, None):
        table = docs(*((doc_id, text) for text in texts), (doc_id, texts[0]), (doc_id, texts[1].upper()))
        kept = [r.text for r in drop_near_copies(table).collect()]
        assert len(kept) == len(texts) and {text.lower() for text in kept} == set(texts)
    table = docs((1, texts[0]), (1, texts[0]), (1, texts[1]), (None, texts[0]))
    assert sorted((r.doc_id, r.text) for r in drop_near_copies(table).collect()) == [(1, texts[0]), (1, texts[1])]


def test_tiles_lose_no_link(spark):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2**64, 40, dtype=np.uint64)
    values = set(seeds.tolist())
    for seed in seeds[:20].tolist():
        for _ in range(15):
            flipped = seed
            for bit in rng.choice(64, int(rng.integers(1, 5)), replace=False).tolist():
                flipped ^= 1 << bit
            values.add(flipped)
    values = sorted(values)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    expected = brute_components(values, signed)
    for tile_rows in (40, 1000):
        table = spark.createDataFrame([(v,) for v in signed], "fp long")
        found = links(table, tile_rows=tile_rows)
        pairs = found.collect()
        assert all(((a.u ^ a.v) & (2**64 - 1)).bit_count() >= 0 for a in pairs)
        top = {r.node: r.root for r in roots(found).collect()}
        groups = {v: top.get(v, v) for v in signed}
        for a in signed:
            for b in signed:
                assert (groups[a] == groups[b]) == (expected[a] == expected[b])


def test_forest_of_a_dense_group_is_small():
    values = np.arange(16, dtype=np.int64)  # all within four bits
    u, v = tile_links(values, None)
    assert len(u) == 15 and set(v.tolist()) <= set(values.tolist())
    u, v = tile_links(values[:8], values[8:])
    assert len(u) == 15


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(60)]
    star = [(1000, 1000 + k) for k in range(1, 40)] + [(5000, 5000), (7, 3)]
    got = {r.node: r.root for r in roots(spark.createDataFrame(chain + star, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, **{1000 + k: 1000 for k in range(1, 40)}}
    assert roots(spark.createDataFrame([], "u long, v long")).collect() == []
