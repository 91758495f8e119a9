import random
from collections import Counter

import numpy as np
import pytest

from starfold.llm.jaccard_join import band_floors, bitmap, folded, jaccard_components, shared, shingles, words_of

from .conftest import by_id, words


def brute(texts, size=5, percent=80):
    """(number of shingles, smallest id reachable) of each id."""
    sets = {}
    for i, text in texts.items():
        found = (text or "").encode().lower().split()
        sets[i] = {tuple(found[k : k + size]) for k in range(max(1, len(found) - size + 1))} if found else set()
    up = {i: i for i in texts}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and 100 * len(a & b) >= percent * len(a | b) and a:
                low, high = sorted((top(i), top(j)))
                up[high] = low
    return {i: (len(sets[i]), top(i)) for i in texts}


def check(docs, texts, **kw):
    rows = by_id(jaccard_components(docs(*texts.items()), **kw))
    assert {i: (r.n_shingles, r.component_id) for i, r in rows.items()} == brute(texts, kw.get("words", 5), kw.get("percent", 80))


def test_shingles_are_distinct_and_whole():
    assert len(shingles("a b c")) == 1 and len(shingles(" \t")) == 0
    assert (shingles("A  b\nC") == shingles("a B c")).all()
    assert len(shingles("x y " * 50)) == 2


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_partners_are_at_most_one_band_away(percent):
    floors = np.array(band_floors(percent, 10**6))
    for size in [*range(1, 400), 9_999, 123_456]:
        partners = [k for k in {size, size * 100 // percent} if size * 100 >= percent * k]
        bands = np.searchsorted(floors, [size, *partners], side="right")
        assert bands.max() - bands.min() <= 1


def test_bitmaps_bound_what_is_not_common():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 600).astype(np.uint64)
    for n in (5, 60, 500):
        a, b = (np.unique(rng.choice(pool, n, replace=False)) for _ in "ab")
        apart = len(np.setxor1d(a, b))
        maps = np.array([bitmap(a, words_of(n) * 4), bitmap(b, words_of(n) * 4)])
        for few in (maps.shape[1], max(1, maps.shape[1] // 4), 1):
            x, y = folded(maps, few)
            assert np.bitwise_count(x ^ y).sum() <= apart
            assert (folded(maps, few)[0] == bitmap(a, few)).all()
        assert shared(a, [b, a, a[:1]]).tolist() == [len(np.intersect1d(a, b)), n, 1]


def edited(text, rng, places):
    found = text.split()
    for k in rng.sample(range(len(found)), min(places, len(found))):
        found[k] = f"e{rng.randrange(10**6)}"
    return " ".join(found)


def family(seed, texts=4, copies=12):
    rng, found = random.Random(seed), {}
    for k in range(texts):
        base = " ".join(words(seed * 100 + k, rng.choice([5, 9, 40, 120, 300])))
        for _ in range(copies):
            cut = base.split()
            found[len(found)] = edited(" ".join(cut[: rng.randint(int(len(cut) * 0.85), len(cut))]), rng, rng.choice([0, 0, 1, 2, 4]))
    return found


@pytest.mark.parametrize("tile_rows", [1, 7, 32_768])
def test_components_against_all_pairs(docs, tile_rows, monkeypatch):
    monkeypatch.setattr("starfold.llm.jaccard_join.LEAST_TILE", 1)
    check(docs, family(3), tile_rows=tile_rows)


def test_more_candidates_than_are_broadcast(docs, monkeypatch):
    monkeypatch.setattr("starfold.llm.jaccard_join.BROADCAST_ROWS", 0)
    check(docs, family(4, texts=2))


def test_other_shingles_and_percentages(docs):
    check(docs, family(5), words=3, percent=60)


def test_nulls_empty_ties_and_repeated_rows(docs):
    long = " ".join(words(9, 60_000))
    rows = [
        (5, None), (6, ""), (7, " \n"), (3, "one two"), (4, "One\ttwo"), (4, "one two"), (None, "one two"),
        (8, long), (9, long + " more"), (None, None),
    ]
    found = jaccard_components(docs(*rows)).collect()
    assert len(found) == len(rows)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in found)
    assert got == Counter(
        [(5, 0, 5), (6, 0, 6), (7, 0, 7), (3, 1, 3), (4, 1, 3), (4, 1, 3), (None, 1, 3), (8, len(shingles(long)), 8),
         (9, len(shingles(long)) + 1, 8), (None, 0, None)]
    )


def test_empty_table(docs):
    assert jaccard_components(docs()).collect() == []
