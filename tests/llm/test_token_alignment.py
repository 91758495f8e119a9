import hashlib
import random
from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest

from starfold.llm import token_alignment as T

from .conftest import words

TEXTS = [
    "Plain words, and more of them.", "a  b   c ", "  led by spaces", " ", "trailing ", "tab\tand\nbreak \n x", "<|endoftext|> </s> <s>",
    "don't we'll it's", "日本語のテキスト and ไทย", "naïve café ﬁ é", "emoji 🤗🤗 👩‍👩‍👧 end", "12345678901234567890 3.14159",
    "x▁y", "null\x00byte \x1c \x85 　 wide", "=" * 300, "ab" * 500, "<0x41> <0xE2>", "a\r\nb\r\n", "​zero  nbsp",
]


@pytest.fixture(scope="module")
def read():
    return T.readers(*(public_tokenizers.path(f) for f in (T.TOKENIZER, T.RANKS, T.PIECES)))


def plain_groups(text, read):
    """Groups by a plain merge of whole texts' tokens, None without tokens."""
    if not text:
        return []
    whole = (" " + text).encode()
    a, b = read.exact.encode(" " + text, add_special_tokens=False).ids, read.b.encode(text)
    if b"".join(read.a_bytes[i] for i in a) != whole or b"".join(read.b_bytes[i] for i in b) != whole:
        return []
    a_ends, b_ends = (list(accumulate(len(t[i]) for i in ids)) for ids, t in ((a, read.a_bytes), (b, read.b_bytes)))
    groups, x, y = [], 0, 0
    for end in sorted(set(a_ends) & set(b_ends)):
        i, j = a_ends.index(end) + 1, b_ends.index(end) + 1
        groups.append((a[x:i], b[y:j]))
        x, y = i, j
    return groups


def expected(texts, read):
    """The operator's columns for each text, by counting links one by one."""
    groups = [plain_groups(text, read) for text in texts]
    links = [[(i, j) for a, b in g for i in a for j in b] for g in groups]
    held = Counter(pair for found in links for pair in set(found))
    most = {}
    for (i, _), n in held.items():
        most[i] = max(most.get(i, 0), n)
    rows = []
    for g, found in zip(groups, links):
        line = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        rows.append(
            (sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(found), sum(held[p] == most[p[0]] for p in found),
             sum(held[p] for p in found), hashlib.sha256(line.encode()).hexdigest() if g else "")
        )
    return rows


@pytest.mark.parametrize("work", [1, 2, 5, 64, 10_000])
def test_pieces_of_a_merge_find_every_common_end(work):
    rng = random.Random(work)
    for _ in range(40):
        last = rng.randint(1, 60)
        a, b = (np.array(sorted({*rng.sample(range(1, last + 1), rng.randint(1, last)), last})) for _ in "ab")
        i, j = T.diagonals(a, b, work)
        assert i[-1] == len(a) and j[-1] == len(b) and (np.diff(i + j)[:-1] == work).all()
        common = np.intersect1d(a, b)
        x, y = T.group_ends(a, b, work)
        assert (a[x - 1] == common).all() and (b[y - 1] == common).all()


def test_merge_of_nothing():
    none = np.empty(0, np.int64)
    assert [len(x) for x in T.group_ends(none, none)] == [0, 0]


def test_segments_are_read_as_whole_texts_are(read):
    rng = random.Random(2)
    pieces = [" ", "  ", "\n", "\t ", "a", "Word", "é", "日本", "'s", "12", "-", " ", "　", "\x1c", "<|", "🤗", "é"]
    texts = TEXTS + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))) for _ in range(800)]
    for text in texts:
        cut = T.segments(text)
        assert " ".join(cut) == text
        assert [i for s in cut for i in read.a_ids(" " + s)] == read.exact.encode(" " + text, add_special_tokens=False).ids
        if "▁" not in text:
            assert [i for ids in read.b_ids(cut) for i in ids] == read.b.encode(text)


def test_wide_groups_are_counted_without_spelling_links_out(monkeypatch):
    a, b = np.array([1, 2, 1, 7], np.int32), np.array([3, 3, 4, 9], np.int32)
    ends = np.array([3, 4]), np.array([3, 4])
    plain = T.linked_pairs(a, b, *ends, np.array([0, 1]))
    monkeypatch.setattr(T, "WIDE_GROUP", 2)
    wide = T.linked_pairs(a, b, *ends, np.array([0, 1]))
    assert [x.tolist() for x in plain] == [x.tolist() for x in wide]
    assert dict(zip(*[x.tolist() for x in plain]))[1 << 20 | 3] == 4


def test_alignment_against_counting_one_by_one(docs, read):
    texts = [None, "", *TEXTS, *TEXTS[:5], " ".join(words(4, 3000)), TEXTS[0]]
    want = expected(texts, read)
    rows = {r.doc_id: tuple(r)[1:] for r in T.align_tokens(docs(*enumerate(texts)).repartition(3)).collect()}
    assert [rows[i] for i in range(len(texts))] == want


def test_small_batches(read):
    texts = [" ".join(words(k, 30)) for k in range(20)] + TEXTS
    known, found = T.Segments(read), []
    for start in range(0, len(texts), 3):
        batch = T.Batch(texts[start : start + 3], known)
        found += zip(batch.n_a.tolist(), batch.n_b.tolist(), batch.n_groups.tolist(), batch.n_links.tolist(), batch.digests)
    assert found == [(a, b, g, n, digest) for a, b, g, n, _, _, digest in expected(texts, read)]


def test_repeated_rows_null_ids_and_empty_table(docs, read):
    rows = T.align_tokens(docs((1, "same text"), (1, "same text"), (None, "same text"), (None, None))).collect()
    assert sorted((r.doc_id is None, r.n_a, r.count_sum) for r in rows) == [(False, 2, 6), (False, 2, 6), (True, 0, 0), (True, 2, 6)]
    assert T.align_tokens(docs()).collect() == []
