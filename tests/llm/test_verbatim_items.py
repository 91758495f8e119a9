"""Exact copies of items that say little as templates, or that stand behind a heading."""

from starfold.llm.decontaminate import contaminated, drop_contaminated

from .conftest import words

FILLER = " ".join(words(1, 40))


def found(docs, frame, texts, *items):
    bench = frame("item_id long, text string", *enumerate(items))
    return {(r.doc_id, r.item_id) for r in contaminated(docs(*enumerate(texts)), bench).collect()}


def test_few_literal_words_count_with_their_own_values(docs, frame):
    dense, short = "What is 12 * 7 + 5 * 3 - 9?", "Name Queen Margrethe"
    texts = [
        f"{FILLER} {dense} {FILLER}", f"{FILLER}. {dense.replace('12', '13')} {FILLER}", f"{FILLER}. {short} {FILLER}",
        f"{FILLER}. Name Queen Elizabeth {FILLER}", "1 2 3 4 5 6 7 8 9 " * 200, FILLER,
    ]
    assert found(docs, frame, texts, dense, short, "") == {(0, 0), (2, 1)}
    numbers = "31 41 59 26 53 58 97 93 23 84 62 64"
    texts = [f"x {numbers} y", f"x {numbers.replace('58', '57')} y", " ".join(reversed(numbers.split()))]
    assert found(docs, frame, texts, numbers) == {(0, 0)}


def test_first_word_behind_a_colon_or_heading(docs, frame):
    items = "What makes most rivers flow downhill", "Why do cats purr", "What's in most river water today"
    texts = [f"{lead}{item}? {FILLER}" for item in items for lead in ("Question: ", "A heading\n", "so, ", "", "It ends. ")]
    got = found(docs, frame, [*texts, "Question: Nobody makes most rivers flow downhill", FILLER], *items)
    assert got == {(k, k // 5) for k in range(len(texts))}


def test_items_with_full_windows_still_meet_with_other_values(docs, frame):
    item = "if the farmer sells 12 boxes of apples for money then add 1 2 3 4 5 6 7 8 9 10 11 13 14 15 16 17 18 19 20 21 22"
    other = " ".join(str(100 + int(w)) if w.isdigit() else w for w in item.split())
    assert found(docs, frame, [item, other, other.replace("farmer", "x").replace("apples", "y")], item) == {(0, 0), (1, 0)}
    bench = frame("item_id long, text string", (1, item), (2, "Add 3 4"))
    table = docs((1, f"{FILLER}: Add 3 4"), (1, f"{FILLER}: Add 3 5"))
    assert [r.text for r in drop_contaminated(table, bench).collect()] == [f"{FILLER}: Add 3 5"]
