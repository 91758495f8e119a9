"""Offsets of offending words beside letters that lower case lengthens."""

import numpy as np

from starfold.llm.toxicity import WORD, fit, score_documents, words_of

from .conftest import by_id, words


def test_words_and_places_correspond():
    for text in ("\u0130stanbul'da K\u0130TAP \u0130\u0130", "Stra\u00dfe \u1e9e \u039f\u0394\u039f\u03a3", "", "12 a-B"):
        assert len(words_of(text)) == len(list(WORD.finditer(text)))


def test_offsets_beside_a_dotted_capital_i(docs):
    texts, toxic = [], []
    for k in range(240):
        text = words(k, 40)
        if k % 4 == 0:
            text[5], text[20] = "vile", "nasty"
        texts.append(" ".join(text))
        toxic.append(int(k % 4 == 0))
    field = fit(texts, np.array(toxic))
    plain = "Istanbul so VILE and KITAP Nasty"
    dotted = plain.replace("I", "\u0130")
    dotted = dotted.replace("V\u0130LE", "VILE")
    got = by_id(score_documents(docs((1, plain), (2, dotted)), field))
    assert got[1].predicted == got[2].predicted == 1
    assert got[2].spans and got[2].spans == got[1].spans
