"""Secrets beside readable words and known identifiers."""

import random
import string

import pytest

from starfold.llm.secrets import secrets

from .conftest import by_id

KEY = "kX9vQ2mZ7pL4wR8tY1bN6cD3fG5hJ0sA"
UUID = "123e4567-e89b-12d3-a456-426614174000"
DIGEST = "D41D8CD98F00B204E9800998ECF8427E"
LEADS = [
    "/download/public/documents/annual-report/", "/home/user/projects/internal/config/", "services/production/credentials/",
    "client-secret-production-backend-", f"/v1/{UUID}/", f"{UUID}_", f"/{DIGEST}/", "/" + "deadbeef" * 3 + "/",
]


def reported(row, text):
    return [text[int(a) : int(b)] for kind, a, b in (s.split(":") for s in row.spans.split(",") if s) if kind == "random"]


@pytest.mark.parametrize("tail", ["", "/readable/words/behind/it"])
def test_neighbours_hide_no_secret(docs, tail):
    draw = random.Random(5)
    # with a digit, which the test asks for also of a key that stands alone
    keys = ["".join([*draw.choices(string.ascii_letters + string.digits, k=31), draw.choice(string.digits)]) for _ in range(200)]
    texts = [f"see {lead}{key}{tail} there" for lead in LEADS for key in keys]
    got = by_id(secrets(docs(*enumerate(texts))))
    missed = [text for k, text in enumerate(texts) if not any(keys[k % 200] in span for span in reported(got[k], text))]
    assert not missed, (len(missed), missed[:3])


def test_known_identifiers_alone_are_no_secret(docs):
    texts = [f"/v1/{UUID}/items", f"/{DIGEST}/{UUID}", f"{UUID}-{UUID}", f"/files/public/{DIGEST}", "/home/user/projects/2024-01-15/annual-report"]
    got = by_id(secrets(docs(*enumerate(texts))))
    assert [got[k].n_random for k in range(len(texts))] == [0] * len(texts)
    both = f"{KEY}/{UUID}/{KEY[::-1]}"
    assert reported(by_id(secrets(docs((1, both))))[1], both) == [f"{KEY}/", f"/{KEY[::-1]}"]


def test_secrets_of_an_encoding_with_separators(docs):
    key = "kX9vQ2mZ7/L4wR8tY1bN6cD/fG5hJ0sA3xW7qB"
    texts = [f"client-secret-production-backend-administration-information-department-international-organization-management-{key}", f"/download/public/documents/annual/reports/{key.replace('/', '_')}"]
    got = by_id(secrets(docs(*enumerate(texts))))
    for k, own in enumerate((key, key.replace("/", "_"))):
        assert any(own in span for span in reported(got[k], texts[k]))
    assert reported(got[0], texts[0]) == [key]


def test_very_long_runs(docs):
    text = "readable/" * 20_000 + KEY + "/readable-words" * 20_000
    assert reported(by_id(secrets(docs((1, text))))[1], text) == [KEY]
