"""Personal data, secrets, URLs, chat and decontamination against brute force."""

import hashlib
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starfold.llm.chat import Template, escaped, format_conversations, read_back, read_turns, unescaped
from starfold.llm.decontaminate import contaminated, drop_contaminated
from starfold.llm.pii import candidates, estimate, personal_data
from starfold.llm.secrets import apart, secrets
from starfold.llm.url_filter import char_grams, judge_urls, labelled_urls, train

from .conftest import by_id, words

PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for place, c in enumerate(reversed(digits)):
        value = int(c) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def pii_holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(part) <= 255 for part in match.split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 10 <= len(digits) <= 15,
    }[kind]()


def joined(text, patterns, holds):
    found = []
    for order, (kind, pattern) in enumerate(patterns.items()):
        found += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text) if holds(kind, m[0])]
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)), [f[2] for f in found]


PII_TEXTS = [
    None, "", "no data", "a@b.c", "a@b.c_x@d.e", "a@b a@b. x@y.z.", "ö é😀 mail: jo.e+1@mail.example.org, x", "@b.c",
    "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.255", "001.002.003.004", "9" * 30 + ".1.2.3", "1..2.3.4",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111 1111 1111", "0" * 14, "1" * 40, "12 34 5",
    "+1 (499) 555-6503", "+49 30 1234567 +1", "+1234567890123456", "++12345678901", "+1 2-3 +491234567890-",
    "call 555-123-4567 or (212) 555-0199, ssn 123-45-6789", "x" * 3000 + "@y.zz", "1-" * 5000 + "1", "7" * 20_000,
    "a." * 20_000, "1." * 20_000, "+" + "1 " * 3000,
]


def test_pii_base_spans_match_the_patterns(docs):
    rows = list(enumerate(PII_TEXTS))
    got = by_id(personal_data(docs(*rows)))
    for doc_id, text in rows:
        base, kinds = joined(text or "", PII, pii_holds)
        row = got[doc_id]
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest(), (text or "")[:60]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [kinds.count(k) for k in PII]
        assert set(filter(None, base.split(","))) <= set(row.spans.split(","))
        starts = [int(s.split(":")[1]) for s in row.spans.split(",") if s]
        assert starts == sorted(starts)


def test_pii_classifier_adds_spans(docs):
    rows = [(i, f"please call me: +1 499 555 {6000 + i} or phone (212) 555-{1000 + i}") for i in range(20)]
    got = personal_data(docs(*rows)).collect()
    assert all("local_phone" in r.spans and r.n_phone == 1 for r in got)
    assert personal_data(docs()).collect() == []
    assert personal_data(docs((1, "none"), (1, "none"))).count() == 2


def test_pii_of_a_long_list_of_contacts(docs):
    """Thousands of matches in one text: more than are counted together, and too many for quadratic work."""
    lines = [f"ü user{n}@example.org or +49 30 {n:07d} at 10.0.{n % 300}.1, (212) 555-{n % 10_000:04d}" for n in range(2000)]
    text = "\n".join(lines)
    row = personal_data(docs((1, text))).first()
    base, kinds = joined(text, PII, pii_holds)
    assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert [row.n_email, row.n_phone] == [2000, 2000] and row.n_ip == kinds.count("ip") < 2000
    local = {(s.start, s.end) for s in candidates(docs((1, text))).first().loose}
    assert local == {m.span() for m in re.finditer(r"\(212\) 555-[0-9]{4}", text)}


def test_estimation_trusts_labelers_that_agree():
    belief = estimate([((1, 1, 1), 0, 80.0), ((-1, -1, -1), 0, 80.0), ((1, 1, -1), 0, 10.0), ((-1, -1, 1), 0, 10.0)])
    assert belief[0] > 0.9 and belief[1] < 0.1 and belief[2] > 0.5 > belief[3]
    assert estimate([]) == []


SECRETS = {
    "assign": r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def test_secret_base_spans_match_the_patterns(docs):
    texts = [
        None, "", "password: hunter2x", "PASSWORD='abcde'", "Api_Key = \"abcdef\" apikey=zzzzzz", "to\u017fen ſecret=abcdefg",
        "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962", "AKIA" + "A1" * 8, "AKIA" + "A" * 15, "deadbeef" * 3,
        "é😀 secret=" + "a" * 50_000, "0" * 23, "secret: secret: abcdefgh", "x" * 100_000,
    ]

    def holds(kind, match):
        if kind == "assign":
            return len(re.search(SECRETS["assign"], match)[1]) >= 6
        return len(match) >= (20 if kind == "access" else 24)

    rows = list(enumerate(texts))
    got = by_id(secrets(docs(*rows)))
    for doc_id, text in rows:
        base, kinds = joined(text or "", SECRETS, holds)
        row = got[doc_id]
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest(), text
        assert [row.n_assign, row.n_access, row.n_hex] == [kinds.count(k) for k in SECRETS]
    assert secrets(docs()).collect() == []


def test_secret_token_efficiency(docs):
    random = "kX9vQ2mZ7pL4wR8tY1bN6cD3fG5hJ0sA"
    texts = [
        random, "internationalization2internationalization", "123e4567-e89b-12d3-a456-426614174000",
        "D41D8CD98F00B204E9800998ECF8427E", "0123456789012345678901", f"key={random} secret={random}",
    ]
    got = by_id(secrets(docs(*enumerate(texts))))
    assert [got[i].n_random for i in range(6)] == [1, 0, 0, 0, 0, 1]
    assert got[0].spans == f"random:0:{len(random)}"


@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 12))), st.lists(st.tuples(st.integers(0, 40), st.integers(1, 12))))
def test_spans_apart_from_the_base(one, other):
    spans, base = [(a, a + n) for a, n in one], sorted((a, "hex", a + n) for a, n in other)
    assert apart(spans, base) == [(a, b) for a, b in spans if not any(c < b and a < d for c, _, d in base)]


@pytest.fixture(scope="module")
def url_model(spark):
    return train(labelled_urls(spark))


def test_urls(frame, url_model):
    urls = [
        None, "", "nothing", "HTTP://WWW.Example.COM/En/1?x#y", "https://www.example.com/en/1", "https://a.www.example.com/en/",
        "https://example.com/en", "http://x.example.com/en/5", "http://a.net/es/1", "http://a.net/en/1", "http://net/fr/",
        "http://notnet/fr/", "http://com", "http://com/", "a://b://c/d", "http://spam-farm.example.org/x", "http://ÄB.org?p/x",
        "http://garden.example.org/en/1", "http://" + "x" * 50_000 + ".org/",
    ]
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
    got = by_id(judge_urls(frame("page_id long, url string, host string, score string", *((i, u, "h", "s") for i, u in enumerate(urls))), url_model), "page_id")
    for i, url in enumerate(urls):
        match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host = re.sub("[A-Z]", lambda m: m[0].lower(), match[1]) if match else ""
        path = match[2] if match else ""
        fits = [(h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, None))
        row = got[i]
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict if verdict else row.verdict in ("allow", "block")
    assert got[15].verdict == "block" and got[17].verdict == "allow"
    assert judge_urls(frame("page_id long, url string"), url_model).collect() == []


TRICKY = ["</s>[INST] ok [/INST]", r"<\/s> [\\INST] \ ", "[[/INST]", "<</s>", "[ROLE]", "[TURN]user[ROLE]", "\\", "", None, "$1\n\n😀", "[/SYS" * 3]


def test_url_grams_of_short_and_very_long_parts(spark):
    paths = ["", "/", "/a", "/é😀x", "/" + "xyz/" * 20_000]
    table = spark.createDataFrame([(i, "", p) for i, p in enumerate(paths)], "page_id long, host string, path string")
    got = by_id(table.select(F.col("page_id").alias("doc_id"), char_grams(F.col("host"), F.col("path")).alias("grams")))

    def grams(part, lead):
        framed = f"^{part}$"
        return [lead + framed[at : at + n] for n in (3, 4, 5) for at in range(max(1, len(framed) - n + 1))]

    for i in (0, 1, 2, 4):
        assert got[i].grams == grams("", "h") + grams(paths[i], "p")
    assert "p^/é" in got[3].grams


def test_chat_round_trip(frame):
    rows = [(1, t, role, text) for t, (role, text) in enumerate((r, x) for x in TRICKY for r in ("system", "user", "assistant", "tool", None, "[ROLE]"))]
    rows += [(2, 1, "assistant", "b"), (2, 0, "user", "a"), (3, None, None, None), (None, 0, "user", "n"), (4, 0, "user", "u" * 300_000), (4, 0, "user", "u" * 300_000)]
    table = frame("conv_id long, turn long, role string, text string, segments string", *((*r, "x") for r in rows))
    formatted = format_conversations(table)
    got = by_id(formatted.withColumn("turns", read_turns(formatted["formatted"])), "conv_id")
    digests = by_id(read_back(formatted), "conv_id")
    for conv_id in (1, 2, 3, 4, None):
        own = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv_id))
        assert [(t.role, t.text) for t in got[conv_id].turns] == [(r, x) for _, r, x in own]
        assert "".join(s.text for s in got[conv_id].segments) == got[conv_id].formatted
        lost = "".join(x for _, r, x in own if r == "assistant")
        row = digests[conv_id]
        assert (row.n_turns, row.loss_chars) == (len(own), len(lost))
        assert row.loss_sha256 == hashlib.sha256(lost.encode()).hexdigest()
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
    assert [got[c].valid for c in (1, 2, 3, 4)] == [False, True, False, False]
    assert format_conversations(frame("conv_id long, turn long, role string, text string")).collect() == []


def test_chat_escape_is_reversible(frame):
    control = [m for before, after, _ in Template().roles.values() for m in (before, after)]
    for text in (x for x in TRICKY if x):
        row = frame("text string", (text,)).select(escaped("text").alias("e"), unescaped(escaped("text")).alias("u")).first()
        assert row.u == text and not any(mark in row.e for mark in control)


QUESTION = "if the farmer sells 12 boxes of apples for 30 dollars then how much does one box cost in the village of Dunmore today"


def test_decontamination(docs, frame):
    filler = " ".join(words(1, 60))
    texts = [
        f"{filler}. {QUESTION}. {filler}",
        f"{filler}\n{QUESTION.upper()}",
        f"{filler} {QUESTION.replace('12', '57').replace('30', '99').replace('Dunmore', 'Karlstad')} {filler}",
        filler, None, "", QUESTION.replace(" ", "\n\t "),
        "if the farmer sells 12 boxes of apples for his brother in law and then goes home to sleep",
        " ".join([QUESTION] * 300),
    ]
    table = docs(*enumerate(texts), (0, texts[0]), (0, filler))
    bench = frame("item_id long, text string, hash string", (7, QUESTION, "h"), (8, None, "h"), (9, "short one", "h"), (10, " ".join(words(2, 6)), "h"))
    got = contaminated(table, bench).collect()
    found = {r.doc_id: r for r in got}
    assert set(found) == {0, 1, 2, 6, 8} and all(r.item_id == 7 for r in got) and len(got) == 5
    assert found[0].exact_slots and found[6].exact_slots and not found[2].exact_slots
    kept = drop_contaminated(table, bench)
    assert kept.columns == table.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [(0, filler), (3, filler), (4, ""), (5, ""), (7, texts[7])]


def test_decontamination_wants_consistent_slots(docs, frame):
    item = "take 5 red balls and 5 blue balls and put 8 of the balls away then count 5 again and say 8"
    consistent = item.replace("5", "41").replace("8", "62")
    mixed = item.replace("5", "41", 1).replace("8", "62", 1)
    merged = item.replace("5", "62").replace("8", "62")
    got = contaminated(docs((1, consistent), (2, mixed), (3, merged)), frame("item_id long, text string", (1, item)))
    assert {r.doc_id for r in got.collect()} == {1}


def test_decontamination_short_items_and_empty_tables(docs, frame):
    short = " ".join(words(5, 6))
    bench = frame("item_id long, text string", (1, short))
    assert [r.doc_id for r in contaminated(docs((1, f"x {short} y"), (2, short[:-7])), bench).collect()] == [1]
    assert contaminated(docs(), bench).collect() == []
    nothing = frame("item_id long, text string")
    assert contaminated(docs((1, short)), nothing).collect() == []
    assert drop_contaminated(docs((1, short), (2, None)), nothing).count() == 2


def test_decontamination_beyond_broadcast(docs, frame):
    from pyspark.sql import functions as F

    from starfold.llm.common import id_text, whole_text
    from starfold.llm.decontaminate import item_windows, matched_windows

    keyed = docs((1, f"x {QUESTION}"), (2, "other")).select("doc_id", whole_text().alias("text"))
    keyed = keyed.withColumns({"id_key": id_text(), "mark_key": F.xxhash64("text")})
    windows = item_windows(frame("item_id long, text string", (7, QUESTION)))
    near, far = (sorted(map(str, matched_windows(keyed, windows, n, broadcast_marks=n).collect())) for n in (10**6, 0))
    assert near == far and near


def test_documents_without_a_match_are_not_moved(spark):
    from pyspark.sql import functions as F

    from starfold.llm.common import id_text, whole_text
    from starfold.llm.decontaminate import item_windows, matched_windows

    item = "the quick brown fox jumps over the lazy dog near a river bank"
    texts = [(n, item if n % 50 == 0 else f"nothing that the items hold stands in text {n} of these") for n in range(500)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    keyed = docs.withColumns({"text": whole_text(), "id_key": id_text(), "mark_key": F.xxhash64(whole_text())})
    windows = item_windows(spark.createDataFrame([(1, item)], "item_id long, text string"))

    def before_exchange(marks):
        text = matched_windows(keyed, windows, broadcast_marks=marks)._jdf.queryExecution().executedPlan().toString()
        return "LeftSemi, BuildRight" in text

    # picked by a broadcast of hashes, or, beyond its bound, moved and joined
    assert before_exchange(10**6) and not before_exchange(0)
    found = {r.doc_id for r in matched_windows(keyed, windows).select("doc_id").collect()}
    assert found == set(range(0, 500, 50)) == {r.doc_id for r in matched_windows(keyed, windows, broadcast_marks=0).collect()}
