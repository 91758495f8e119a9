"""Personal data by weak supervision.

Patterns propose spans. Those of the strict patterns are proven by their form and always stay. Three
labelers vote on each span: a gazetteer of known parts, the words before it, and the characters beside it.
Expectation-maximisation over the counts of vote patterns of the whole corpus estimates how far each
labeler can be trusted, for all kinds alike; proven spans count as personal data in it throughout. A logistic
regression on the resulting soft labels of the loose patterns' spans is the final classifier, which
decides on these.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import stored, whole_text


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: its pattern, what its gazetteer knows, and whether its form proves it."""

    name: str
    pattern: str
    known: str
    strict: bool


# Possessive loops and the bounds before a run keep the patterns' matches and make them linear.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"(?i)\.(?:com|org|net|edu|gov|int|info|io|de|fr|es|it|nl|uk|eu|ch|at|us|ca|au|jp)$",
        True,
    ),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", r"^(?!0|10\.|127\.|169\.254\.|192\.168\.|22[4-9]|2[3-5][0-9])", True),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))", True),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])", True),
    Kind(
        "local_phone",
        r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
        r"^\(?[2-9][0-8][0-9]\)?[ .-]?[2-9]",
        False,
    ),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)", False),
)
BASE = tuple(k.name for k in KINDS if k.strict)

# Words before a span that speak for or against personal data.
CUES = r"(?i)\b(?:e-?mail|mail|contact|call|phone|tel|mobile|cell|fax|whatsapp|reach|ip|address|host|card|visa|account|ssn|social security)\b"
OTHERS = r"(?i)\b(?:version|v|isbn|issn|order|price|section|chapter|figure|table|page|article|part)\.?\W*$"
CONTEXT_CHARS = 24
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"

# Matches of a text whose places are counted together; appending to arrays of this size stays cheap.
PART = 256

VOTES = ("gazetteer", "context", "shape")
# How often a labeler is taken to be right before any span is seen. This counts as much as all loose spans, and
# the proven ones a tenth of that: few votes cannot be told apart from a labeler's mistakes by themselves.
TRUST, PROVEN_PART = (0.55, 0.9, 0.55), 0.1
ROUNDS = 30
SPAN = "start:bigint,kind:int,end:bigint,gazetteer:int,context:int,shape:int,long:int"


def is_valid(kind: Kind, match: Column) -> Column:
    """Whether a match passes the further conditions of its kind."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind.name == "ip":
        return match.rlike(IP_PARTS)
    if kind.name == "card":
        return F.when(F.length(digits).between(14, 19), F.call_function("luhn_check", digits)).otherwise(False)
    if kind.name == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def spans_of(text: Column, number: int) -> Column:
    """The valid matches of one kind in a text, with positions in code points and the labelers' votes.

    What stands between the matches gives their positions; a text without a match is not split. Matches are
    counted in parts, so that a text with very many costs little more than its length.
    """
    kind = KINDS[number]
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    none = F.array().cast(f"array<struct<{SPAN}>>")

    def span(match: Column, before: Column, after: Column, start: Column) -> Column:
        words = F.substring(before, -CONTEXT_CHARS, CONTEXT_CHARS)
        touched = words.rlike(r"[\p{L}0-9]$") | after.rlike(r"^[\p{L}0-9]")
        votes = (
            F.when(match.rlike(kind.known), 1).otherwise(-1),
            F.when(words.rlike(CUES), 1).when(words.rlike(OTHERS), -1).otherwise(0),
            F.when(touched, -1).otherwise(1),
        )
        size = F.least(F.floor(F.length(match) / 8), F.lit(5)).cast("int")
        ends = (start.cast("bigint").alias("start"), F.lit(number).alias("kind"), (start + F.length(match)).cast("bigint").alias("end"))
        return F.struct(*ends, *(v.alias(n) for n, v in zip(VOTES, votes, strict=True)), size.alias("long"))

    pieces = F.split(text, kind.pattern, -1)
    joined = F.zip_with(matches, F.slice(pieces, F.lit(1), F.size(matches)), lambda m, a: F.struct(m.alias("m"), a.alias("a")))
    joined = F.zip_with(joined, F.slice(pieces, F.lit(2), F.size(matches)), lambda x, b: x.withField("b", b))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["a"])
        more = F.concat(state["found"], F.array(span(x["m"], x["a"], x["b"], start)))
        found = F.when(is_valid(kind, x["m"]), more).otherwise(state["found"])
        return F.struct((start + F.length(x["m"])).cast("bigint").alias("at"), found.alias("found"))

    begin = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("found"))
    parts = F.transform(_parts(joined), lambda part: F.aggregate(part, begin, step))
    return F.when(F.size(matches) > 0, _computed_once(parts, _placed)).otherwise(none)


def _computed_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``; the functions inside ``use`` do not compute ``value`` anew for each of their elements."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _parts(items: Column) -> Column:
    """An array cut into arrays of ``PART`` elements; of an empty one, an empty array."""

    def cut(whole: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(whole) - 1) / PART).cast("int")), lambda n: F.slice(whole, n * PART + 1, F.lit(PART)))

    return _computed_once(items, lambda whole: F.when(F.size(whole) > 0, cut(whole)).otherwise(F.array(whole)))


def _placed(parts: Column) -> Column:
    """The spans of all parts (``at``: length of the part's text, ``found``), counted from the text's beginning."""
    zero = F.array(F.lit(0).cast("bigint"))
    begins = F.aggregate(parts, zero, lambda found, p: F.concat(found, F.array(F.element_at(found, -1) + p["at"])))

    def move(part: Column, by: Column) -> Column:
        return F.transform(part["found"], lambda s: s.withField("start", s["start"] + by).withField("end", s["end"] + by))

    return F.flatten(F.zip_with(parts, F.slice(begins, F.lit(1), F.size(parts)), move))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and the spans that the patterns propose: strict ones, and loose ones that touch none of them."""
    texts = docs.select("doc_id", whole_text().alias("text"))
    found = texts.select("doc_id", *(spans_of(F.col("text"), n).alias(k.name) for n, k in enumerate(KINDS)))
    base = F.concat(*(F.col(k.name) for k in KINDS if k.strict))
    loose = F.concat(*(F.col(k.name) for k in KINDS if not k.strict))
    found = found.select("doc_id", base.alias("base"), loose.alias("loose"))
    found = found.withColumn("base", F.array_sort("base"))

    def touches(x: Column, b: Column) -> Column:
        return (b["start"] < x["end"]) & (x["start"] < b["end"])

    # a part of the sorted spans is looked into only if it reaches to the loose span
    reach = F.transform(
        _parts(F.col("base")),
        lambda part: F.struct(F.array_min(part["start"]).alias("start"), F.array_max(part["end"]).alias("end"), part.alias("spans")),
    )
    apart = _computed_once(
        reach,
        lambda parts: F.filter("loose", lambda x: ~F.exists(parts, lambda p: touches(x, p) & F.exists(p["spans"], lambda b: touches(x, b)))),
    )
    return found.select("doc_id", "base", F.when(F.size("loose") > 0, apart).otherwise(F.col("loose")).alias("loose"))


def estimate(
    patterns: list[tuple[tuple[int, ...], int, float]], proven: Collection[int] = (), rounds: int = ROUNDS
) -> list[float]:
    """Expectation-maximisation over (votes, kind, count): the probability that each pattern is personal data.

    Each labeler has a share of positive votes for personal data and one for the rest, among the spans on which
    it votes (0 abstains), the same for all kinds. It begins with ``TRUST`` in the labelers. Spans of ``proven``
    kinds are personal data; what they say of a labeler counts for ``PROVEN_PART`` of the others at most, since there
    can be any number of them and words may speak otherwise of another kind. Any other span is held as likely as not until the labelers vote, since a share estimated
    from a corpus with few contrary spans would carry these along.
    """
    trusted = [{1: share, 0: 1 - share} for share in TRUST]
    anchors = [(votes, count) for votes, kind, count in patterns if kind in proven]
    cast_by_anchors = [sum(count for votes, count in anchors if votes[n]) for n in range(len(TRUST))]
    prior = sum((count for _, kind, count in patterns if kind not in proven), 1.0)
    anchored = [min(1.0, PROVEN_PART * prior / total) if total else 0.0 for total in cast_by_anchors]
    belief: list[float] = []
    for _ in range(rounds + 1):
        belief = []
        for votes, kind, _ in patterns:
            odds = 0.0
            for vote, positive in zip(votes, trusted, strict=True):
                if vote:
                    yes, no = (positive[truth] if vote > 0 else 1 - positive[truth] for truth in (1, 0))
                    odds += math.log(yes / no)
            belief.append(1.0 if kind in proven else 1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
        cast = [{1: [prior * share, prior], 0: [prior * (1 - share), prior]} for share in TRUST]
        for p, (votes, kind, count) in zip(belief, patterns, strict=True):
            for vote, counts, scale in zip(votes, cast, anchored, strict=True):
                part = count * scale if kind in proven else count
                for truth, weight in ((1, p * part), (0, (1 - p) * part)):
                    counts[truth][0] += weight * (vote > 0)
                    counts[truth][1] += weight * (vote != 0)
        trusted = [{truth: yes / total for truth, (yes, total) in counts.items()} for counts in cast]
    return belief


def classifier(found: DataFrame) -> tuple[list[float], float] | None:
    """Weights and intercept of the classifier of loose spans over ``_features``; None without any such span.

    The spans' features are few discrete values, so that the corpus reaches the driver as the counts of
    their combinations: at most 6 kinds x 12 votes x 6 lengths, whatever its size.
    """
    spans = found.select(F.explode(F.concat("base", "loose")).alias("s")).select("s.*")
    counted = spans.groupBy(*VOTES, "kind", "long").count().collect()
    proven = {n for n, kind in enumerate(KINDS) if kind.strict}
    belief = estimate([(tuple(row[v] for v in VOTES), row["kind"], float(row["count"])) for row in counted], proven)
    weighted = [
        F.struct(*(F.lit(row[c]).alias(c) for c in (*VOTES, "kind", "long")), F.lit(label).alias("label"), F.lit(row["count"] * p).alias("w"))
        for row, b in zip(counted, belief, strict=True)
        if row["kind"] not in proven
        for label, p in ((1.0, b), (0.0, 1 - b))
    ]
    if not weighted:
        return None
    table = found.sparkSession.range(1).select(F.inline(F.array(*weighted)))
    features = _features(F.struct(*(F.col(c) for c in (*VOTES, "kind", "long"))))
    names = [f"f{n}" for n in range(len(features))]
    table = table.select("label", "w", *(f.cast("double").alias(n) for n, f in zip(names, features, strict=True)))
    table = VectorAssembler(inputCols=names, outputCol="features").transform(table)
    learner = LogisticRegression(weightCol="w", regParam=0.001, maxIter=50, standardization=False)
    model = learner.fit(table.select("label", "w", "features"))
    return list(model.coefficients), model.intercept


def _features(span: Column) -> list[Column]:
    """The classifier's features of a loose span: its kind, the votes, its length."""
    kinds = [(span["kind"] == n).cast("int") for n, kind in enumerate(KINDS) if not kind.strict]
    return [*kinds, *(span[v] for v in VOTES), span["long"]]


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k.name) for k in KINDS))
    text = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return F.array_join(text, ",")


def personal_data(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, found.

    ``spans`` are ``kind:start:end`` in code points, by start and then kind; ``found`` has them as
    structs. base_sha256 is the digest of the strict patterns' spans alone. A loose span is added if the classifier
    gives it ``least`` or more. Null and empty texts have none; an empty table gives an empty result; repeated rows
    give a row each. Other columns are not read.
    """
    found = stored(candidates(docs), "pii")
    learnt = classifier(found)

    def accepted(span: Column) -> Column:
        weights, intercept = learnt
        score = F.lit(intercept)
        for weight, feature in zip(weights, _features(span), strict=True):
            score = score + F.lit(weight) * feature
        return 1 / (1 + F.exp(-score)) >= least

    more = F.filter("loose", accepted) if learnt else F.col("loose")
    every = found.withColumn("all", F.array_sort(F.concat("base", more)))
    counts = [
        F.size(F.filter("base", _of_kind(n))).cast("long").alias(f"n_{k.name}") for n, k in enumerate(KINDS) if k.strict
    ]
    places = F.transform("all", lambda s: F.struct(s["kind"], s["start"], s["end"]))
    return every.select(
        "doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"), places.alias("found")
    )


def _of_kind(number: int):
    return lambda span: span["kind"] == number
