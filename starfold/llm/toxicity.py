"""Toxicity by a linear-chain conditional random field over words.

Documents carry the labels; tokens get theirs from them: a word of a toxic document is toxic if it, or the
way it begins, is found in toxic documents and next to never in others. A chain of two states is trained
on these tokens. Forward-backward marginals of every word are summed to the document's score; runs of words
with a high marginal are the offending spans.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import drawn, whole_text

WORD = re.compile(r"[^\W\d_]+")
# Characters of labelled text the field is trained on, about; drawn by a hash of the id.
TRAINING_CHARS = 12_000_000
# A feature marks toxic words if so many toxic documents have it, and so small a part of its documents is not toxic.
SUPPORT = 4
LEAKAGE = 0.2
PREFIXES = (3, 4, 5, 6)
BUCKETS = 1 << 21
WINDOW = 128
EPOCHS = 6
# Windows in a step of training, and the least number of steps: few labelled rows are gone through more often.
STEP_WINDOWS = 1000
STEPS = 60
RATE = 0.5
DECAY = 1e-4
LIMIT = 12.0
# Elements of a padded batch of documents.
BATCH = 1_000_000
REMEMBERED = 500_000
# Characters whose words are held at once, unless one text has more.
PORTION = 8_000_000
PREDICT_FROM = 0.3
SPAN_FROM = 0.5


def words_of(text: str) -> list[str]:
    """The words of a text, each lowered by itself: lowering a whole text can change their number."""
    return [word.lower() for word in WORD.findall(text)]


def word_features(word: str) -> list[str]:
    """What the field sees of a word: the word, and how it begins."""
    return [f"w {word}", *(f"p {word[:n]}" for n in PREFIXES if len(word) > n)]


def feature_buckets(word: str) -> list[int]:
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % BUCKETS for f in word_features(word)]


def chain(emission: np.ndarray, transition: np.ndarray, start: float) -> np.ndarray:
    """Forward odds of state 1 over state 0 for padded columns of emission odds (time, chains).

    A step maps the odds by a fraction of two lines, so that they stay in bounds and need no logarithm.
    """
    (a00, a01), (a10, a11) = transition
    forward = np.empty_like(emission)
    forward[0] = emission[0] * start
    for t in range(1, len(emission)):
        odds = forward[t - 1]
        forward[t] = emission[t] * (a01 + a11 * odds) / (a00 + a10 * odds)
    return forward


def chain_back(reversed_emission: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Backward odds of columns whose time runs from the last word to the first."""
    (a00, a01), (a10, a11) = transition
    backward = np.empty_like(reversed_emission)
    backward[0] = 1
    for t in range(1, len(reversed_emission)):
        odds = reversed_emission[t - 1] * backward[t - 1]
        backward[t] = (a10 + a11 * odds) / (a00 + a01 * odds)
    return backward


def marginals(sequences: list[np.ndarray], transition: np.ndarray, start: float) -> list[np.ndarray]:
    """Probability of state 1 for every element of each sequence of log emission odds."""
    found: list[np.ndarray] = [np.zeros(0)] * len(sequences)
    order = sorted((k for k, s in enumerate(sequences) if len(s)), key=lambda k: len(sequences[k]))
    at = 0
    while at < len(order):
        # from the longest that is left down, as many as fit
        longest = len(sequences[order[-1 - at]])
        group = order[max(0, len(order) - at - max(1, BATCH // longest)) : len(order) - at]
        at += len(group)
        odds, back = np.ones((longest, len(group))), np.ones((longest, len(group)))
        for column, k in enumerate(group):
            own = np.exp(np.clip(sequences[k], -LIMIT, LIMIT))
            odds[: len(own), column], back[: len(own), column] = own, own[::-1]
        forward, backward = chain(odds, transition, start), chain_back(back, transition)
        for column, k in enumerate(group):
            size = len(sequences[k])
            both = forward[:size, column] * backward[:size, column][::-1]
            found[k] = both / (1 + both)
    return found


class Field:
    """The trained chain: bucket weights, bias, transitions, and the calibration of document scores."""

    def __init__(self, weights: np.ndarray, bias: float, transition: np.ndarray, start: float, scale: np.ndarray):
        self.weights, self.bias, self.transition, self.start, self.scale = weights, bias, transition, start, scale

    def emission(self, word: str) -> float:
        return float(self.bias + self.weights[feature_buckets(word)].sum())

    def score(self, probabilities: np.ndarray) -> float:
        """The document's score from its words' marginals."""
        odds = self.scale @ document_features(probabilities)
        return float(1 / (1 + np.exp(-np.clip(odds, -30, 30))))


def document_features(probabilities: np.ndarray) -> np.ndarray:
    """Constant, logarithm of the expected number of toxic words, greatest marginal."""
    if not len(probabilities):
        return np.array([1.0, 0.0, 0.0])
    return np.array([1.0, np.log1p(probabilities.sum()), probabilities.max()])


def _logistic(rows: np.ndarray, truth: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton's method, lightly held to zero."""
    weights = np.zeros(rows.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (truth - p) - 0.01 * weights
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + 0.01 * np.eye(len(weights))
        weights = weights + np.clip(np.linalg.solve(curve, slope), -2, 2)
    return weights


class Vocabulary:
    """Words by number, and the buckets of their features as one flat table."""

    def __init__(self):
        self.index: dict[str, int] = {}

    def numbers(self, text: str) -> np.ndarray:
        index = self.index
        return np.array([index.setdefault(word, len(index)) for word in words_of(text)], np.int32)

    def close(self) -> None:
        """Lay out the features of all words met so far."""
        sizes = np.fromiter((1 + sum(len(w) > n for n in PREFIXES) for w in self.index), np.int32, len(self.index))
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.buckets = np.fromiter((b for w in self.index for b in feature_buckets(w)), np.int32, int(sizes.sum()))
        self.owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """For each word the sum of its features' weights."""
        return np.bincount(self.owner, weights[self.buckets], len(self.index))

    def marked(self, documents: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
        """Words with a feature of ``SUPPORT`` toxic documents or more that next to no other document has."""
        seen = np.zeros((2, BUCKETS), np.int32)
        for words, label in zip(documents, toxic.tolist(), strict=True):
            own = np.unique(words)
            if len(own):
                features = np.concatenate([self.buckets[self.starts[w] : self.starts[w + 1]] for w in own.tolist()])
                seen[label, np.unique(features)] += 1
        marks = (seen[1] >= SUPPORT) & (seen[0] <= LEAKAGE * (seen[0] + seen[1]))
        return self.sums(marks.astype(np.float32)) > 0


def _gradients(tokens, truth, real, odds, logs, start) -> tuple[np.ndarray, np.ndarray, float]:
    """Slopes of the likelihood of labelled windows (time, windows) for emissions, transitions and start."""
    sizes = real.sum(axis=0)
    time = np.arange(len(real))[:, None]
    flip = np.where(real, sizes[None, :] - 1 - time, time)
    transition = np.exp(logs)
    forward = chain(odds, transition, np.exp(start))
    backward = np.take_along_axis(chain_back(np.take_along_axis(odds, flip, 0), transition), flip, 0)
    both = forward * backward
    wrong = np.where(real, truth - both / (1 + both), 0.0)
    # pairs of neighbouring states: as labelled, and as expected
    pairs, right, left = real[1:], odds[1:] * backward[1:], forward[:-1]
    mass = [[np.broadcast_to(transition[0, 0], right.shape), transition[0, 1] * right]]
    mass.append([transition[1, 0] * left, transition[1, 1] * left * right])
    norm = mass[0][0] + mass[0][1] + mass[1][0] + mass[1][1]
    seen = [[((truth[:-1] == i) & (truth[1:] == j) & pairs).sum() for j in (False, True)] for i in (False, True)]
    expected = [[np.where(pairs, m / norm, 0).sum() for m in row] for row in mass]
    return wrong, np.array(seen, float) - np.array(expected), float(wrong[0].sum())


def fit(texts: list[str], toxic: np.ndarray) -> Field:
    """Train the field on labelled documents, in steps of ``STEP_WINDOWS`` windows."""
    vocabulary = Vocabulary()
    documents = [vocabulary.numbers(text) for text in texts]
    vocabulary.close()
    marked = vocabulary.marked(documents, toxic)
    cut = [(w[at : at + WINDOW], y) for w, y in zip(documents, toxic.tolist(), strict=True) for at in range(0, len(w), WINDOW)]

    count = sum(len(window) for window, _ in cut)
    rate = sum(int(marked[window].sum()) for window, label in cut if label) / max(1, count)
    rate = min(0.4, max(1e-4, rate))
    weights, bias = np.zeros(BUCKETS, np.float32), 0.0
    logs, start = np.log(np.array([[1 - rate, rate], [1 - rate, rate]])), np.log(rate / (1 - rate))
    sums = {"weights": np.full(BUCKETS, 1e-6, np.float32), "bias": 1e-6, "logs": np.full((2, 2), 1e-6), "start": 1e-6}
    order = np.random.default_rng(13)
    steps = -(-len(cut) // STEP_WINDOWS)
    for _ in range(max(EPOCHS, -(-STEPS // steps)) if steps else 0):
        shuffled = order.permutation(len(cut))
        for at in range(0, len(cut), STEP_WINDOWS):
            group = [cut[k] for k in shuffled[at : at + STEP_WINDOWS].tolist()]
            tokens = np.zeros((WINDOW, len(group)), np.int32)
            truth, real = np.zeros(tokens.shape, bool), np.zeros(tokens.shape, bool)
            for column, (window, label) in enumerate(group):
                tokens[: len(window), column] = window
                real[: len(window), column] = True
                truth[: len(window), column] = marked[window] & bool(label)
            logit = np.clip(bias + vocabulary.sums(weights), -LIMIT, LIMIT)
            odds = np.where(real, np.exp(logit)[tokens], 1.0)
            wrong, moved, first = _gradients(tokens, truth, real, odds, logs, start)
            by_word = np.bincount(tokens.ravel(), wrong.ravel(), len(vocabulary.index))
            slopes = {
                "weights": np.bincount(vocabulary.buckets, by_word[vocabulary.owner], BUCKETS).astype(np.float32) / len(group)
                - np.float32(DECAY) * weights,
                "bias": wrong.sum() / len(group) - DECAY * bias,
                "logs": moved / len(group) - DECAY * logs,
                "start": first / len(group) - DECAY * start,
            }
            for name, slope in slopes.items():
                sums[name] = sums[name] + slope**2
                slopes[name] = RATE * slope / np.sqrt(sums[name])
            weights, bias = weights + slopes["weights"], bias + slopes["bias"]
            logs, start = logs + slopes["logs"], start + slopes["start"]

    field = Field(weights, float(bias), np.exp(logs), float(np.exp(start)), np.array([-30.0, 0.0, 0.0]))
    if documents:
        logit = bias + vocabulary.sums(weights)
        chances = marginals([logit[w] for w in documents], field.transition, field.start)
        field.scale = _logistic(np.array([document_features(p) for p in chances]), toxic.astype(float))
    return field


def training_rows(docs: DataFrame, labels: DataFrame, chars: int = TRAINING_CHARS) -> DataFrame:
    """Labelled texts (text, toxic) of about ``chars`` characters in all, drawn by a hash of the id.

    Texts longer than a hundredth of the bound are not drawn. Of several labels of a document the worst counts.
    """
    worst = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    size = F.length(whole_text())
    short = docs.where(size <= chars // 100).select("doc_id", whole_text().alias("text"))
    sizes = short.select("doc_id", F.length("text").alias("size"))
    total = sizes.join(worst, "doc_id").agg(F.sum("size")).first()[0] or 0
    if total > chars:
        short = short.where(drawn(F.lit(chars / total), "doc_id"))
    rows = short.join(worst, "doc_id").orderBy("doc_id", "text")
    return rows.select("text", F.col("toxic").cast("int").alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, chars: int = TRAINING_CHARS) -> Field:
    """The field trained on a bounded sample of the labelled rows of ``docs``; without any, a field that scores 0."""
    rows = training_rows(docs, labels, chars).collect()  # bounded by chars
    return fit([row["text"] for row in rows], np.array([row["toxic"] > 0 for row in rows], np.int64))


class _Scorer:
    """Scores batches of texts, remembering words' emissions."""

    def __init__(self, field: Field):
        self.field, self.known = field, {}

    def __call__(self, texts: list[str]) -> Iterator[tuple[float, str]]:
        found = [words_of(text) for text in texts]
        known, emission = self.known, self.field.emission
        if len(known) > REMEMBERED:
            known.clear()
        for word in {w for words in found for w in words if w not in known}:
            known[word] = emission(word)
        sequences = [np.fromiter(map(known.__getitem__, words), float, len(words)) for words in found]
        chances = marginals(sequences, self.field.transition, self.field.start)
        for text, probabilities in zip(texts, chances, strict=True):
            yield self.field.score(probabilities), self._spans(text, probabilities)

    def _spans(self, text: str, probabilities: np.ndarray) -> str:
        """start:end of runs of offending words, in code points of the text as it was given."""
        hits = np.flatnonzero(probabilities >= SPAN_FROM)
        if not len(hits):
            return ""
        places = [m.span() for m in WORD.finditer(text)]
        runs: list[list[int]] = []
        for hit in hits.tolist():
            if runs and runs[-1][1] == hit - 1:
                runs[-1][1] = hit
            else:
                runs.append([hit, hit])
        return ",".join(f"{places[a][0]}:{places[b][1]}" for a, b in runs)


def _portions(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``PORTION`` characters."""
    portion, size = [], 0
    for text in texts:
        if portion and size + len(text) > PORTION:
            yield portion
            portion, size = [], 0
        portion.append(text)
        size += len(text)
    if portion:
        yield portion


def score_documents(docs: DataFrame, field: Field, predict_from: float = PREDICT_FROM) -> DataFrame:
    """``doc_id``, score, predicted and spans (``start:end`` of offending words) for every row of ``docs``.

    Null and empty texts, and texts without a word, get the score of no toxic word. Repeated rows give a row each; an empty
    table gives an empty result. Other columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(field)
        for batch in batches:
            rows = [row for portion in _portions(batch.column("text").to_pylist()) for row in scorer(portion)]
            scores = np.array([score for score, _ in rows], float)
            columns = [batch.column("doc_id"), pa.array(scores), pa.array((scores >= predict_from).astype(np.int32))]
            columns.append(pa.array([spans for _, spans in rows], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        work, f"doc_id {kind}, score double, predicted int, spans string"
    )


def toxicity_table(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, spans for every row; learned from the rows that are not held out.

    Repeated rows each have their result. A very long text is scored whole. An empty table gives an empty result.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    field = train(documents.where(~held_out), labels)
    scored = score_documents(documents, field)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "spans")
