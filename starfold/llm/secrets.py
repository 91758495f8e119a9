"""Secret scan by patterns and token efficiency.

Three patterns find secrets by their form. The token-efficiency test adds what has no form: a random
string falls into many short tokens of a vocabulary made for language, so its characters per token are
few. Known digests and identifiers, which are random by design and no secret, are cut out first. What is
left is tested as a whole and in the parts between its separators, so that readable neighbours hide nothing.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from starfold.llm.common import whole_text

RANKS = "byte_bpe_50k.tiktoken"
# A run is random if it has fewer characters per token than this, and at least so many characters.
EFFICIENCY = 2.0
SHORTEST = 20
# Longer runs are encoded in parts of this many characters: the vocabulary's merging grows faster than its input.
PART = 500

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
# What may be a random string: a run of an encoding's characters.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
# Known identifiers and digests: UUIDs, and hexadecimal digests of the usual lengths between separators.
KNOWN = re.compile(
    r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"
    r"|(?<![A-Za-z0-9+])(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{56}|[0-9A-Fa-f]{64}|[0-9A-Fa-f]{96}|[0-9A-Fa-f]{128})(?![A-Za-z0-9+])"
)
# What parts are cut at: one separator, as encodings have the others within a secret, and then all of them.
SEPARATORS = ("/", "=", "_", "-", "/=_-")


@lru_cache(maxsize=2)
def _encoder(ranks: str):
    import base64

    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the patterns' matches, by start and then kind."""
    found = []
    found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(start, KINDS[kind], end) for start, kind, end in sorted(found)]


def characters_per_token(run: str, encoder) -> float:
    tokens = sum(len(encoder.encode_ordinary(run[at : at + PART])) for at in range(0, len(run), PART))
    return len(run) / tokens


def is_random(run: str, encoder, efficiency: float = EFFICIENCY) -> bool:
    """The token-efficiency test: long enough, mixed of letters and digits, few characters per token."""
    if len(run) < SHORTEST or not (any(c.isdigit() for c in run) and any(c.isalpha() for c in run)):
        return False
    return characters_per_token(run, encoder) < efficiency


def between(start: int, end: int, cuts: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """What of start:end is left between the ``cuts`` in it, which are ordered and may overlap."""
    found = []
    for a, b in cuts:
        if start < a:
            found.append((start, a))
        start = max(start, b)
    return [*found, (start, end)] if start < end else found


def random_spans(
    text: str, encoder, efficiency: float = EFFICIENCY, base: list[tuple[int, str, int]] = ()
) -> list[tuple[int, int]]:
    """What is random in the runs of ``text``, known identifiers and the spans of ``base`` cut out.

    Of overlapping spans the whole stretch comes before its parts, and those between one separator before
    those between all.
    """
    taken, found = [(start, end) for start, _, end in base], []
    starts, reached = [a for a, _ in taken], [0, *accumulate((b for _, b in taken), max)]
    for match in RUN.finditer(text):
        first, last = match.span()
        low = bisect_right(reached, first) - 1  # the spans before it all end before the run
        cuts = taken[max(0, low) : bisect_left(starts, last)]
        known = [(first + m.start(), first + m.end()) for m in KNOWN.finditer(match[0])]
        for start, end in between(first, last, sorted((max(a, first), min(b, last)) for a, b in [*cuts, *known] if b > first)):
            found += _random_parts(text, start, end, encoder, efficiency)
    return found


def _random_parts(text: str, start: int, end: int, encoder, efficiency: float) -> list[tuple[int, int]]:
    """The random parts of one stretch, in order and without overlaps."""
    if end - start < SHORTEST:
        return []
    if is_random(text[start:end], encoder, efficiency):
        return [(start, end)]
    found: list[tuple[int, str, int]] = []
    for separators in SEPARATORS:
        cuts = [m.span() for m in re.compile(f"[{separators}]").finditer(text, start, end)]
        parts = [(a, b) for a, b in between(start, end, cuts) if SHORTEST <= b - a < end - start] if cuts else []
        added = [(a, "random", b) for a, b in apart(parts, found) if is_random(text[a:b], encoder, efficiency)]
        found = sorted([*found, *added])
    return [(a, b) for a, _, b in found]


def apart(spans: list[tuple[int, int]], base: list[tuple[int, str, int]]) -> list[tuple[int, int]]:
    """The ``spans`` (start, end) that overlap none of ``base``, which is ordered by start."""
    starts = [start for start, _, _ in base]
    reached = [0, *accumulate((end for _, _, end in base), max)]  # the farthest end of the first n
    return [(start, end) for start, end in spans if reached[bisect_left(starts, end)] <= start]


def _joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def secrets(docs: DataFrame, ranks: str | None = None, efficiency: float = EFFICIENCY) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Spans are ``kind:start:end`` in code points by start, then kind, joined by commas; kind ``random`` comes
    from the token-efficiency test and overlaps no pattern's span. base_sha256 is the digest of the patterns' spans alone.
    Null and empty texts have none; an empty table gives an empty result. Repeated rows each have their result.
    A very long text is read whole by one task. Other columns are not read.
    """
    ranks = ranks or public_tokenizers.path(RANKS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks)
        for batch in batches:
            counts, digests, joined = [], [], []
            for value in batch.column("text"):
                text = str(value)
                base = base_spans(text)
                kinds = [kind for _, kind, _ in base]
                added = [(start, "random", end) for start, end in random_spans(text, encoder, efficiency, base)]
                order = (*KINDS, "random")
                spans = sorted([*base, *added], key=lambda s: (s[0], order.index(s[1])))
                counts.append([*(kinds.count(kind) for kind in KINDS), len(added)])
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                joined.append(_joined(spans))
            table = np.array(counts, np.int64).reshape(-1, 4)
            columns = [batch.column("doc_id"), *(pa.array(np.ascontiguousarray(table[:, k])) for k in range(3))]
            columns += [pa.array(digests, pa.string()), pa.array(joined, pa.string()), pa.array(np.ascontiguousarray(table[:, 3]))]
            names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        work, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
    )
