"""Alignment of two tokenizers' tokens by merge-path partitioning.

Both tokenizers read every text; a token ends at a byte offset, and offsets at which tokens of both end
cut the tokens into groups. Finding them is a merge of two ascending lists of ends. The merge is divided
by diagonals: a binary search on each finds how many ends of either list the merge has taken by then, so
pieces of equal work are found without merging, be a text one word or most of the input. Pieces emit the
ends that both lists have; an end that a diagonal separates and the groups that go on over a piece's
boundary are stitched afterwards.

How many documents hold an id pair linked is counted over the corpus. Texts are read once: their linked
pairs are stored as numbers within a block of documents, each block's distinct pairs meet the corpus
counts, and the counts go back to the block.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import stored, whole_text
from starfold.llm.packing import PLAIN, RANKS, TOKENIZER, token_ids

PIECES = "piece_bpe_32k.model"
# Ends of both lists in a piece of the merge.
PIECE_WORK = 65_536
# Characters of the texts that are merged together, and linked pairs of a block's documents.
BATCH_CHARS = 2_000_000
BLOCK_PAIRS = 1_000_000
# Segments, and characters of them, whose ids a worker remembers.
KNOWN_SEGMENTS = 300_000
KNOWN_CHARS = 16_000_000
# Groups with more links are counted by distinct ids instead of link by link.
WIDE_GROUP = 1024
SHORT = 100
# An id pair is a number of twice so many bits.
ID_BITS = 20

# A space that does not stand behind a letter or mark; elsewhere no token of either kind reaches over a space.
INNER_SPACE = re.compile(r"(?:\A|\s) ")
CUT = re.compile(r"(?<=\S) ")


def byte_letters() -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: visible bytes stand for themselves."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


class Readers:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a_file: str, a_ranks: str, b_file: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(a_file)
        self.exact.encode_special_tokens = True
        with open(a_ranks, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        letters = byte_letters()
        entries = [self.exact.id_to_token(i) or "" for i in range(self.exact.get_vocab_size())]
        self.a_bytes = [bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode() for entry in entries]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_lengths = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_lengths = np.array([len(x) for x in self.b_bytes], np.int64)
        self.space = self.b.piece_to_id("▁")
        # an id followed by a comma (even) or by the end of its side of a group (odd)
        self.a_names = [f"{i}{end}" for i in range(len(self.a_bytes)) for end in ",|"]
        self.b_names = [f"{i}{end}" for i in range(len(self.b_bytes)) for end in ",;"]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def a_ids(self, text: str) -> list[int]:
        if len(text) < SHORT and PLAIN.match(text):
            return self.fast.encode_ordinary(text)
        return token_ids(text, self.exact, self.fast).tolist()

    def b_ids(self, texts: list[str]) -> list[list[int]]:
        """The ids of space+text: the tokenizer adds the space itself, but to an empty text."""
        found = self.b.encode(texts, num_threads=1) if texts else []
        return [ids if text else [self.space] for text, ids in zip(texts, found, strict=True)]


@lru_cache(maxsize=2)
def readers(a_file: str, a_ranks: str, b_file: str) -> Readers:
    return Readers(a_file, a_ranks, b_file)


def segments(text: str) -> list[str]:
    """``text`` cut at spaces behind visible characters: both tokenizers read space+segment by itself alike."""
    return CUT.split(text) if INNER_SPACE.search(text) else text.split(" ")


class Segments(dict):
    """Numbers of segments, and their ids in both vocabularies one behind the other."""

    def __init__(self, known: Readers):
        super().__init__()
        self.readers, self.waiting, self.chars = known, [], 0
        self.a, self.b, self.good = [np.empty(0, np.int32)], [np.empty(0, np.int32)], [np.empty(0, bool)]
        self.a_counts, self.b_counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def __missing__(self, segment: str) -> int:
        self[segment] = number = len(self)
        self.waiting.append(segment)
        self.chars += len(segment)
        return number

    def full(self) -> bool:
        return len(self) > KNOWN_SEGMENTS or self.chars > KNOWN_CHARS

    def tables(self) -> tuple[np.ndarray, ...]:
        """(ids of A, counts of A, ids of B, counts of B, whether the bytes of both are the segment's)."""
        if self.waiting:
            read, a_bytes, b_bytes = self.readers, self.readers.a_bytes, self.readers.b_bytes
            a = [read.a_ids(" " + segment) for segment in self.waiting]
            b = read.b_ids(self.waiting)
            good = [
                b"".join(map(b_bytes.__getitem__, y)) == (whole := f" {s}".encode("utf-8", "surrogatepass"))
                and b"".join(map(a_bytes.__getitem__, x)) == whole
                for s, x, y in zip(self.waiting, a, b, strict=True)
            ]
            self.good.append(np.array(good, bool))
            for ids, found, counts in ((a, self.a, self.a_counts), (b, self.b, self.b_counts)):
                counts.append(np.fromiter(map(len, ids), np.int64, len(ids)))
                found.append(np.fromiter((i for x in ids for i in x), np.int32, int(counts[-1].sum())))
            self.waiting = []
            for name in ("a", "b", "good", "a_counts", "b_counts"):
                setattr(self, name, [np.concatenate(getattr(self, name))])
        return self.a[0], self.a_counts[0], self.b[0], self.b_counts[0], self.good[0]


def spread(counts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The numbers starts[k], starts[k] + 1, ... of each k, counts[k] of them."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


def diagonals(a: np.ndarray, b: np.ndarray, work: int = PIECE_WORK) -> tuple[np.ndarray, np.ndarray]:
    """How many of ``a`` and of ``b`` their merge has taken after 0, work, 2 * work ... and all steps.

    One binary search per diagonal, all at once; of equal ends that of ``a`` is taken first.
    """
    step = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    low, high = np.maximum(0, step - len(b)), np.minimum(step, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        taken = np.zeros(len(step), bool)
        taken[open_] = a[middle[open_]] <= b[step[open_] - 1 - middle[open_]]
        low, high = np.where(open_ & taken, middle + 1, low), np.where(open_ & ~taken, middle, high)
    return low, step - low


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in ``a`` and ``b`` of the ends that one piece of the merge has of both."""
    at = np.searchsorted(b, a)
    hit = np.flatnonzero(at < len(b))
    hit = hit[b[at[hit]] == a[hit]]
    return hit, at[hit]


def group_ends(a: np.ndarray, b: np.ndarray, work: int = PIECE_WORK) -> tuple[np.ndarray, np.ndarray]:
    """For each group, how many ends of ``a`` and of ``b`` stand up to its own end.

    Each piece finds the ends it has of both; where a diagonal parts two equal ends, the last of one
    piece's ``a`` and the first of the next one's ``b``, they are stitched. A group is whatever lies
    between two such ends, over as many pieces as it may go.
    """
    i, j = diagonals(a, b, work)
    found = []
    for k in range(len(i) - 1):
        x, y = common_ends(a[i[k] : i[k + 1]], b[j[k] : j[k + 1]])
        found.append((x + i[k] + 1, y + j[k] + 1))
        if 0 < i[k + 1] and j[k + 1] < len(b) and a[i[k + 1] - 1] == b[j[k + 1]]:
            found.append((i[k + 1 : k + 2], j[k + 1 : k + 2] + 1))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def linked_pairs(
    a_ids: np.ndarray, b_ids: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, owner: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct links (owner << 40 | A id << 20 | B id, ascending) of groups and how often each stands.

    ``a_ends`` and ``b_ends`` count the tokens up to each group's end; ``owner`` numbers its document. A
    group with very many links is counted by its distinct ids, so that its links are never spelled out.
    """
    a_from, b_from = np.append(0, a_ends[:-1]), np.append(0, b_ends[:-1])
    n_a, n_b = a_ends - a_from, b_ends - b_from
    wide = n_a * n_b > WIDE_GROUP
    a_from, b_from, n_b, links, holder = (x[~wide] for x in (a_from, b_from, n_b, n_a * n_b, owner))
    group = np.repeat(np.arange(len(links)), links)
    within = spread(links, np.zeros(len(links), np.int64))
    left, right = np.divmod(within, n_b[group])
    pairs = a_ids[a_from[group] + left].astype(np.int64) << ID_BITS | b_ids[b_from[group] + right]
    keys = np.sort(holder[group] << 2 * ID_BITS | pairs)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    found, times = [keys[first]], [np.diff(np.append(first, len(keys)))]
    for g in np.flatnonzero(wide):
        a, a_times = np.unique(a_ids[a_ends[g] - n_a[g] : a_ends[g]], return_counts=True)
        start = b_ends[g - 1] if g else 0
        b, b_times = np.unique(b_ids[start : b_ends[g]], return_counts=True)
        found.append((owner[g] << 2 * ID_BITS | a.astype(np.int64)[:, None] << ID_BITS | b).ravel())
        times.append((a_times[:, None] * b_times).ravel())
    if len(found) == 1:
        return found[0], times[0]
    keys, place = np.unique(np.concatenate(found), return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, place, np.concatenate(times))
    return keys, total


class Batch:
    """Texts read and merged together."""

    def __init__(self, texts: list[str], known: Segments):
        read = known.readers
        cut = [segments(text) if text else [] for text in texts]
        numbers = np.fromiter(map(known.__getitem__, (s for x in cut for s in x)), np.int64, sum(map(len, cut)))
        a_ids, a_counts, b_ids, b_counts, good = known.tables()
        self.size = len(texts)
        owner = np.repeat(np.arange(self.size), np.fromiter(map(len, cut), np.int64, self.size))
        bad = np.zeros(self.size, bool)
        bad[owner[~good[numbers]]] = True
        numbers, owner = numbers[~bad[owner]], owner[~bad[owner]]
        a_starts, b_starts = np.cumsum(a_counts) - a_counts, np.cumsum(b_counts) - b_counts
        self.a = a_ids[spread(a_counts[numbers], a_starts[numbers])]
        self.b = b_ids[spread(b_counts[numbers], b_starts[numbers])]
        self.a_owner = np.repeat(owner, a_counts[numbers])
        self.n_a = np.bincount(self.a_owner, minlength=self.size)
        self.n_b = np.bincount(np.repeat(owner, b_counts[numbers]), minlength=self.size)
        self.a_cuts, self.b_cuts = group_ends(np.cumsum(read.a_lengths[self.a]), np.cumsum(read.b_lengths[self.b]))
        self.owner = self.a_owner[self.a_cuts - 1]
        links = np.diff(self.a_cuts, prepend=0) * np.diff(self.b_cuts, prepend=0)
        self.n_groups = np.bincount(self.owner, minlength=self.size)
        self.n_links = np.zeros(self.size, np.int64)
        np.add.at(self.n_links, self.owner, links)
        self.keys, self.times = linked_pairs(self.a, self.b, self.a_cuts, self.b_cuts, self.owner)
        self.digests = self._digests(read)

    def _digests(self, read: Readers) -> list[str]:
        """The digest of each text's groups, '' without tokens."""
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[self.a_cuts - 1] = last_b[self.b_cuts - 1] = 1
        # a group's A tokens stand before its B tokens: each moves by the other side's tokens before it
        a_group = np.cumsum(last_a) - last_a
        b_group = np.cumsum(last_b) - last_b
        names = np.empty(len(self.a) + len(self.b), object)
        names[np.arange(len(self.a)) + np.append(0, self.b_cuts)[a_group]] = _named(read.a_names, 2 * self.a + last_a)
        names[np.arange(len(self.b)) + self.a_cuts[b_group]] = _named(read.b_names, 2 * self.b + last_b)
        ends = np.cumsum(self.n_a + self.n_b)
        found = []
        for start, end in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
            line = "".join(names[start:end].tolist())[:-1]
            found.append(hashlib.sha256(line.encode()).hexdigest() if line else "")
        return found


def _named(names: list[str], codes: np.ndarray) -> np.ndarray:
    found = np.empty(len(codes), object)
    found[:] = list(map(names.__getitem__, codes.tolist()))
    return found


def _packed(values: np.ndarray, kind: str) -> bytes:
    return zstandard.compress(values.astype(kind).tobytes(), 1)


def _unpacked(value: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(value), kind)


def _block(number: int, rows: list[tuple[pa.Array, Batch]]) -> pa.RecordBatch:
    """The rows of a block's documents, and one more row with the block's distinct pairs and their holders."""
    low = (1 << 2 * ID_BITS) - 1
    pairs, place = np.unique(np.concatenate([batch.keys & low for _, batch in rows]), return_inverse=True)
    codes, times, at = [], [], 0
    for _, batch in rows:
        ends = np.searchsorted(batch.keys >> 2 * ID_BITS, np.arange(batch.size + 1))
        for start, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            codes.append(_packed(np.diff(place[at + start : at + end], prepend=0), "<u4"))
            times.append(_packed(batch.times[start:end], "<i8"))
        at += len(batch.keys)
    ids = pa.concat_arrays([ids for ids, _ in rows])
    size = len(ids)

    def column(name: str) -> pa.Array:
        return pa.array([*np.concatenate([getattr(batch, name) for _, batch in rows]).tolist(), None], pa.int64())

    blank = pa.nulls(1, ids.type)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number] * (size + 1), pa.int64()), pa.concat_arrays([ids, blank]),
            column("n_a"), column("n_b"), column("n_groups"), column("n_links"),
            pa.array([*(d for _, batch in rows for d in batch.digests), None]),
            pa.array([*codes, None], pa.binary()), pa.array([*times, None], pa.binary()),
            pa.array([*[None] * size, pairs.tolist()], pa.list_(pa.int64())),
            pa.array([*[None] * size, np.bincount(place, minlength=len(pairs)).tolist()], pa.list_(pa.int64())),
        ],
        ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "times", "pairs", "holders"],
    )


def alignments(
    docs: DataFrame, a_file: str | None = None, a_ranks: str | None = None, b_file: str | None = None
) -> DataFrame:
    """The texts of ``docs`` (doc_id, text) aligned: one row per document, and one per block of documents.

    A document's row holds its counts, digest, and its distinct links as places in its block's ``pairs``
    (``codes``, differences) with their numbers (``times``); a block's row holds ``pairs`` and how many of
    its documents have each (``holders``).
    """
    files = (
        a_file or public_tokenizers.path(TOKENIZER), a_ranks or public_tokenizers.path(RANKS),
        b_file or public_tokenizers.path(PIECES),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Segments(readers(*files))
        number = TaskContext.get().partitionId() << 24
        rows, held = [], 0
        for batch in batches:
            texts = batch.column("text").to_pylist()
            start, chars = 0, 0
            for at, text in enumerate(texts, 1):
                chars += len(text)
                if chars < BATCH_CHARS and at < len(texts):
                    continue
                merged = Batch(texts[start:at], known)
                rows.append((batch.column("doc_id").slice(start, at - start), merged))
                start, chars, held = at, 0, held + len(merged.keys)
                if known.full():
                    known = Segments(known.readers)
                if held >= BLOCK_PAIRS:
                    yield _block(number, rows)
                    number, rows, held = number + 1, [], 0
        if rows:
            yield _block(number, rows)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        work,
        f"block long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "codes binary, times binary, pairs array<long>, holders array<long>",
    )


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, held, best): the documents that hold each pair, and whether no pair of its A id has more."""
    held = blocks.select(F.inline(F.arrays_zip("pairs", "holders"))).groupBy("pairs").agg(F.sum("holders").alias("held"))
    held = held.select(F.col("pairs").alias("pair"), "held", F.shiftright("pairs", ID_BITS).alias("a"))
    most = held.groupBy("a").agg(F.max("held").alias("most"))
    return held.join(most, "a").select("pair", "held", (F.col("held") == F.col("most")).alias("best"))


def align_tokens(
    docs: DataFrame, a_file: str | None = None, a_ranks: str | None = None, b_file: str | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A group's A and B tokens are linked pairwise. ``count_sum`` adds up, over a document's links, how many
    documents of the corpus hold the id pair linked; ``n_best`` counts the links whose pair has the highest
    such count of all pairs of its A id, ties included.

    Null and empty texts, and texts that either tokenizer does not give back byte by byte, have zeros and an
    empty digest. Special tokens' strings are plain text. Repeated rows are documents of their own, also in the
    counts; an id may be null. An empty table gives an empty result; other columns are not read. A very long
    text is read in one task and merged in pieces; the distinct pairs of one document are held at once.
    """
    found = stored(alignments(docs, a_file, a_ranks, b_file), "alignments")
    blocks = found.where("pairs is not null").select("block", "pairs", "holders")
    counts = pair_counts(blocks)
    placed = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    placed = placed.join(counts, "pair").select(F.col("block").alias("of_block"), "place", "held", "best")
    rows = found.where("pairs is null").drop("pairs", "holders")

    def score(rows: pa.Table, counts: pa.Table) -> pa.Table:
        place = counts.column("place").to_numpy()
        held, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        held[place], best[place] = counts.column("held").to_numpy(), counts.column("best").to_numpy(zero_copy_only=False)
        sums = []
        for codes, times in zip(rows.column("codes"), rows.column("times"), strict=True):
            at, n = np.cumsum(_unpacked(codes.as_py(), "<u4"), dtype=np.int64), _unpacked(times.as_py(), "<i8")
            sums.append((int(best[at] @ n), int(held[at] @ n)))
        kept = rows.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        kept = kept.append_column("n_best", pa.array([s[0] for s in sums], pa.int64()))
        kept = kept.append_column("count_sum", pa.array([s[1] for s in sums], pa.int64()))
        return kept.append_column("groups_sha256", rows.column("groups_sha256"))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.groupBy("block").cogroup(placed.groupBy("of_block")).applyInArrow(
        score,
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
    )
