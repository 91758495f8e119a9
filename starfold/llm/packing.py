"""Best-fit packing of tokenised documents with certified bin counts.

Documents are tokenised and cut into pieces once. Pieces are dealt to partitions of bounded size, each
packed by best-fit decreasing; dual-feasible functions give a lower bound on the bins a partition
needs. A partition that meets its bound is certified. The others have gaps: they exchange documents,
new partitions are dealt from all of them together, and best-fit decreasing runs again.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import stored, whole_text

CAPACITY = 1024
END = 2
# Pieces in a partition on average.
PARTITION_ROWS = 16_384
ROUNDS = 3
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
# Texts of these code points alone, without overlong words, are split alike by both libraries.
PLAIN = re.compile(r"[\n -~¡-ɏ]*\Z")
LONG_RUN = 2000
GAP = re.compile(r"\s{%d}" % LONG_RUN)


@lru_cache(maxsize=2)
def _encoders(tokenizer: str, ranks: str):
    """The tokenizer itself, and a faster reader of the same vocabulary for plain texts."""
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(tokenizer)
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return exact, fast


def token_ids(text: str, exact, fast) -> np.ndarray:
    """The ids of ``exact`` for a text; plain texts take the faster way to the same ids."""
    plain = PLAIN.match(text) and "<|" not in text and not GAP.search(text)
    if plain and max(map(len, text.split()), default=0) < LONG_RUN:
        return fast.encode_to_numpy(text, disallowed_special=())
    return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)


def cuts(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, preceded by the remainder."""
    first = length % capacity
    starts = ([0] if first else []) + list(range(first, length, capacity))
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], length], strict=True)]


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, ranks: str | None = None
) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32."""
    tokenizer, ranks = tokenizer or public_tokenizers.path(TOKENIZER), ranks or public_tokenizers.path(RANKS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact, fast = _encoders(tokenizer, ranks)
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column("text")):
                ids = np.append(token_ids(str(text), exact, fast), END).astype("<u4")
                for piece, (start, length) in enumerate(cuts(len(ids), capacity)):
                    rows.append(row)
                    found.append((piece, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            table = np.array(found, np.int64).reshape(-1, 4)
            columns = [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(table[:, 0].astype(np.int32))]
            columns += [pa.array(np.ascontiguousarray(table[:, k])) for k in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        work, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


def bins_needed(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """The best lower bound of the dual-feasible functions that round out small and large pieces.

    For a threshold k up to half the capacity, pieces above capacity - k count as whole bins, pieces below
    k as nothing and the others as they are; k = 0 is the sum of the lengths.
    """
    counts = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1]
    sizes = counts * np.arange(capacity + 1)
    many, total = np.append(0, np.cumsum(counts)), np.append(0, np.cumsum(sizes))
    k = np.arange(capacity // 2 + 1)
    whole = many[-1] - many[capacity - k + 1]
    middle = total[capacity - k + 1] - total[k]
    return int((whole + -(-middle // capacity)).max(initial=0))


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece: the longest first, each into the fullest bin that has room."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms: list[int] = []  # the distinct amounts of room, ascending
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    opened = 0
    for at in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[at])
        k = bisect_left(rooms, length)
        if k < len(rooms):
            room = rooms[k]
            number = open_bins[room].pop()
            if not open_bins[room]:
                rooms.pop(k)
        else:
            room, number, opened = capacity, opened, opened + 1
        bins[at], offsets[at] = number, capacity - room
        if left := room - length:
            if not open_bins[left]:
                insort(rooms, left)
            open_bins[left].append(number)
    return bins, offsets


def _packed(dealt: DataFrame, capacity: int) -> DataFrame:
    """Pack each partition (``part``) of pieces: bin, offset, and the partition's bins and lower bound."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row")
        lengths = group["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        return group.assign(bin=bins, offset=offsets, bins=bins.max() + 1, bound=bins_needed(lengths, capacity))

    schema = "row long, length long, part long, bin long, offset long, bins long, bound long"
    return dealt.select("row", "length", "part").groupBy("part").applyInPandas(pack, schema)


def _deal(rows: DataFrame, count: int, salt: int, size: int) -> DataFrame:
    """Deal pieces to partitions of about ``size`` rows by a hash of their row number."""
    parts = max(1, -(-count // size))
    return rows.select("row", "length", F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(parts)).alias("part"))


def pack(rows: DataFrame, capacity: int = CAPACITY, size: int = PARTITION_ROWS, rounds: int = ROUNDS) -> DataFrame:
    """Pack pieces (row, length; none longer than ``capacity``): row, round, part, bin, offset, bins, bound.

    Each round keeps the certified partitions as they are. Of the others, it keeps the full bins and lets
    the rest of their pieces change partition; the new packing is taken only if it has fewer bins.
    """
    kept = None
    done = stored(_packed(_deal(rows, rows.count(), 0, size), capacity).withColumn("round", F.lit(0)), "packed")
    for turn in range(1, rounds + 1):
        filled = done.groupBy("part", "bin").agg(F.sum("length").alias("filled"))
        loose = done.where("bins > bound").join(filled, ["part", "bin"]).where(F.col("filled") < capacity)
        loose = stored(loose.select("row", "length", "part", "bin"), "loose")
        old = loose.select("part", "bin").distinct().count()
        count = loose.count()
        if not count:
            break
        # twice the size per round: fewer partitions, so that gaps meet
        again = stored(_packed(_deal(loose, count, turn, size << (turn - 1)), capacity), "repacked")
        again = again.withColumn("round", F.lit(turn))
        new = again.select("part", "bins").distinct().agg(F.sum("bins")).first()[0]
        if new >= old:
            break
        settled = done.join(loose.select("row"), "row", "left_anti")
        kept = settled if kept is None else kept.unionByName(settled)
        done = again
    return done if kept is None else kept.unionByName(done)


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, ranks: str | None = None
) -> DataFrame:
    """One row per piece of ``docs``: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the end id alone. Pieces of the full length are sequences of their own, with
    negative numbers; the others share sequences. Repeated rows and ids are packed once for each row. A very
    long text is tokenised whole by one task. Exchange ends after three rounds at most, whether or not every
    partition is certified by then; no piece is lost by that. An
    empty table gives an empty result; other columns are not read.
    """
    found = pieces(docs, capacity, tokenizer, ranks).withColumn("row", F.monotonically_increasing_id())
    found = stored(found, "pieces")
    packed = pack(found.where(F.col("length") < capacity).select("row", "length"), capacity)
    number = F.col("round") * F.lit(1 << 60) + F.col("part") * F.lit(1 << 24) + F.col("bin")
    packed = packed.select("row", number.alias("sequence_id"), "offset")
    full = F.col("length") == capacity
    shared = found.where(~full).join(packed, "row").drop("row")
    alone = found.where(full).withColumns({"sequence_id": -1 - F.col("row"), "offset": F.lit(0).cast("long")})
    return shared.unionByName(alone.drop("row"))
