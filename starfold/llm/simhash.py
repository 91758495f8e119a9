"""SimHash near-duplicates by tiled exact comparison.

Every document gets a 64-bit fingerprint. Distinct fingerprints are put into tiles by their population
count; two tiles whose counts differ by more than the radius cannot hold a link and never meet. The
tiles that may are compared exactly, with numpy's exclusive-or and bit counts. Within a tile, rows are
ordered by the population counts of their four 16-bit parts and cut into blocks; two blocks are skipped
when the sum of the gaps between their counts exceeds the radius.

A pair of tiles yields a spanning forest of its links instead of all of them, so a large group of near
copies costs rows in proportion to its size, and no link between two groups is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import id_text, retain, stored, whole_text
from starfold.llm.components import roots

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
# Fingerprints in a tile on average; a pair of tiles is compared in one task.
TILE_ROWS = 65_536
BLOCK_ROWS = 512
# Shingles whose bits are counted at once.
COUNTED_SHINGLES = 65_536
BITS = 64


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text: a bit is 1 if set in over half of the shingles' hashes; 0 without words.

    ``bytes.lower`` lowers A-Z alone and ``bytes.split`` splits at the six ASCII white-space characters.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(found) > words:
        starts, ends = starts[: len(found) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, seed = xxhash.xxh64_intdigest, SEED
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), COUNTED_SHINGLES):
        spans = zip(starts[at : at + COUNTED_SHINGLES].tolist(), ends[at : at + COUNTED_SHINGLES].tolist(), strict=True)
        hashes = np.array([digest(line[a:b], seed) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` (key columns and ``text``) with the text replaced by ``fp``, the fingerprint as a signed long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = (fingerprint(str(text), words) for text in batch.column("text"))
            fps = np.fromiter(values, np.uint64, batch.num_rows).view(np.int64)
            columns = [batch.column(name) for name in batch.schema.names if name != "text"]
            names = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(fps)], [*names, "fp"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(work, f"{schema}, fp long")


def part_counts(fps: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit parts, one row per fingerprint."""
    return np.bitwise_count(np.ascontiguousarray(fps).view("<u2").reshape(-1, 4)).astype(np.int8)


class Forest:
    """Disjoint sets over numbered fingerprints; each root is the smallest number of its set."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def find(self, nodes: np.ndarray) -> np.ndarray:
        up = self.parent[nodes]
        while not np.array_equal(up, above := self.parent[up]):
            up = above
        self.parent[nodes] = up
        return up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Unite the sets of a[i] and b[i] for all i."""
        while len(a):
            ra, rb = self.find(a), self.find(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            # of several lower roots offered to one root, the last is taken; the others wait for the next turn
            self.parent[np.maximum(ra, rb)] = np.minimum(ra, rb)


def _blocks(fps: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Cut ordered fingerprints into blocks: (start, rows, least counts, greatest counts)."""
    found = []
    for at in range(0, len(fps), BLOCK_ROWS):
        rows = fps[at : at + BLOCK_ROWS]
        counts = part_counts(rows)
        found.append((at, rows, counts.min(axis=0).astype(int), counts.max(axis=0).astype(int)))
    return found


def _ordered(fps: Iterable[int]) -> np.ndarray:
    rows = np.array(fps, np.int64).view(np.uint64)
    return rows[np.lexsort(part_counts(rows).T)]


def tile_links(left: Iterable[int], right: Iterable[int] | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles (of one tile if ``right`` is None)."""
    a = _ordered(left)
    b = a if right is None else _ordered(right)
    both = a if right is None else np.concatenate([a, b])
    shift = 0 if right is None else len(a)
    forest = Forest(len(both))
    right_blocks = _blocks(b)
    lows, highs = (np.array([block[i] for block in right_blocks]).reshape(-1, 4) for i in (2, 3))
    for at, rows, low, high in _blocks(a):
        gaps = np.maximum(0, np.maximum(lows - high, low - highs)).sum(axis=1)
        for k in np.flatnonzero(gaps <= radius):
            start, others, _, _ = right_blocks[k]
            if right is None and start < at:
                continue
            near = np.bitwise_count(rows[:, None] ^ others[None, :]) <= radius
            if right is None and start == at:
                near = np.triu(near, 1)
            if near.any():
                i, j = np.nonzero(near)
                forest.join(i + at, j + (start + shift))
    tops = forest.find(np.arange(len(both)))
    moved = np.flatnonzero(tops != np.arange(len(both)))
    return both[moved].view(np.int64), both[tops[moved]].view(np.int64)


def links(fps: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links (u, v) of distinct fingerprints ``fp`` that connect exactly what lies within ``radius`` bits.

    At most 65 population counts exist, so the table of their sizes is broadcast. A count with many
    fingerprints is split over tiles by hash. Each pair of tiles is one row of the join below.
    """
    fps = fps.select("fp", F.bit_count("fp").alias("ones"))
    parts = fps.groupBy("ones").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("parts"))
    parts = F.broadcast(stored(parts, "tile-counts"))
    tiles = fps.join(parts, "ones").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    tiles = stored(tiles.groupBy("ones", "part").agg(F.collect_list("fp").alias("fps")), "tiles")

    # a tile meets the tiles of its own count and of the counts up to the radius above it
    other = parts.select(F.col("ones").alias("other_ones"), F.col("parts").alias("other_parts"))
    pairs = tiles.withColumn("other_ones", F.explode(F.sequence("ones", F.col("ones") + radius)))
    pairs = pairs.join(other, "other_ones")
    pairs = pairs.withColumn("other_part", F.explode(F.sequence(F.lit(0), F.col("other_parts") - 1)))
    pairs = pairs.where("other_ones > ones or other_part >= part")
    right = tiles.select(
        F.col("ones").alias("other_ones"), F.col("part").alias("other_part"), F.col("fps").alias("other_fps")
    )
    same = (F.col("ones") == F.col("other_ones")) & (F.col("part") == F.col("other_part"))
    pairs = pairs.drop("other_parts").join(right, ["other_ones", "other_part"])
    pairs = pairs.select("fps", F.when(~same, F.col("other_fps")).alias("other_fps"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column("fps"), batch.column("other_fps"), strict=True):
                u, v = tile_links(a.values.to_numpy(), b.values.to_numpy() if b.is_valid else None, radius)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return pairs.repartition(F.xxhash64(F.col("fps")[0], F.col("other_fps")[0])).mapInArrow(work, "u long, v long")


def _rooted(docs: DataFrame, words: int, radius: int, tile_rows: int) -> DataFrame:
    """(doc_id, mark, fp, root, component_id) of every row; root, a fingerprint, is the component's identity."""
    whole = docs.select("doc_id", whole_text().alias("text"))
    marked = whole.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    found = stored(fingerprints(marked, words), "fingerprints")
    classes = stored(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    linked = stored(roots(links(classes, radius, tile_rows)), "roots")

    rooted = classes.join(linked, classes.fp == linked.node, "left")
    rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    component = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(rooted.join(component, "root").select("fp", "root", "component_id"), "components")
    return found.join(named, "fp").select("doc_id", "mark", "fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, mark.

    Documents are linked when their fingerprints differ in at most ``radius`` bits; component_id is the
    smallest doc_id reachable (null only if the component has no id). Null and empty texts have the
    fingerprint zero and are linked like any other. ``mark`` hashes the text and tells rows of one id apart.
    A very long text is read whole by one task. An empty table gives an empty result; other columns are not read.
    """
    return _rooted(docs, words, radius, tile_rows).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "mark"
    )


def drop_near_copies(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each component: that of the smallest id.

    Components are told apart by their root, since several may have no id or the same smallest one. Null, empty
    and blank texts are one component; of repeated rows one stays. An empty table stays empty.
    """
    first = _rooted(docs, words, radius, TILE_ROWS).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")).alias("first")
    )
    chosen = first.select(id_text("first.doc_id").alias("id_key"), F.col("first.mark").alias("mark_key"))
    return retain(docs, chosen, F.xxhash64(whole_text()))
