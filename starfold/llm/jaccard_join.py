"""N-gram Jaccard join over size-banded tiles with hashed bitmap signatures.

A document is the set of its distinct word shingles, kept as an ascending array of 64-bit hashes; equal
sets are one class. Sets that link differ in size by a bounded factor, so sizes are cut into bands of
that factor and a set meets sets of its own band and the two beside it only. Every set has a bitmap whose
bits are the parities of its hashes in as many buckets: two bitmaps differ in no more bits than the
sets have elements that are not common, which bounds their overlap from above. Pairs of tiles compare
bitmaps, first folded to few words, then whole; folding is an exclusive-or of halves, so the bound holds.

What passes is not yet a link. Only the sets that take part in such a pair are then sent, once for each
tile pair and group that they hang together in, and their arrays are intersected exactly. Pairs that are
connected already need no intersection, so a large group of copies costs work in proportion to its size.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import stored, whole_text
from starfold.llm.components import roots
from starfold.llm.simhash import Forest

SHINGLE_WORDS = 5
# Links have at least this percentage of their union in common.
PERCENT = 80
# Sets in a tile, and bytes of their arrays, at most on average.
TILE_ROWS = 32_768
TILE_BYTES = 128_000_000
# Small tables are cut into about so many tiles, of at least so many sets, to share the work out evenly.
TILES = 48
LEAST_TILE = 256
# Tasks that the pairs of tiles are dealt to; more pairs than that share tasks.
MOST_TASKS = 20_000
BLOCK_ROWS = 256
# Bytes of shingles in one batch of results.
BATCH_BYTES = 16_000_000
# Numbers of rows (8 bytes each) that are broadcast; beyond, all sets are shuffled to meet their candidates.
BROADCAST_ROWS = 2_000_000
MARK_SEED = 1


def shingles(text: str, words: int = SHINGLE_WORDS) -> np.ndarray:
    """The ascending distinct hashes of a text's shingles; a text of fewer words is one shingle, none has none.

    ``bytes.lower`` lowers A-Z alone and ``bytes.split`` splits at the six ASCII white-space characters.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    line = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(found) > words:
        starts, ends = starts[: len(found) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh3_64_intdigest
    hashes = [digest(line[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    return np.unique(np.array(hashes, np.uint64))


def band_floors(percent: int = PERCENT, largest: int = 1 << 40) -> list[int]:
    """The least size of each band: a partner of a set is at most one band away."""
    floors = [1]
    while floors[-1] < largest:
        floors.append(floors[-1] * 100 // percent + 1)
    return floors


def words_of(size: int) -> int:
    """64-bit words of the bitmaps of a band whose least size is ``size``: two to four bits an element."""
    return 1 << max(0, (2 * size - 1).bit_length() - 6)


def bitmap(hashes: np.ndarray, words: int) -> np.ndarray:
    """Parities of the hashes in 64 * ``words`` buckets."""
    counts = np.bincount((hashes & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words)
    return np.packbits((counts & 1).astype(bool), bitorder="little").view("<u8")


def folded(maps: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps, one per row, as they are with fewer buckets."""
    while maps.shape[1] > words:
        half = maps.shape[1] // 2
        maps = maps[:, :half] ^ maps[:, half:]
    return maps


def first_words(size: int, words: int, percent: int) -> int:
    """Fewest words, a power of two, at which unrelated sets of about ``size`` differ clearly beyond a link's bound."""
    few = 1
    while few < words and 32 * few - 12 * few**0.5 < 2 * size * (100 - percent) / (100 + percent):
        few *= 2
    return few


def near_pairs(
    a: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_sizes: np.ndarray, same: bool, percent: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows, in blocks, that size and bitmaps do not rule out; rows ascend by size.

    Two sets link when (100 - p) * (size + size) >= (100 + p) * (elements that are not common).
    """
    words = min(a.shape[1], b.shape[1])
    a, b = folded(a, words), folded(b, words)
    few = first_words(int(max(a_sizes.max(initial=0), b_sizes.max(initial=0))), words, percent)
    a_few, b_few = folded(a, few), folded(b, few)
    keep, lose = 100 - percent, 100 + percent
    a_words, b_words = np.ascontiguousarray(a_few.T), np.ascontiguousarray(b_few.T)
    differ = np.empty((BLOCK_ROWS, BLOCK_ROWS), np.uint64)
    ones = np.empty((BLOCK_ROWS, BLOCK_ROWS), np.uint8)
    apart = np.empty((BLOCK_ROWS, BLOCK_ROWS), np.uint8 if few < 4 else np.uint32 if few > 1000 else np.uint16)
    for at in range(0, len(a), BLOCK_ROWS):
        left = a_words[:, at : at + BLOCK_ROWS, None]
        sizes = a_sizes[at : at + BLOCK_ROWS]
        low = np.searchsorted(b_sizes * 100, sizes[0] * percent)
        high = np.searchsorted(b_sizes * percent, sizes[-1] * 100, side="right")
        for start in range(max(low, at) if same else low, high, BLOCK_ROWS):
            end = min(high, start + BLOCK_ROWS)
            right = b_words[:, None, start:end]
            space = np.s_[: len(sizes), : end - start]
            total = apart[space]
            total.fill(0)
            for w in range(few):
                np.bitwise_xor(left[w], right[w], out=differ[space])
                np.add(total, np.bitwise_count(differ[space], out=ones[space]), out=total)
            # a bound for the whole block first, then each pair's own
            most = keep * int(sizes[-1] + b_sizes[end - 1]) // lose
            i, j = np.nonzero(total <= min(most, np.iinfo(total.dtype).max))
            i, j = i + at, j + start
            passed = i < j if same else np.ones(len(i), bool)
            most = keep * (a_sizes[i] + b_sizes[j]) // lose
            passed &= (total[i - at, j - start] <= most) & (np.abs(a_sizes[i] - b_sizes[j]) <= most)
            i, j, most = i[passed], j[passed], most[passed]
            if few < words:
                found = [np.empty(0, bool)]
                for k in range(0, len(i), 4096):
                    part = np.s_[k : k + 4096]
                    found.append(np.bitwise_count(a[i[part]] ^ b[j[part]]).sum(axis=1, dtype=np.int64) <= most[part])
                passed = np.concatenate(found)
                i, j = i[passed], j[passed]
            if len(i):
                yield i, j


def _maps(column: pa.Array) -> np.ndarray:
    """Bitmaps of one width, one per row."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(len(column), -1)


def _tile(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, sizes, bitmaps) of one side of a pair of tiles, ascending by size."""
    order = np.lexsort((rows.column("row").to_numpy(), rows.column("size").to_numpy()))
    rows = rows.take(pa.array(order))
    maps = _maps(rows.column("bits").combine_chunks()) if len(rows) else np.empty((0, 1), np.uint64)
    return rows.column("row").to_numpy(), rows.column("size").to_numpy(), maps


def _sides(rows: pa.Table) -> tuple:
    left = rows.column("left").to_numpy(zero_copy_only=False)
    a = _tile(rows.filter(pa.array(left)))
    return (a, a, True) if left.all() else (a, _tile(rows.filter(pa.array(~left))), False)


def shared(a: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many elements ``a`` has in common with each of ``others``, all ascending."""
    lengths = np.fromiter(map(len, others), np.int64, len(others))
    flat = np.concatenate(others)
    at = np.searchsorted(a, flat)
    hit = np.append(0, np.cumsum((at < len(a)) & (a[np.minimum(at, len(a) - 1)] == flat)))
    ends = np.cumsum(lengths)
    return hit[ends] - hit[ends - lengths]


def exact_links(rows: pa.Table, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links of a pair of tiles' rows, with bitmaps and arrays in ``rows``.

    The candidates of a row are intersected a few at a time, the nearest rows first; those that are
    connected to it by then are left out.
    """
    arrays = dict(zip(rows.column("row").to_pylist(), rows.column("shingles").combine_chunks(), strict=True))
    (a, a_sizes, a_maps), (b, b_sizes, b_maps), same = _sides(rows)
    names = a if same else np.concatenate([a, b])
    shift = 0 if same else len(a)
    sizes = a_sizes if same else np.concatenate([a_sizes, b_sizes])
    forest = Forest(len(names))

    def array(at: int) -> np.ndarray:
        return arrays[int(names[at])].values.to_numpy().view(np.uint64)

    for left, right in near_pairs(a_maps, a_sizes, b_maps, b_sizes, same, percent):
        cuts = np.flatnonzero(np.diff(left)) + 1
        for i, group in zip(left[np.append(0, cuts)].tolist(), np.split(right + shift, cuts), strict=True):
            some = 1
            while len(group := group[forest.find(group) != forest.find(np.array([i]))]):
                tested, group = group[:some], group[some:]
                common = shared(array(i), [array(k) for k in tested.tolist()])
                linked = tested[100 * common >= percent * (sizes[i] + sizes[tested] - common)]
                forest.join(np.full(len(linked), i), linked)
                some = min(2 * some, 64)
    tops = forest.find(np.arange(len(names)))
    moved = np.flatnonzero(tops != np.arange(len(names)))
    return names[moved], names[tops[moved]]


def shingle_sets(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` (doc_id, text) as row, doc_id, size, mark (a digest of the set), band, bits, shingles."""
    floors = band_floors(percent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "size", "mark", "band", "bits", "shingles"]
        for batch in batches:
            start, held, rows = 0, 0, []
            for at, text in enumerate(batch.column("text"), 1):
                found = shingles(str(text), words)
                raw = found.tobytes()
                band = bisect_right(floors, len(found)) - 1
                bits = bitmap(found, words_of(floors[band])).tobytes() if len(found) else b""
                rows.append((len(found), xxhash.xxh3_128_digest(raw, MARK_SEED), band, bits, found.view(np.int64)))
                held += len(raw)
                if held < BATCH_BYTES and at < batch.num_rows:
                    continue
                size, mark, band, bits, sets = zip(*rows, strict=True)
                offsets = np.cumsum([0, *size], dtype=np.int32)
                sets = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))
                ids = batch.column("doc_id").slice(start, at - start)
                columns = [ids, pa.array(size, pa.int64()), pa.array(mark, pa.binary()), pa.array(band, pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(bits, pa.binary()), sets], names)
                start, held, rows = at, 0, []

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        work, f"doc_id {kind}, size long, mark binary, band int, bits binary, shingles array<long>"
    )
    return found.withColumn("row", F.monotonically_increasing_id())


def _tiles(sets: DataFrame, percent: int, tile_rows: int, tile_bytes: int) -> tuple[DataFrame, int]:
    """The tiles of each band, with the first numbers of its pairs of tiles, and the number of all pairs.

    All tiles have about the same number of sets, so pairs are equal work. There are as many bands as the
    logarithm of the largest size (some 125 at most), so the table is made on the driver.
    """
    floors = band_floors(percent)
    rows = dict(sets.groupBy("band").count().collect())
    even = max(LEAST_TILE, min(tile_rows, -(-sum(rows.values()) // TILES)))
    tiles = {band: -(-n // max(1, min(even, tile_bytes // (8 * floors[band + 1])))) for band, n in rows.items()}
    found, at = [], 0
    for band, n in sorted(tiles.items()):
        above = tiles.get(band + 1, 0)
        upward = at + n * (n + 1) // 2
        found.append((band, n, above, at, upward))
        at = upward + n * above
    beside = [(b, n, above, own, up, *next(((m, f) for c, m, _, _, f in found if c == b - 1), (0, 0))) for b, n, above, own, up in found]
    names = "band int, tiles int, above int, own long, upward long, below int, downward long"
    return sets.sparkSession.createDataFrame(beside, names), max(1, at)


def _dealt(sets: DataFrame, tiles: DataFrame) -> DataFrame:
    """``sets`` (row, size, band, bits) with one row for each pair of tiles (``cell``) that a set's tile is in.

    A band is cut into tiles by hash; a tile meets itself, the others of its band, and those of the next.
    """
    tiled = sets.join(F.broadcast(tiles), "band")
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("row"), F.col("tiles")).cast("int"))
    tile, n = F.col("tile"), F.col("tiles")

    def cells(count, number, left):
        each = F.transform(F.sequence(F.lit(0), count - 1), lambda t: F.struct(number(t).alias("cell"), left(t).alias("left")))
        return F.when(count > 0, each).otherwise(F.array().cast("array<struct<cell:bigint,left:boolean>>"))

    def own(t):
        first, second = F.least(t, tile), F.greatest(t, tile)
        return F.col("own") + first * n - F.shiftright(first * (first - 1), 1) + second - first

    within = cells(n, own, lambda t: tile <= t)
    upward = cells(F.col("above"), lambda t: F.col("upward") + tile * F.col("above") + t, lambda t: F.lit(True))
    downward = cells(F.col("below"), lambda t: F.col("downward") + t * n + tile, lambda t: F.lit(False))
    found = tiled.select("row", "size", "bits", F.explode(F.concat(within, upward, downward)).alias("in"))
    return found.select("row", "size", "bits", "in.cell", "in.left")


def set_links(
    sets: DataFrame, arrays: DataFrame, percent: int = PERCENT, tile_rows: int = TILE_ROWS, tile_bytes: int = TILE_BYTES
) -> DataFrame:
    """Links (u, v) of rows that connect exactly the ``sets`` (row, size, band, bits; one row per distinct set)
    that link. ``arrays`` (row, size, bits, shingles) holds their shingles and may hold other rows.
    """
    # below, one differing element is too many, so no two different sets link
    least = next(s for s in range(1, 10**6) if (100 - percent) * (s + s * 100 // percent) >= 100 + percent)
    sets = sets.where(F.col("size") >= least)
    tiles, pairs = _tiles(sets, percent, tile_rows, tile_bytes)
    tasks = min(pairs, MOST_TASKS)
    dealt = _dealt(sets, tiles)
    dealt = dealt.withColumn("task", F.pmod("cell", F.lit(tasks)).cast("int")).repartitionById(tasks, F.col("task"))

    def candidates(rows: pa.Table) -> pa.Table:
        (a, a_sizes, a_maps), (b, b_sizes, b_maps), same = _sides(rows)
        names = a if same else np.concatenate([a, b])
        shift = 0 if same else len(a)
        forest, met = Forest(len(names)), np.zeros(len(names), bool)
        if len(a) and len(b):
            for i, j in near_pairs(a_maps, a_sizes, b_maps, b_sizes, same, percent):
                met[i] = met[j + shift] = True
                forest.join(i, j + shift)
        at = np.flatnonzero(met)
        cell = pa.array([rows.column("cell")[0].as_py()] * len(at), pa.int64())
        left = pa.array(np.ones(len(at), bool) if same else at < len(a))
        columns = [cell, pa.array(names[forest.find(at)]), pa.array(names[at]), left]
        return pa.Table.from_arrays(columns, ["cell", "group", "row", "left"])

    met = dealt.groupBy("task", "cell").applyInArrow(candidates, "cell long, group long, row long, left boolean")
    met = stored(met, "candidates")
    # groups differ much in size: ranges of about as many rows each become the tasks
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.repartitionByRange(parts, "cell", "group").withColumn("task", F.spark_partition_id())
    met = stored(met, "candidate-groups")

    def verify(rows: pa.Table) -> pa.Table:
        u, v = exact_links(rows, percent)
        return pa.Table.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    wanted = stored(met.select("row").distinct(), "candidate-rows")
    if wanted.count() <= BROADCAST_ROWS:
        # few sets have a candidate: only those are shuffled
        arrays = arrays.join(F.broadcast(wanted), "row", "left_semi")
    full = met.join(arrays, "row")
    most = max(parts, 1 + (met.agg(F.max("task")).first()[0] or 0))
    full = full.repartitionById(most, F.col("task"))
    return full.groupBy("task", "cell", "group").applyInArrow(verify, "u long, v long")


def jaccard_components(
    docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT, tile_rows: int = TILE_ROWS,
    tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Two documents link when their sets of distinct ``words``-word shingles have at least ``percent`` percent
    of their union in common; component_id is the smallest doc_id reachable (null only if the component has
    no id). Null, empty and blank texts have no shingles and link with nothing, not even with each
    other. Repeated rows are linked as equal texts are. A text of fewer words is one shingle of them all.
    An empty table gives an empty result; other columns are not read. A very long text is read whole by one
    task, and met only by sets of nearly its size. Comparing is quadratic in the number of distinct sets of
    like size.
    """
    found = stored(shingle_sets(docs, words, percent), "shingle-sets")
    some = F.col("size") > 0
    # equal sets have equal bitmaps, so these come along as a part of the key
    classes = found.where(some).groupBy("mark", "size", "band", "bits")
    classes = stored(classes.agg(F.min("row").alias("row"), F.min("doc_id").alias("least")), "classes")
    sets = classes.select("row", "size", "band", "bits")
    arrays = found.select("row", "size", "bits", "shingles")
    linked = stored(roots(set_links(sets, arrays, percent, tile_rows, tile_bytes)), "roots")
    rooted = classes.join(linked, classes.row == linked.node, "left")
    rooted = rooted.select("mark", "size", "least", F.coalesce("root", "row").alias("root"))
    component = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(rooted.join(component, "root").select("mark", "size", "component_id"), "components")
    alone = found.where(~some).select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    placed = found.where(some).select("doc_id", "mark", "size").join(named, ["mark", "size"])
    return placed.select("doc_id", F.col("size").alias("n_shingles"), "component_id").unionByName(alone)
