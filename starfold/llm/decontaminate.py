"""Benchmark decontamination by template windows.

Numbers, units and names are replaced by typed placeholders, so a question keeps its template when only
its values change. Windows of the benchmark's templates are hash-joined with the documents' windows.
Matches that lie on one line (document place minus item place) are held against each other: the values
in the slots must correspond one to one, or the document only shares phrases with the item. A window of few
literal words says little as a template; it counts where its slots hold the item's own values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import id_text, stored, whole_text, without

WINDOW = 8
# Words that are not placeholders, from which on a window counts with other values too.
LITERALS = 5
# Part of an item's windows that a document must share.
COVERAGE = 0.5
BROADCAST_WINDOWS = 2_000_000
# Hashes of texts with a match that are broadcast at most.
BROADCAST_MARKS = 2_000_000

NUMBER, UNIT, NAME = "⟨n⟩", "⟨u⟩", "⟨p⟩"
# Units that follow a number; fixed values.
UNITS = "km|cm|mm|kg|mg|ml|mph|kmh|lbs?|oz|ft|inch(?:es)?|miles?|met(?:er|re)s?|grams?|lit(?:er|re)s?|hours?|hrs?|" \
    "minutes?|mins?|seconds?|secs?|days?|weeks?|months?|years?|dollars?|euros?|cents?|pounds?|percent|degrees?"
# A token: a marked name, a number with its inner points, letters with inner apostrophes, or a sign of currency or percent.
TOKEN = NAME + r"\p{L}++|[0-9]++(?:[.,][0-9]++)*+|\p{L}++(?:['’]\p{L}++)*+|[%$€£]"
# Title case within a sentence: after a word, comma or the like and blanks, not after the end of a sentence.
INNER_NAME = r"(?=\s)(?<=[\p{L}\p{N},;:)\x22'’])(\s+)(\p{Lu}\p{Ll}++)(?!\p{L})"


def tokens(text: Column) -> Column:
    """The words of a text in order and in lower case; a name within a sentence is led by a mark."""
    marked = F.lower(F.regexp_replace(with_units(text), INNER_NAME, "$1" + NAME + "$2"))
    return F.regexp_extract_all(marked, F.lit(TOKEN), F.lit(0))


def template(words: Column) -> Column:
    """Each word as its typed placeholder, or as it is."""

    def typed(word: Column) -> Column:
        return (
            F.when(word.between("a", "{"), word)
            .when(word.startswith(NAME), NAME)
            .when(word.between("0", ":"), NUMBER)
            .when(word.isin("%", "$", "€", "£"), UNIT)
            .otherwise(word)
        )

    return F.transform(words, typed)


def with_units(text: Column) -> Column:
    """Units after a number, as the sign of one, so that they are typed like it."""
    return F.regexp_replace(text, r"(?i)([0-9])(\s{0,8})(?:" + UNITS + r")(?![\p{L}])", "$1$2%")


def _templates(table: DataFrame) -> DataFrame:
    return table.withColumn("words", tokens(F.col("text"))).withColumn("typed", template(F.col("words")))


def _with_spans(table: DataFrame, width: int) -> DataFrame:
    """Add ``span1, span2, span4, ...`` up to ``width``: hashes of that many words from each place on.

    Each column combines neighbours of the one before, so that a window costs a few combinations of
    numbers instead of ``width`` words.
    """
    table, size = table.withColumn("span1", F.transform("typed", lambda w: F.xxhash64(w))), 1
    while 2 * size <= width:
        table = table.withColumn(f"span{2 * size}", _joined(F.col(f"span{size}"), F.col(f"span{size}"), size))
        size *= 2
    return table


def _joined(left: Column, right: Column, after: int) -> Column:
    """Hashes of the spans of ``left`` with those of ``right`` that begin ``after`` words later."""
    later = F.slice(right, F.lit(after + 1), F.greatest(F.size("typed"), F.lit(1)))
    return F.zip_with(left, later, lambda a, b: F.xxhash64(a, b))


def _windows(width: int) -> Column:
    """(place, hash, width) of each window of ``width`` words, from the spans; none if there are fewer words."""
    found, covered, size = None, 0, 1
    while size <= width:
        if width & size:
            found = F.col(f"span{size}") if found is None else _joined(found, F.col(f"span{size}"), covered)
            covered += size
        size *= 2
    whole = F.slice(found, F.lit(1), F.greatest(F.size("typed") - width + 1, F.lit(0)))
    return F.transform(whole, lambda h, at: F.struct(at.alias("place"), h.alias("hash"), F.lit(width).alias("width")))


def _slots(place: Column, width: Column) -> Column:
    """The values of a window's slots, in order, names without their mark."""
    pairs = F.arrays_zip(F.slice("words", place + 1, width).alias("word"), F.slice("typed", place + 1, width).alias("type"))
    filled = F.filter(pairs, lambda p: p["type"].isin(NUMBER, UNIT, NAME))
    return F.transform(filled, lambda p: F.replace(p["word"], F.lit(NAME), F.lit("")))


def _few(width: Column, slots: Column, literals: int) -> Column:
    """Whether a window has fewer literal words than ``literals``; all places of one hash agree in it."""
    return width - F.size(slots) < literals


def _value(width: Column, slots: Column, literals: int) -> Column:
    """What a window's slots must agree in to meet: the values if it has few literal words, else nothing."""
    return F.when(_few(width, slots, literals), F.xxhash64(slots)).otherwise(F.lit(0).cast("long"))


def item_windows(benchmark: DataFrame, window: int = WINDOW, literals: int = LITERALS) -> DataFrame:
    """Windows of the benchmark's items: item_id, item, item_place, hash, width, value, item_slots, and how they count.

    An item with fewer words than a window is one window of its own width. An item is read twice: alone, and
    as behind a colon, where its first word may be typed as a name. Windows of the second reading alone
    count as the first window of the item (``counted``, ``few``); with ``led``, their first slot is the
    item's own word. ``item_windows`` and ``full_windows`` are the numbers of all and of those not ``few``.
    """
    items = benchmark.select("item_id", whole_text().alias("text")).distinct()
    items = items.withColumn("item", F.xxhash64("item_id", "text"))
    behind = items.withColumns({"reading": F.lit(1), "text": F.concat(F.lit(": "), "text")})
    items = _templates(items.withColumn("reading", F.lit(0)).unionByName(behind)).where(F.size("typed") > 0)
    items = items.withColumn("width", F.least(F.lit(window), F.size("typed")))
    items, own = _with_spans(items, window), F.lit(None)
    for width in range(1, window + 1):
        own = F.when(F.col("width") == width, _windows(width)).otherwise(own)
    found = items.withColumn("window", F.explode(own)).select(
        "item_id",
        "item",
        "reading",
        F.col("window.place").alias("item_place"),
        F.col("window.hash").alias("hash"),
        "width",
        _slots(F.col("window.place"), F.col("width")).alias("item_slots"),
    )
    # a window that an item repeats is matched at its first place; few literal words, at each place by its values
    found = found.withColumn("few", _few(F.col("width"), F.col("item_slots"), literals))
    found = found.withColumn("value", _value(F.col("width"), F.col("item_slots"), literals))
    first = found.groupBy("item_id", "item", "hash", "width", "value", "few").agg(
        F.min(F.struct("reading", "item_place", "item_slots")).alias("first")
    )
    first = first.select("item_id", "item", "hash", "width", "value", "few", "first.*")
    first = first.withColumn("counted", F.xxhash64("hash", "value"))
    alone = F.col("reading") == 0
    total = first.groupBy("item").agg(
        F.count_if(alone).alias("item_windows"),
        F.count_if(alone & ~F.col("few")).alias("full_windows"),
        F.min_by(F.struct("counted", "few"), F.struct("reading", "item_place")).alias("head"),
    )
    first = first.join(total, "item")
    return first.select(
        "item_id", "item", "hash", "width", "value", "item_place", "item_slots", "item_windows", "full_windows",
        F.when(alone, F.col("counted")).otherwise(F.col("head.counted")).alias("counted"),
        F.when(alone, F.col("few")).otherwise(F.col("head.few")).alias("few"),
        (~alone & (F.col("item_place") == 0)).alias("led"),
    )


def matched_windows(
    keyed: DataFrame, windows: DataFrame, broadcast_windows: int = BROADCAST_WINDOWS, literals: int = LITERALS,
    broadcast_marks: int = BROADCAST_MARKS,
) -> DataFrame:
    """The windows of ``keyed`` (id_key, mark_key, doc_id, text) that an item has, with their slots.

    Every window of every document is hashed and held against the hashes of the benchmark, of 12 bytes each, which
    are broadcast up to ``broadcast_windows`` of them, counted first, and shuffled beyond. Only documents with
    a match are read again, for the values of the slots: the matches are stored, and up to ``broadcast_marks`` of their
    texts' hashes, 8 bytes each, are broadcast to pick these documents before they are moved; beyond, all are. A
    window of few literal words meets only items with its own values, so that a table of numbers does not meet
    them all. The items' windows are broadcast by the size that Spark measures. Repeated rows count once.
    """
    hashes = windows.select("hash", "width").distinct()
    if hashes.count() <= broadcast_windows:
        hashes = F.broadcast(hashes)
    widths = sorted(row[0] for row in windows.select("width").distinct().collect())  # at most the window's width
    every = F.concat(*map(_windows, widths or [WINDOW]))
    spans = _with_spans(_templates(keyed), max(widths or [WINDOW]))
    span = spans.select("id_key", "mark_key", F.explode(every).alias("span"))
    span = span.select("id_key", "mark_key", "span.place", "span.hash", "span.width")
    matched = span.join(hashes, ["hash", "width"], "left_semi")
    matched = matched.groupBy("id_key", "mark_key").agg(F.collect_set(F.struct("place", "hash", "width")).alias("spans"))
    matched = stored(matched, "matches")

    marks, near = matched.select("mark_key").distinct(), keyed
    if marks.count() <= broadcast_marks:
        near = keyed.join(F.broadcast(marks), "mark_key", "left_semi")
    hit = near.join(matched, ["id_key", "mark_key"]).dropDuplicates(["id_key", "mark_key"])
    found = F.transform("spans", lambda s: s.withField("slots", _slots(s["place"], s["width"])))
    hit = _templates(hit).select("id_key", "mark_key", "doc_id", F.explode(found).alias("s"))
    hit = hit.select("id_key", "mark_key", "doc_id", "s.*")
    hit = hit.withColumn("value", _value(F.col("width"), F.col("slots"), literals))
    hit = hit.join(windows, ["hash", "width", "value"])
    return hit.where(~F.col("led") | (F.get("slots", F.lit(0)) == F.get("item_slots", F.lit(0))))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    coverage: float = COVERAGE,
    literals: int = LITERALS,
) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, matched, item_windows, exact_slots, and the row's keys.

    A line of matches counts if its slots are consistent: equal values of the item stand for equal values of the
    document, and different for different. A document holds an item if the lines that count have ``coverage``
    of its windows with ``literals`` literal words or more, or if these and the others, which count with the
    item's own values alone, have it of all. matched and item_windows are the numbers of the one that holds,
    first of all windows. exact_slots tells whether a line has the item's own values. Null and empty texts
    hold nothing; without documents or items the result is empty. Repeated rows give one row. A very long text is
    read whole by one task; its windows are as many rows as it has words.
    """
    windows = stored(item_windows(benchmark, window, literals), "windows")
    keyed = docs.select("doc_id", whole_text().alias("text"))
    keyed = keyed.withColumns({"id_key": id_text(), "mark_key": F.xxhash64("text")})
    found = matched_windows(keyed, windows, literals=literals)

    item = ["id_key", "mark_key", "doc_id", "item_id", "item", "item_windows", "full_windows"]
    line = (F.col("place") - F.col("item_place")).alias("line")
    pairs = F.arrays_zip(F.col("item_slots").alias("ours"), F.col("slots").alias("theirs"))
    # values that are the item's own by themselves bind no others
    pairs = F.when(F.col("few"), F.slice(pairs, 1, 0)).when(F.col("led"), F.slice(pairs, F.lit(2), F.size(pairs))).otherwise(pairs)
    lines = found.select(*item, line, "counted", "few", pairs.alias("pairs")).groupBy(*item, "line").agg(
        F.collect_set(F.when(~F.col("few"), F.col("counted"))).alias("full"),
        F.collect_set(F.when(F.col("few"), F.col("counted"))).alias("own"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
    )
    one_to_one = (F.size(F.array_distinct("pairs.ours")) == F.size("pairs")) & (
        F.size(F.array_distinct("pairs.theirs")) == F.size("pairs")
    )
    lines = lines.withColumn("full", F.when(one_to_one, F.col("full")).otherwise(F.slice("full", 1, 0)))
    lines = lines.where((F.size("full") > 0) | (F.size("own") > 0))
    same = F.forall("pairs", lambda p: p["ours"] == p["theirs"])

    def number(hashes: str) -> Column:
        return F.size(F.array_distinct(F.flatten(F.collect_set(hashes)))).cast("long")

    held = lines.withColumn("same", same).groupBy(*item).agg(
        number("full").alias("full"), number("own").alias("own"), F.max("same").alias("exact_slots")
    )
    every = F.col("full") + F.col("own") >= F.lit(coverage) * F.col("item_windows")
    full = (F.col("full") > 0) & (F.col("full") >= F.lit(coverage) * F.col("full_windows"))
    held = held.where(every | full).select(
        "id_key", "mark_key", "doc_id", "item_id", "exact_slots",
        F.when(every, F.col("full") + F.col("own")).otherwise(F.col("full")).alias("matched"),
        F.when(every, F.col("item_windows")).otherwise(F.col("full_windows")).alias("item_windows"),
    )
    best = held.groupBy("id_key", "mark_key", "doc_id", "item_id").agg(
        F.max(F.struct("matched", "item_windows", "exact_slots")).alias("best")
    )
    return best.select("doc_id", "item_id", "best.*", "id_key", "mark_key")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item of ``benchmark``.

    Null and empty texts stay. Repeated rows are judged alike and all stay or go. Without documents the result is
    empty, without items it is ``docs``.
    """
    found = contaminated(docs, benchmark, **settings).select("id_key", "mark_key").distinct()
    # stored, so that its size is known: within Spark's broadcast limit the documents are not moved
    return without(docs, stored(found, "contaminated"), F.xxhash64(whole_text()))
