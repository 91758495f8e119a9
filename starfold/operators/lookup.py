"""Code dictionaries and nearest reference points."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window
from pyspark.sql import functions as F

from starfold.functions.geo import unit_vector
from starfold.functions.labels import NOT_IN_DICTIONARY, fill_sentinel
from starfold.operators.facts import with_row_id
from starfold.operators.joins import spread_join
from starfold.session import scratch_dir


def map_codes(
    df: DataFrame, dictionaries: Mapping[str, DataFrame], sentinel: str = NOT_IN_DICTIONARY
) -> DataFrame:
    """Replace each coded column by its dictionary's label, or by ``sentinel`` if it has none.

    Dictionaries have the columns ``key`` and ``value`` and one row per key.
    """
    out = df
    for col, dictionary in dictionaries.items():
        label = f"__label_{col}"
        out = spread_join(
            out, dictionary.select(F.col("key").alias(col), F.col("value").alias(label)), col, "left"
        ).withColumn(col, fill_sentinel(F.col(label), col, sentinel)).drop(label)
    return out.select(*df.columns)


def lookup_name(
    df: DataFrame, on: str, dictionary: DataFrame, key: str | Column, value: str, alias: str, how: str = "left"
) -> DataFrame:
    """Add ``dictionary.value`` as ``alias`` where ``df.on`` equals ``key``, a column or an expression."""
    names = dictionary.select((F.col(key) if isinstance(key, str) else key).alias(on), F.col(value).alias(alias))
    return spread_join(df, names, on, how).select(*df.columns, alias)


_AXES = ("x", "y", "z")
# Rounding slack for comparing distances computed in two ways.
_SLACK = 1e-12
# Sites of a leaf, and children of an inner node.
LEAF_SITES, FAN = 16, 64
# Bits of each axis in the order of the sites; a step is 12 m wide.
ORDER_BITS = 20


def _curve() -> Column:
    """The place of a unit vector on a Z-order curve through the cube around the sphere."""
    steps = [F.least(F.floor((F.col(a) + 1) / 2 * 2**ORDER_BITS), F.lit(2**ORDER_BITS - 1)).cast("bigint") for a in _AXES]
    bits = [
        F.shiftleft(F.shiftright(step, bit).bitwiseAND(F.lit(1)), 3 * bit + axis)
        for bit in range(ORDER_BITS)
        for axis, step in enumerate(steps)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _sum_of_squares(terms: list[Column]) -> Column:
    return terms[0] * terms[0] + terms[1] * terms[1] + terms[2] * terms[2]


def located_sites(sites: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The distinct places of ``sites`` as unit vectors, each with its lowest site; no nulls or NaN."""
    x, y, z = unit_vector(F.col("lat"), F.col("lon"))
    return (
        sites.filter(_is_place("lat", "lon"))
        .groupBy("lat", "lon")
        .agg(F.min(F.struct("site_id", *[c for c in keep if c != "site_id"])).alias("__site"))
        .withColumns({"x": x, "y": y, "z": z})
    )


def _is_place(lat: str, lon: str) -> Column:
    numbers = [F.col(c).cast("double") for c in (lat, lon)]
    return F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~F.isnan(numbers[0]) & ~F.isnan(numbers[1])


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class SiteTree:
    """Sites packed into leaves of like size, with boxes above them.

    ``leaves`` (__node, __sites), ``inner`` levels (__node, __children) from the lowest up, and the boxes of the
    top, at most ``FAN`` of them, as ``root`` and as the rows ``top``.
    """

    leaves: DataFrame
    inner: list[DataFrame]
    root: Column
    top: list[Row]


def site_tree(located: DataFrame) -> SiteTree:
    """Pack ``located`` (x, y, z, __site) into a tree, by their order along a space-filling curve.

    Each leaf has ``LEAF_SITES`` sites whatever ground they cover, and each node ``FAN`` children, so that the
    number of levels follows the number of sites alone, not how densely a town is built. The sites are read
    once; each level is written, ``FAN`` times smaller than the one below it. The top reaches the driver.
    """
    ranked = with_row_id(located.withColumn("__curve", _curve()), ["__curve", "lat", "lon"], "__rank", start=0)
    ends = [f(a).alias(f"{n}_{a}") for a in _AXES for n, f in (("lo", F.min), ("hi", F.max))]
    packed = F.collect_list(F.struct(*_AXES, "__site")).alias("__sites")
    leaf = F.floor(F.col("__rank") / LEAF_SITES).alias("__node")
    leaves = _written(ranked.groupBy(leaf).agg(packed, *ends), "site-leaves")
    bounds = ["__node", *(f"{n}_{a}" for a in _AXES for n in ("lo", "hi"))]
    around = [(F.min if n.startswith("lo") else F.max)(n).alias(n) for n in bounds[1:]]
    level, inner = leaves, []
    while len(top := level.select(*bounds).limit(FAN + 1).collect()) > FAN:
        parent = F.floor(F.col("__node") / FAN).alias("__parent")
        children = F.collect_list(F.struct(*bounds)).alias("__children")
        level = _written(level.groupBy(parent).agg(children, *around).withColumnRenamed("__parent", "__node"), "site-boxes")
        inner.append(level)
    fields = ",".join(f"{n}:{'bigint' if n == '__node' else 'double'}" for n in bounds)
    boxes = [F.struct(*(F.lit(row[n]).alias(n) for n in bounds)) for row in top]
    return SiteTree(leaves, inner, F.array(*boxes).cast(f"array<struct<{fields}>>"), top)


def _within(box: Callable[[str], Column]) -> tuple[Column, Column]:
    """How near a site of a box may be to the row's place, and how far its nearest one is at most, both squared."""
    below = [F.greatest(box(f"lo_{a}") - F.col(a), F.col(a) - box(f"hi_{a}"), F.lit(0.0)) for a in _AXES]
    sides = [(F.abs(box(f"lo_{a}") - F.col(a)), F.abs(box(f"hi_{a}") - F.col(a))) for a in _AXES]
    beyond = [F.greatest(*side) for side in sides]
    # a site lies on each face of its box, so that on one axis the nearer face may stand for the farther
    spared = F.greatest(*(far * far - F.least(*side) * F.least(*side) for far, side in zip(beyond, sides, strict=True)))
    return _sum_of_squares(below), _sum_of_squares(beyond) - spared


def _boxed(cand: DataFrame, children: Column) -> DataFrame:
    """Each candidate's children, without those that its bound excludes."""
    boxed = cand.select("lat", "lon", *_AXES, "__best", F.inline(children))
    return boxed.filter(_within(F.col)[0] <= F.col("__best") + _SLACK)


def _enter(spots: DataFrame, tree: SiteTree) -> DataFrame:
    """The boxes of the top that may hold the nearest site of each spot.

    Their bounds are numbers known beforehand, so a spot's best one excludes most boxes before they are rows.
    """
    # 4 is the largest squared distance on the sphere
    bounds = [_within(lambda name, row=row: F.lit(row[name]))[1] for row in tree.top]
    return _descend(spots.withColumn("__best", F.least(F.lit(4.0), F.lit(4.0), *bounds)), tree.root)


def _descend(cand: DataFrame, children: Column) -> DataFrame:
    """Replace each candidate node by those of its children that may hold the nearest site of its spot."""
    per_spot = Window.partitionBy("lat", "lon")
    near, far = _within(F.col)
    return (
        _boxed(cand, children)
        .withColumn("__near", near)
        .select("lat", "lon", *_AXES, "__near", F.least("__best", F.min(far).over(per_spot)).alias("__best"), "__node")
        .filter(F.col("__near") <= F.col("__best") + _SLACK)
        .select("lat", "lon", *_AXES, "__best", "__node")
    )


def leaf_candidates(spots: DataFrame, tree: SiteTree) -> DataFrame:
    """The leaves (``__node``) that may hold the nearest site of each spot (lat, lon, x, y, z)."""
    cand = _enter(spots, tree)
    for level in reversed(tree.inner):
        joined = spread_join(cand, level.select("__node", "__children"), "__node")
        cand = _descend(joined.drop("__node"), F.col("__children"))
    return cand


def nearest_site(
    points: DataFrame, sites: DataFrame, lat: str, lon: str, keep: Mapping[str, str]
) -> DataFrame:
    """Add columns of the nearest site to each point; ``keep`` maps site column -> new name.

    ``sites`` has ``site_id, lat, lon`` and the kept columns. Ties go to the lowest ``site_id``; points
    and sites without a place (null or NaN) find and are found by nothing.

    The sites are packed into a tree of boxes (``site_tree``), and the search descends it, a join per inner
    level. A point follows only boxes that may still hold its nearest site: those whose closest possible
    site is no farther than the farthest possible site of some other box. A dense town has smaller leaves,
    not more levels, so the search costs the same number of shuffles wherever the sites lie. The result is
    exact. Each distinct place is searched once, whatever share of the points it has.
    """
    tree = site_tree(located_sites(sites, list(keep)))
    x, y, z = unit_vector(F.col("lat"), F.col("lon"))
    spots = points.filter(_is_place(lat, lon)).select(F.col(lat).alias("lat"), F.col(lon).alias("lon")).distinct()
    # places are few bytes but much work, which adaptive execution would put together by their bytes
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cand = leaf_candidates(spots.repartition(parts, "lat", "lon").withColumns({"x": x, "y": y, "z": z}), tree)

    met = spread_join(cand, tree.leaves.select("__node", F.col("__sites").alias("__s")), "__node")

    def measured(site: Column) -> Column:
        return F.struct(_sum_of_squares([F.col(a) - site[a] for a in _AXES]).alias("d"), site["__site"].alias("s"))

    # the nearest of a leaf is found in its row, so that a row per leaf is compared and not one per site
    found = (
        met.groupBy("lat", "lon")
        .agg(F.min(F.array_min(F.transform("__s", measured))).alias("__best"))
        .select(
            F.col("lat").alias(lat), F.col("lon").alias(lon),
            *[F.col(f"__best.s.{c}").alias(name) for c, name in keep.items()],
        )
    )
    return spread_join(points, found, [lat, lon], "left").select(*points.columns, *keep.values())
