"""Choosing scenes: best pairs, first pairs, priority tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.functions.expressions import doy_to_date, floor_days


def search(items: DataFrame, start: str, end: str, cloud: float, inclusive: bool = False, nodata: int | None = None, tile: int | None = None) -> DataFrame:
    """Catalogue items by date, cloud and, if given, nodata share and tile. All of it is pushed to the scan."""
    keep = (F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(end).cast("timestamp_ntz"))
    keep = keep & ((F.col("cloud") <= cloud) if inclusive else (F.col("cloud") < cloud))
    if nodata is not None:
        keep = keep & (F.col("nodata") < nodata)
    if tile is not None:
        keep = keep & (F.col("tile") == tile)
    return items.filter(keep)


def search_shapes(items: DataFrame, area: tuple[float, float, float, float], exact: Column, fallback: bool = False) -> DataFrame:
    """Items (box x0, y0, x1, y1) whose shape meets an area: the box test goes to the scan, the exact one refines what it lets through.

    fallback: the catalogue could not answer the exact question, so only boxes are compared.
    """
    x0, y0, x1, y1 = area
    near = (F.col("x0") <= x1) & (F.col("x1") >= x0) & (F.col("y0") <= y1) & (F.col("y1") >= y0)
    return items.filter(near if fallback else near & exact)


def rung(c1: Column, c2: Column, ladder: list[float], inclusive: bool = False) -> Column:
    """The first threshold of the ladder under which both clouds fall; null if none does."""
    worst, out = F.greatest(c1, c2), F.lit(None).cast("double")
    for th in sorted(ladder, reverse=True):
        out = F.when((worst <= th) if inclusive else (worst < th), float(th)).otherwise(out)
    return out


def best_pair(scenes: DataFrame, months: float, ladder: list[float], inclusive: bool = False) -> DataFrame:
    """One pair of scenes for each tile (tile, rung, s1, s2, cloud_sum, gap_days).

    scenes: tile, scene_id, ts, cloud (null counts as 100). Scene 2 follows scene 1 by round(30 * months) whole days or more. For
    each scene 1 the least cloudy scene 2 is taken, the earliest among equals; then, on the
    first rung with a pair, the smallest cloud sum, the larger gap, the earlier scene 1. The choice of scene 2 does not
    depend on the rung, so the ladder needs no join.
    """
    s = scenes.filter(F.col("tile").isNotNull()).select("tile", "scene_id", "ts", F.coalesce("cloud", F.lit(100)).alias("cloud"))
    need = int(round(30 * months)) * 86_400_000_000
    # from the last scene to the first, the frame of a scene is a growing one: all scenes at least `need` microseconds later
    later = W.partitionBy("tile").orderBy("back").rangeBetween(W.unboundedPreceding, -need)
    back = (-F.unix_micros(F.col("ts").cast("timestamp"))).alias("back")
    best = F.min(F.struct(F.col("cloud").alias("c2"), F.col("ts").alias("t2"), F.col("scene_id").alias("s2"))).over(later)
    pairs = s.select("*", back).withColumn("best", best).filter("best is not null").select("tile", F.col("scene_id").alias("s1"), F.col("ts").alias("t1"), F.col("cloud").alias("c1"), "best.*")
    pairs = pairs.withColumn("gap_days", floor_days(F.col("t2"), F.col("t1"))).withColumn("rung", rung(F.col("c1"), F.col("c2"), ladder, inclusive)).filter("rung is not null")
    order = F.struct("rung", (F.col("c1") + F.col("c2")).alias("cloud_sum"), (-F.col("gap_days")).alias("less"), "t1", "s1", "s2")
    first = pairs.groupBy("tile").agg(F.min(order).alias("m"))
    return first.select("tile", "m.rung", "m.s1", "m.s2", "m.cloud_sum", (-F.col("m.less")).alias("gap_days"))


def first_two_pairs(scenes: DataFrame, ladder: list[tuple[float, int]]) -> DataFrame:
    """The first two pairs in scene order for each tile, on the first rung that has two or more (tile, rung, n, s1, s2).

    ladder: (cloud, months) of each rung, in the order in which they are tried. A rung admits scenes of that cloud or less; scene 2
    follows scene 1 by 30 * months whole days or more. A later scene has no partner that an earlier one lacks, so the first pair belongs to the first
    scene that a rung admits, and so does the second if it has two partners; if it has one, the second scene has to have the same.
    Minima of each tile and rung find these without pairs.
    """
    rungs = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(float(c)).alias("rung"), F.lit(30 * m).alias("need")) for i, (c, m) in enumerate(ladder)])
    at = F.struct("ts", "scene_id").alias("at")
    s = scenes.filter("tile is not null and cloud is not null").withColumn("r", F.explode(F.filter(rungs, lambda r: F.col("cloud") <= r["rung"]))).select("tile", "r", at)
    keys = ["tile", "r"]
    one = s.groupBy(*keys).agg(F.min("at").alias("e1"))
    far = lambda a, b: (F.col(b) > F.col(a)) & (F.timestamp_diff("DAY", F.col(f"{a}.ts"), F.col(f"{b}.ts")) >= F.col("r.need"))
    two = s.join(one, keys).groupBy(*keys, "e1").agg(F.min(F.when(F.col("at") > F.col("e1"), F.col("at"))).alias("e2"), F.min(F.when(far("e1", "at"), F.col("at"))).alias("p1"))
    two = two.filter("p1 is not null")
    three = s.join(two, keys).groupBy(*keys, "e1", "e2", "p1").agg(F.min(F.when(F.col("at") > F.col("p1"), F.col("at"))).alias("p2"))
    second = F.when(F.col("p2").isNotNull(), F.struct(F.col("e1").alias("a"), F.col("p2").alias("b"))).when(far("e2", "p1"), F.struct(F.col("e2").alias("a"), F.col("p1").alias("b")))
    full = three.withColumn("second", second).filter("second is not null")
    pair = lambda n, a, b: F.struct(F.lit(n).cast("bigint").alias("n"), F.col(f"{a}.scene_id").alias("s1"), F.col(f"{b}.scene_id").alias("s2"))
    low = full.groupBy("tile").agg(F.min(F.struct("r", F.array(pair(1, "e1", "p1"), pair(2, "second.a", "second.b")).alias("pairs"))).alias("m"))
    return low.select("tile", "m.r.rung", F.explode("m.pairs").alias("p")).select("tile", "rung", "p.*")


def tiers(
    scenes: DataFrame, harvest: bool, target_cloud: float = 0.01, preferred_cloud: float = 0.02, patch_cloud: float = 0.08, span: int = 2, widest: int = 5, near_days: int = 7, preferred_days: tuple[int, int] = (14, 30)
) -> DataFrame:
    """The scene for each chip by priority tiers (chip, scene_id, tier).

    scenes: chip, scene_id, ts, cloud_fraction (null: no valid pixel), doy, year. Tier 0 serves chips without a day of year: the whole year, at most patch_cloud,
    least cloud first. Tier 1: on a day within near_days of the target, which is the start of 45 days after the season's start (harvest: a month before its
    end), at most target_cloud, nearest to it in time. Tier 2: on the preferred days from the season's start (before its end), at most
    preferred_cloud, least cloud first. Tier 3: within `span` months, then one more up to `widest`, at most patch_cloud, least cloud first. Equals: by time, then scene.
    """
    day, c = F.to_date("ts"), F.col("cloud_fraction")
    at = doy_to_date(F.col("year"), F.col("doy"))
    target = F.add_months(at, -1) if harvest else F.date_add(at, 45)
    seconds = F.abs(F.unix_micros(F.col("ts").cast("timestamp_ntz").cast("timestamp")) - F.unix_micros(target.cast("timestamp_ntz").cast("timestamp")))
    soon, late = preferred_days
    lo2, hi2 = (F.date_sub(at, late), F.date_sub(at, soon)) if harvest else (F.date_add(at, soon), F.date_add(at, late))
    months = F.lit(None).cast("int")
    for m in range(widest, span - 1, -1):
        within = day.between(F.add_months(at, -m), at) if harvest else day.between(at, F.add_months(at, m))
        months = F.when(within, m).otherwise(months)
    none = F.col("doy").isNull()
    tier = (
        F.when(none, F.when((F.year(day) == F.col("year")) & (c <= patch_cloud), 0))
        .when((F.abs(F.datediff(day, target)) <= near_days) & (c <= target_cloud), 1)
        .when(day.between(lo2, hi2) & (c <= preferred_cloud), 2)
        .when(months.isNotNull() & (c <= patch_cloud), 3)
    )
    key = F.when(tier == 1, seconds).when(tier == 3, months.cast("long")).otherwise(F.lit(0).cast("long"))
    got = scenes.filter(c.isNotNull()).withColumns({"tier": tier, "_key": key}).filter("tier is not null")
    order = F.struct("tier", "_key", F.when(F.col("tier") == 1, 0.0).otherwise(c).alias("c"), "ts", "scene_id")
    return got.groupBy("chip").agg(F.min(order).alias("m")).select("chip", "m.scene_id", "m.tier")
