"""Chip manifests: fields collected per chip, deterministic splits, layout checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.expressions import path_from, split_name, stem, stem_column

from .joins import box_join


def manifest(chips: DataFrame, fields: DataFrame, side: int, salt: str, ratios: tuple[float, float, float]) -> DataFrame:
    """One row for each chip (aoi_id, split, has_fields, n_fields, parts): the fields that touch it, in field order; parts is null without any."""
    c = chips.select(F.col("chip_id").alias("aoi_id"), *[F.col(k).alias(f"l_{k}") for k in ("x0", "y0", "x1", "y1")])
    f = fields.select("field_id", *[F.col(k).alias(f"r_{k}") for k in ("x0", "y0", "x1", "y1")])
    joined = box_join(c, f, side)
    part = F.struct("field_id", F.col("r_x0").alias("x0"), F.col("r_y0").alias("y0"), F.col("r_x1").alias("x1"), F.col("r_y1").alias("y1"))
    grouped = joined.groupBy("aoi_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    out = c.select("aoi_id").join(grouped, "aoi_id", "left")
    n = F.when(F.col("parts").isNull(), 0).otherwise(F.size("parts"))
    return out.select(
        "aoi_id", split_name(F.concat(F.lit("chip_"), F.col("aoi_id").cast("string")), salt, *ratios).alias("split"), (n > 0).alias("has_fields"), n.cast("int").alias("n_fields"), F.when(n > 0, F.col("parts")).alias("parts")
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once; a valid manifest has none."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def check_manifest(df: DataFrame, key: str = "aoi_id", required: tuple[str, ...] = ("aoi_id", "split", "has_fields", "n_fields")) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"the manifest lacks {missing}")
    if not duplicate_keys(df, key).isEmpty():
        raise ValueError(f"{key} is not unique")


def restrict(df: DataFrame, allowed: DataFrame | None, key: str) -> DataFrame:
    """Rows whose key is allowed; all rows where nothing is given or the set is empty."""
    if allowed is None or allowed.isEmpty():
        return df
    return df.join(allowed.select(F.col(key).alias("_k")).distinct(), F.col(key) == F.col("_k"), "left_semi")


def only_present(df: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Rows whose key is present in a folder's listing; none where the listing is empty."""
    return df.join(present.select(F.col(key).alias("_k")).distinct(), F.col(key) == F.col("_k"), "left_semi")


def id_set(layer: DataFrame | None) -> DataFrame | None:
    """Stems (stem) of the first column that names files; None for no layer or one without such a column."""
    if layer is None:
        return None
    try:
        name = stem_column(layer)
    except ValueError:
        return None
    return layer.select(stem(F.col(name).cast("string")).alias("stem")).filter("stem <> ''").distinct()


def exact_chips(df: DataFrame, side: int = 256) -> DataFrame:
    """Chips of exactly side x side with a coordinate system."""
    return df.filter((F.col("width") == side) & (F.col("height") == side) & F.col("crs").isNotNull())


def drop_suffixed(df: DataFrame, suffixes: tuple[str, ...] = ("_left", "_right")) -> DataFrame:
    """Without the columns that a spatial join has named by side."""
    return df.drop(*[c for c in df.columns if c.endswith(suffixes)])


def drop_columns(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Without the named columns, case aside."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def tile_names(df: DataFrame, column: str = "Name") -> DataFrame:
    """Distinct names, sorted; an error without the column."""
    if column not in df.columns:
        raise ValueError(f"no column {column}")
    return df.filter(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("name")).distinct().orderBy("name")


def tiles_of(df: DataFrame, tile: str, **admin: str | list[str]) -> DataFrame:
    """Distinct tiles of the rows whose administrative names are among those given."""
    for name, values in admin.items():
        df = df.filter(F.col(name).isin([values] if isinstance(values, str) else values))
    return df.select(F.col(tile).alias("tile")).distinct()


def paired(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """Names that both folders have, each once, sorted."""
    return a.select(name).distinct().join(b.select(name).distinct(), name).orderBy(name)


def selected(df: DataFrame, have: DataFrame, key: str) -> DataFrame:
    """Rows with whether their file is there (found)."""
    there = have.select(F.col(key).alias("_k")).distinct()
    return df.join(there, F.col(key) == F.col("_k"), "left").withColumn("found", F.col("_k").isNotNull()).drop("_k")


def by_year(df: DataFrame, first: int, last: int, template: str, *parts: str) -> DataFrame:
    """A row for each year, and a path by a printf template of parts and year."""
    every = df.withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))
    return every.withColumn("path", path_from(template, *[F.col(p) for p in parts], F.col("year")))


def complete(df: DataFrame, files: list[DataFrame], key: str) -> DataFrame:
    """Rows whose key each listing has."""
    for f in files:
        df = only_present(df, f, key)
    return df


def first_rows(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key by order; combined before the shuffle."""
    row = F.min_by(F.struct(*df.columns), F.struct(*order)).alias("m")
    return df.groupBy(F.col(key).alias("_k")).agg(row).select("m.*")


def pack_samples(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Samples of two windows (key, bands) as one image: the second window's bands first."""
    late = b.select(F.col(key).alias("_k"), F.col("bands").alias("_b"))
    return a.join(late, F.col(key) == F.col("_k")).withColumn("image", F.concat("_b", "bands")).drop("_k", "_b", "bands")


def stage_samples(samples: DataFrame, stage: str, key: str, seed: int = 0) -> DataFrame:
    """The samples of a stage in the order in which it sees them: fit takes the train split by a seeded hash, validate and test theirs by key."""
    split = {"fit": "train", "validate": "val", "test": "test"}[stage]
    rows = samples.filter(F.col("split") == split)
    return rows.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key) if stage == "fit" else rows.orderBy(key)


def usable_samples(samples: DataFrame, bad: DataFrame, files: list[DataFrame], split: str) -> DataFrame:
    """Samples of a split that are not listed as bad (country, idx) and have a row in each table of files (country, idx)."""
    out = samples.filter(F.col("split") == split).join(bad, ["country", "idx"], "left_anti")
    for f in files:
        out = out.join(f, ["country", "idx"], "left_semi")
    return out


def missing(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of df without an output yet."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def single_manifest_countries(files: DataFrame) -> DataFrame:
    """Folders (country, name) that hold exactly one chips_*.parquet, sorted."""
    return files.filter(F.col("name").rlike(r"^chips_.*\.parquet$")).groupBy("country").agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select("country").orderBy("country")


def preferred_file(files: DataFrame, word: str) -> DataFrame:
    """One file for each folder: a name with the word, else one with `field`, else the first by name."""
    priority = F.when(F.contains(F.lower("name"), F.lit(word.lower())), 0).when(F.contains(F.lower("name"), F.lit("field")), 1).otherwise(2)
    return files.groupBy("country").agg(F.min(F.struct(priority.alias("p"), F.col("name"))).alias("m")).select("country", "m.name")
