"""Scalar column expressions: names, ids, splits, dates, numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID_COLUMNS = ("chip_id", "chipid", "cell_id", "cellid")
STEM_COLUMNS = ("filename", "chip_id", "id", "name", "tile_id", "grid_id", "stem")


def chip_name(value: Column) -> Column:
    """A name that begins with a letter stays; otherwise its digits make chip_<digits>, chip_0 without any; empty or null is chip_unknown."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    digits = F.regexp_replace(text, "[^0-9]", "")
    return (
        F.when(text == "", "chip_unknown")
        .when(text.rlike(r"^\p{L}"), text)
        .otherwise(F.concat(F.lit("chip_"), F.when(digits == "", "0").otherwise(digits)))
    )


def resolve_id_column(columns: list[str], asked: str | None = None) -> str | None:
    """The id column among columns, case aside: the one asked for, else the first known name, else none."""
    lower = {}
    for c in columns:
        lower.setdefault(c.lower(), c)
    for name in ([asked.lower()] if asked else []) + list(ID_COLUMNS):
        if name in lower:
            return lower[name]
    return None


def first_name(chip: Column, fallback: Column, stem: Column, idx: Column) -> Column:
    """The first of the two names that is not blank, else <stem>_<idx>."""

    def given(c: Column) -> Column:
        return F.nullif(F.trim(c.cast("string")), F.lit(""))

    return F.coalesce(given(chip), given(fallback), F.concat(stem, F.lit("_"), idx.cast("string")))


def stem(path: Column) -> Column:
    """Last part of a path in either slash, without .tif or .tiff."""
    last = F.element_at(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), -1)
    return F.regexp_replace(last, r"(?i)\.tiff?$", "")


def stem_column(df: DataFrame) -> str:
    """The column that names files: a known name, else any text column that holds `.tif` somewhere."""
    lower = {c.lower(): c for c in reversed(df.columns)}
    for name in STEM_COLUMNS:
        if name in lower:
            return lower[name]
    texts = [n for n, kind in df.dtypes if kind == "string"]
    if texts:
        held = df.agg(*[F.max(F.lower(F.col(c)).contains(".tif")).alias(c) for c in texts]).first()
        for c in texts:
            if held[c]:
                return c
    raise ValueError(f"no column names files among {df.columns}")


def split_fraction(key: Column, salt: str) -> Column:
    """A number in [0, 1) from the salted key, the same wherever it is computed."""
    head = F.substring(F.sha1(F.concat(F.lit(f"{salt}::"), key.cast("string"))), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") / F.lit(4294967296.0)


def split_name(key: Column, salt: str, train: float, val: float, test: float) -> Column:
    if abs(train + val + test - 1) > 1e-9:
        raise ValueError("the three ratios must sum to 1")
    at = split_fraction(key, salt)
    return F.when(at < train, "train").when(at < train + val, "val").otherwise("test")


def doy_to_date(year: Column, doy: Column) -> Column:
    """Day of year, held to 1..366, as a date; 366 of a common year is 1 January."""
    day = F.least(F.lit(366), F.greatest(F.lit(1), doy)).cast("int")
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day - 1)


def season_window(sos: Column, eos: Column, year: Column, buffer_days: int) -> Column:
    """Struct (start, end, known): the season with a buffer, cut to its year; the full year where a date is missing or the order is wrong."""
    first, last = F.make_date(year, F.lit(1), F.lit(1)), F.make_date(year, F.lit(12), F.lit(31))
    start = F.greatest(first, F.date_sub(sos, buffer_days))
    end = F.least(last, F.date_add(eos, buffer_days))
    known = sos.isNotNull() & eos.isNotNull() & (start < end)
    return F.struct(F.when(known, start).otherwise(first).alias("start"), F.when(known, end).otherwise(last).alias("end"), known.alias("known"))


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days between two moments, rounded down (not calendar days)."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.floor(micros / F.lit(86_400_000_000)).cast("bigint")


def utm_epsg(lon: Column, lat: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1 + F.when(lat >= 0, 32600).otherwise(32700)).cast("int")


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, 100.0 * part / whole).otherwise(0.0)


def human_bytes(n: Column) -> Column:
    # halves go to the even digit, as they do in C and Python; Java's format sends them up
    shown = lambda power, unit: F.format_string(f"%.2f {unit}", F.bround(n / F.lit(1024.0**power), 2))
    out = shown(4, "TB")
    for power, unit in ((3, "GB"), (2, "MB"), (1, "KB"), (0, "B")):
        out = F.when(n < 1024 ** (power + 1), shown(power, unit)).otherwise(out)
    return out


#: Extensions that stand for another, fixed values.
SAME_EXTENSION = {".tiff": ".tif", ".jpeg": ".jpg", ".htm": ".html", ".yml": ".yaml"}


def extension(path: Column) -> Column:
    """Lower-case extension with its dot, synonyms as one."""
    ext = F.lower(F.regexp_extract(path, r"(\.[A-Za-z0-9]+)$", 1))
    out = F.when(ext == "", "[no extension]").otherwise(ext)
    for a, b in SAME_EXTENSION.items():
        out = F.when(ext == a, b).otherwise(out)
    return out


def uint16_action(kind: Column, low: Column, high: Column, documented: bool = False, target: tuple[int, int] = (0, 65535)) -> Column:
    """What turns a band into uint16 within the target range: skip, cast, scale or clip.

    By default the test for a range that fits comes before the one for reflectance, so bands in [0, 1] are cast (and
    truncated); documented=True asks for reflectance first. A uint16 band outside the target is clipped.
    """
    fits = (low >= target[0]) & (high <= target[1])
    unit = kind.isin("float16", "float32", "float64") & (low >= -1e-6) & (high <= 1.0000001)
    held = F.when(kind == "uint16", "skip").otherwise("cast")
    if documented:
        return F.when(unit, "scale").when(fits, held).otherwise("clip")
    return F.when(fits, held).when(unit, "scale").otherwise("clip")


def common_kind(a: Column, b: Column) -> Column:
    """The narrowest numeric kind that holds both: (u)int8 to (u)int64 and float16 to float64; null for another kind.

    Of a signed and an unsigned kind, the signed one if it is wider, else the next wider signed one (float64 beyond int64); floats hold
    integers of at most half their width, at most 32 bits in float64 exactly and 64 bits by convention.
    """
    form = r"^(u?int|float)(8|16|32|64)$"
    family, bits = (lambda k: F.regexp_extract(k, form, 1)), (lambda k: F.try_to_number(F.regexp_extract(k, form, 2), F.lit("99")).cast("int"))
    fa, fb, na, nb = family(a), family(b), bits(a), bits(b)
    wide = F.greatest(na, nb)
    name = lambda kind, n: F.concat(F.lit(kind), n.cast("string"))
    # signed and unsigned
    u, s = F.when(fa == "uint", na).otherwise(nb), F.when(fa == "uint", nb).otherwise(na)
    mixed = F.when(s > u, name("int", s)).when(u == 64, "float64").otherwise(name("int", u * 2))
    # a float and an integer
    f, i = F.when(fa == "float", na).otherwise(nb), F.when(fa == "float", nb).otherwise(na)
    real = name("float", F.greatest(f, F.when(i == 8, 16).when(i == 16, 32).otherwise(64)))
    known = a.rlike(form) & b.rlike(form) & (a != "float8") & (b != "float8")
    return F.when(known, F.when(fa == fb, F.concat(fa, wide.cast("string"))).when((fa == "float") | (fb == "float"), real).otherwise(mixed))


def year_of(df: DataFrame, column: str | None, constant: int | None) -> Column:
    """The row's year: its column if there is one, else the constant, else an error in that row."""
    given = F.col(column).cast("int") if column and column in df.columns else F.lit(None).cast("int")
    if constant is not None:
        return F.coalesce(given, F.lit(constant))
    return F.coalesce(given, F.raise_error(F.lit("no year for this row")).cast("int"))


def is_geographic(crs: str, unit: str | None = None) -> bool:
    """Whether a coordinate system is in degrees, by its code or else by the unit of its axes."""
    known = {"EPSG:4326": True, "EPSG:4674": True, "EPSG:4258": True, "OGC:CRS84": True, "EPSG:3857": False, "EPSG:5880": False}
    name = crs.upper()
    if name in known:
        return known[name]
    if name.startswith(("EPSG:326", "EPSG:327")):
        return False
    return (unit or "").lower().startswith("deg")


def prefix_tags(tags: Column, prefix: str) -> Column:
    return F.transform_keys(tags, lambda k, _: F.concat(F.lit(prefix), k))


def date_name(prefix: str, at: Column) -> Column:
    """<prefix><yyyymmdd>."""
    return F.concat(F.lit(prefix), F.date_format(at, "yyyyMMdd"))


def path_from(template: str, *parts: Column) -> Column:
    """A path by a printf template, the same for every row."""
    return F.format_string(template, *parts)


def pair_reason(a: dict[str, Column], b: dict[str, Column], bands: int = 4) -> Column:
    """Why two rasters (bands, crs, transform, width, height) make no pair, by the first test that fails; empty if they do. Unknown equals unknown."""
    differ = lambda k: ~a[k].eqNullSafe(b[k])
    # messages, fixed values
    few = lambda w, c: F.format_string(f"Window {w} has %d bands (expected {bands}).", c)
    return (
        F.when(a["bands"] != bands, few("A", a["bands"])).when(b["bands"] != bands, few("B", b["bands"])).when(differ("crs"), "CRS mismatch.")
        .when(differ("transform"), "Affine transform mismatch.").when(differ("width") | differ("height"), "Raster dimension mismatch.").otherwise("")
    )


def rounded(value: Column, digits: int) -> Column:
    """F.round of a double, number for number. Off the halves a whole number divided tells it; near them, and far from 0, F.round itself, which goes by way of decimals."""
    raised = value * 10.0**digits + 0.5
    # below 10^10 it is off by less than 0.000005
    clear = (F.abs(raised) < 1e10) & (raised - F.floor(raised)).between(1e-5, 1 - 1e-5)
    return F.when(clear, F.floor(raised) / 10.0**digits).otherwise(F.round(value, digits))
