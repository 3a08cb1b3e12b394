"""Formatting, path and report expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from harvestry.workdir import written

_BITS = 60


def fixed(x: Column, digits: int) -> Column:
    """x with so many decimals, rounded as its binary value is (ties to even), which no decimal type of Spark does; null for null, NaN and infinity.

    The fraction is taken as a whole number of 2**-60, which is exact for doubles that are large enough to be rounded up, and what it leaves over
    after the decimals is compared with a half in whole numbers.
    """
    size, unit = F.abs(x.cast("double")), F.lit(1 << _BITS).cast("decimal(20,0)")
    parts = F.floor((size - F.floor(size)) * F.lit(float(1 << _BITS))).cast("decimal(20,0)") * F.lit(10**digits).cast("decimal(4,0)")
    rest = parts % unit
    down = ((parts - rest) / unit).cast("long")
    decimals = down + F.when(2 * rest > unit, 1).when(2 * rest == unit, down % 2).otherwise(0)
    over = (decimals >= 10**digits).cast("long")
    text = F.concat(F.when(x < 0, "-").otherwise(""), (F.floor(size) + over).cast("string"), F.lit("."), F.lpad((decimals - over * 10**digits).cast("string"), digits, "0"))
    return F.when(size < float("inf"), text)


#: Units of time (seconds in one, suffix, decimals), each used below the next one's size; units of size by powers of 1024.
TIME_UNITS = ((1, "s", 1), (60, "m", 1), (3600, "h", 2))
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB")


def format_time(seconds: Column) -> Column:
    """59.9s, 1.0m, 1.00h."""
    texts = [F.concat(fixed(seconds / size, digits), F.lit(mark)) for size, mark, digits in TIME_UNITS]
    out = texts[-1]
    for text, (below, _, _) in zip(texts[-2::-1], TIME_UNITS[:0:-1], strict=True):
        out = F.when(seconds < below, text).otherwise(out)
    return out


def format_bytes(size: Column) -> Column:
    """Two decimals with the unit by powers of 1024, up to PB."""
    powers = [float(1024**k) for k in range(len(SIZE_UNITS))]
    unit = sum(((size >= p).cast("int") for p in powers[1:]), F.lit(1))
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), unit)
    return F.concat(fixed(size / pick(powers), 2), F.lit(" "), pick(SIZE_UNITS))


#: Seconds of each stage: for each item, or for each batch.
SECONDS = {"quality_filter": 0.002, "feature_extraction": 0.5, "pca_reduction": 0.0001, "deduplication": 0.005, "diversity_selection": 0.01}


def estimate_processing_time(items: Column, batch: int = 64, seconds_per_batch: float = SECONDS["feature_extraction"]) -> dict[str, Column]:
    """Estimated seconds by stage, and their total."""
    parts = {k: F.ceil(items / F.lit(batch)) * F.lit(seconds_per_batch) if k == "feature_extraction" else items * F.lit(s) for k, s in SECONDS.items()}
    total = None
    for c in parts.values():
        total = c if total is None else total + c
    return {k: c.cast("double") for k, c in parts.items()} | {"total": total.cast("double")}


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(name: Column) -> Column:
    """The name without its last suffix; a leading dot starts no suffix."""
    return F.when(name.rlike(r"^.+\.[^.]*$"), F.regexp_extract(name, r"^(.+)\.[^.]*$", 1)).otherwise(name)


def suffix(name: Column) -> Column:
    return F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)


def collision_names(df: DataFrame, path: str = "path", order: str = "rank", out: str = "target") -> DataFrame:
    """df with a distinct file name for each path: rows in order take their basename or, if it is taken, the first free one of name_1, name_2 and so on.

    A numbered name can meet a literal one. All rows propose a name at once; of rows that propose the same one the first in order holds it, and the
    others go on to their next number together with the rows of their basename that this pushes on, until no two rows propose the same. That
    is what taking names one after the other gives, in as many rounds as numbered names meet literal ones, not rows. Rows alike in order and path have an order of their own.
    """
    name, k, place = (f"_{c}_{out}" for c in ("name", "k", "place"))
    own = df.withColumn(name, basename(F.col(path)))
    now = own.withColumn(k, F.row_number().over(Window.partitionBy(name).orderBy(order, path)) - 1).withColumn(place, F.struct(F.col(order).alias("o"), F.col(path).alias("p"), F.col(k).alias("k")))
    while True:
        named = now.withColumn(out, F.when(F.col(k) == 0, F.col(name)).otherwise(F.concat(stem(F.col(name)), F.lit("_"), F.col(k).cast("string"), suffix(F.col(name)))))
        held = named.withColumn("_lost", F.col(place) > F.min(place).over(Window.partitionBy(out)))
        held = written(held, "names")
        if held.where("_lost").isEmpty():
            return held.select(*df.columns, out)
        island = F.col(k) - F.row_number().over(Window.partitionBy(name).orderBy(place))
        first = F.min(F.when(F.col("_lost"), F.col(place))).over(Window.partitionBy(name, "_island"))
        pushed = held.withColumn("_island", island).withColumn(k, F.col(k) + F.coalesce(F.col(place) >= first, F.lit(False)).cast("int"))
        now = pushed.drop("_lost", "_island", out)


def clamp_score(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), x))


def coverage_score(mean: Column) -> Column:
    return clamp_score(100 * (1 - mean / 2))


def diversity_score(mean: Column, most: Column) -> Column:
    """Null if the largest distance is zero."""
    return clamp_score(100 * F.try_divide(mean, most))


def band(score: Column) -> Column:
    return F.when(score > 80, "Excellent").when(score > 60, "Good").when(score > 40, "Fair").otherwise("Poor")


def progress_bar(score: Column) -> Column:
    return F.rpad(F.expr("repeat('█', 20)").substr(F.lit(1), F.floor(score / 5).cast("int")), 20, " ")


#: Advice, fixed values.
ADVICE = ("Consider selecting more images to improve coverage", "Diversity seems low, try using 'fps' method", "Very aggressive selection ratio - ensure quality")
PRAISE = ("Selection quality looks good!", "Metrics are well-balanced")


def recommendations(coverage_max: Column, intra_mean: Column, ratio: Column) -> Column:
    """Advice in a fixed order; praise if there is none."""
    found = F.array_compact(F.array(F.when(coverage_max > 2.0, ADVICE[0]), F.when(intra_mean < 3.0, ADVICE[1]), F.when(ratio < 0.1, ADVICE[2])))
    return F.when(F.size(found) == 0, F.array(*(F.lit(p) for p in PRAISE))).otherwise(found)
