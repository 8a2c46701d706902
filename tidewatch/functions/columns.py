"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.tails import chi_squared_survival  # noqa: F401

_UNIFORM_DIGITS = 13  # 13 hex digits = 52 bits, exactly representable in a double
_UNIFORM_RANGE = float(16**_UNIFORM_DIGITS)
_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
PROBABILITY_FLOOR = 1e-7


def uniform(salt: str | int, *keys: Column | str) -> Column:
    """A reproducible uniform draw in [0, 1) for a row key and a salt.

    ``rand(seed)`` depends on how rows are partitioned; a digest of the key does not, so
    the same row lands on the same side of every split however the job is run.
    """
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    text = F.concat_ws("|", F.lit(str(salt)), *[p.cast("string") for p in parts])
    digits = F.substring(F.md5(text.cast("binary")), 1, _UNIFORM_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(_UNIFORM_RANGE)


def parse_number(column: Column | str) -> Column:
    """Text to double. Unparsable text and NaN give NULL; ``1d``-style suffixes do not parse."""
    column = F.col(column) if isinstance(column, str) else column
    text = column.cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def drop_nan(column: Column | str) -> Column:
    """NaN to NULL for a floating column."""
    column = F.col(column) if isinstance(column, str) else column
    return F.nanvl(column.cast("double"), F.lit(None).cast("double"))


def clip(column: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(column, F.lit(float(low))), F.lit(float(high)))


def clip_probability(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return clip(column.cast("double"), PROBABILITY_FLOOR, 1 - PROBABILITY_FLOOR)


def sigmoid(column: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-column))


def finite(column: Column) -> Column:
    """True for a value that is neither NULL, NaN nor infinite."""
    return column.isNotNull() & ~F.isnan(column) & (F.abs(column) < F.lit(float("inf")))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double, 0 where the denominator is 0."""
    ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.when(denominator == 0, F.lit(0.0)).otherwise(ratio)


def linear_interior_probabilities(bins: int) -> list[float]:
    """The ``bins - 1`` interior points of an even grid over [0, 1]."""
    step = 1.0 / bins
    return [i * step for i in range(1, bins)]


def bucket_of(edges: str, value: str, at_most: int) -> Column:
    """Number of edges that are <= value, for an array of up to ``at_most`` edges.

    Written out as a sum of comparisons: it stays in generated code, unlike a lambda, and
    is never NULL, so it can be a grouping key.
    """
    tests = [
        f"CAST(coalesce(get({edges}, {i}) <= {value}, false) AS INT)" for i in range(at_most)
    ]
    return F.expr(" + ".join(tests) if tests else "0")


def smoothed_share(count: Column, total: Column, floor: float = 1e-4) -> Column:
    """Share of a total, floored so that an empty bucket keeps the PSI finite."""
    return F.greatest(F.try_divide(count.cast("double"), total.cast("double")), F.lit(floor))


def psi_term(expected: Column, actual: Column) -> Column:
    return (actual - expected) * F.ln(actual / expected)


def kolmogorov_survival(lam: Column) -> Column:
    """Limiting two-sided Kolmogorov tail; 1 below 0.2, where the series loses all digits."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0))
        * F.exp(-2.0 * k.cast("double") * k.cast("double") * lam * lam),
    )
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(clip(series, 0.0, 1.0))


def model_uri_parts(uri: Column | str) -> Column:
    """``models:/name@alias`` or ``models:/name/3`` as a struct; NULL fields elsewhere."""
    uri = F.col(uri) if isinstance(uri, str) else uri
    alias_form = r"^models:/([^/@]+)@([^/]+)$"
    version_form = r"^models:/([^/@]+)/(\d+)$"
    by_alias, by_version = uri.rlike(alias_form), uri.rlike(version_form)
    return F.struct(
        F.when(by_alias, F.regexp_extract(uri, alias_form, 1))
        .when(by_version, F.regexp_extract(uri, version_form, 1))
        .alias("model_name"),
        F.when(by_alias, F.regexp_extract(uri, alias_form, 2)).alias("alias"),
        F.when(by_version, F.regexp_extract(uri, version_form, 2).cast("int")).alias("version"),
    )


def compact_time(ts: Column | str) -> Column:
    """A filesystem-safe UTC stamp such as ``20260101T120000Z``."""
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")


def decide_class(probability: Column, threshold: float) -> Column:
    """Class on the unrounded probability."""
    return (probability >= F.lit(float(threshold))).cast("int")


def number_of(df: DataFrame, name: str) -> Column:
    """A column of any scalar type as double: text is parsed, NaN becomes NULL."""
    kind = df.schema[name].dataType.typeName()
    if kind == "string":
        return parse_number(name)
    return drop_nan(name) if kind in ("double", "float") else F.col(name).cast("double")


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating column."""
    column = F.col(name)
    if df.schema[name].dataType.typeName() in ("double", "float"):
        return column.isNull() | F.isnan(column)
    return column.isNull()
