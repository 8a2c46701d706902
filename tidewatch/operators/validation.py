"""Data-contract checks: every per-column check of a table in one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.contract import CHURN, Contract, Field
from tidewatch.functions.columns import is_missing, number_of

ISSUE_COLUMNS = ["column", "check_name", "severity", "n", "message"]
MAX_EXAMPLES = 5


class ContractViolation(ValueError):
    """A table breaks its contract; carries the blocking issues."""

    def __init__(self, errors: list) -> None:
        self.errors = errors
        listed = "; ".join(f"[{e['column']}] {e['message']}" for e in errors)
        super().__init__(f"{len(errors)} contract violation(s): {listed}")


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")


def _issue(column: str, check: str, n: Column, message: Column, when: Column) -> Column:
    """A one-or-NULL struct; NULLs are dropped when the array of checks is unfolded."""
    return F.when(
        when,
        F.struct(
            F.lit(column).alias("column"),
            F.lit(check).alias("check_name"),
            F.lit("error").alias("severity"),
            n.cast("long").alias("n"),
            message.alias("message"),
        ),
    )


def _tallies(df: DataFrame, field: Field) -> list[Column]:
    missing = is_missing(df, field.name)
    cells = [_count(missing).alias(f"{field.name}__missing")]
    if field.role == "categorical":
        return cells
    number = number_of(df, field.name)
    cells.append(_count(~missing & number.isNull()).alias(f"{field.name}__unparsable"))
    if field.role == "binary":
        outside = number.isNotNull() & ~number.isin(0.0, 1.0)
    else:
        outside = F.lit(False)
        if field.lower is not None:
            outside = outside | (number < F.lit(float(field.lower)))
        if field.upper is not None:
            outside = outside | (number > F.lit(float(field.upper)))
    cells.append(_count(outside).alias(f"{field.name}__outside"))
    return cells


def _field_issues(field: Field, max_missing: float) -> list[Column]:
    n = F.col("n_rows")
    missing = F.col(f"{field.name}__missing")
    share = F.try_divide(missing, n)
    percent = F.format_string("%.1f%%", 100.0 * share)
    if field.optional:
        issues = [
            _issue(
                field.name,
                "missing_fraction",
                missing,
                F.concat(percent, F.lit(f" missing, budget is {max_missing:.0%}")),
                share > F.lit(max_missing),
            )
        ]
    else:
        issues = [
            _issue(
                field.name,
                "not_null",
                missing,
                F.concat(percent, F.lit(" missing, none allowed")),
                missing > 0,
            )
        ]
    if field.role == "categorical":
        return issues
    unparsable, outside = F.col(f"{field.name}__unparsable"), F.col(f"{field.name}__outside")
    check, rule = (
        ("binary", "not in {0, 1}")
        if field.role == "binary"
        else ("range", f"outside [{field.lower}, {field.upper}]")
    )
    return issues + [
        _issue(
            field.name,
            "dtype",
            unparsable,
            F.format_string("%d value(s) are not numbers", unparsable),
            unparsable > 0,
        ),
        _issue(
            field.name, check, outside, F.format_string(f"%d value(s) {rule}", outside), outside > 0
        ),
    ]


def _target_tallies(df: DataFrame, target: str) -> list[Column]:
    number, missing = number_of(df, target), is_missing(df, target)
    return [
        _count(missing).alias("t_missing"),
        _count(~missing & (number.isNull() | ~number.isin(0.0, 1.0))).alias("t_outside"),
        _count(number == 0.0).alias("t_zeros"),
        _count(number == 1.0).alias("t_ones"),
    ]


def _target_issues(target: str) -> list[Column]:
    missing, outside = F.col("t_missing"), F.col("t_outside")
    single = (F.col("t_zeros") == 0) | (F.col("t_ones") == 0)
    return [
        _issue(target, "not_null", missing, F.format_string("%d label(s) missing", missing), missing > 0),
        _issue(
            target,
            "binary",
            outside,
            F.format_string("%d label(s) not in {0, 1}", outside),
            outside > 0,
        ),
        _issue(
            target,
            "class_balance",
            F.col("n_rows"),
            F.lit("labels hold a single class"),
            (outside == 0) & single,
        ),
    ]


def _unfold(row: DataFrame, issues: list[Column]) -> DataFrame:
    kept = F.filter(F.array(*issues), lambda i: i.isNotNull())
    return row.select(F.inline(kept))


def unknown_categories(df: DataFrame, contract: Contract = CHURN) -> DataFrame:
    """One issue per categorical column with values outside its domain.

    The distinct unknown values are counted with partial aggregation, and the five
    smallest are found by a group limit that each task applies before the shuffle, so the
    set of unknown values is never gathered in one place.
    """
    fields = [f for f in contract.fields if f.role == "categorical" and f.name in df.columns]
    pairs = df.select(
        F.explode(
            F.array(
                *[
                    F.when(
                        F.col(f.name).isNotNull() & ~F.col(f.name).cast("string").isin(*f.domain),
                        F.struct(
                            F.lit(f.name).alias("column"),
                            F.col(f.name).cast("string").alias("value"),
                        ),
                    )
                    for f in fields
                ]
            )
        ).alias("p")
    ).where("p IS NOT NULL")
    distinct = pairs.select("p.*").distinct()
    counts = distinct.groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(W.partitionBy("column").orderBy("value"))
    examples = (
        distinct.withColumn("_r", rank)
        .where(F.col("_r") <= MAX_EXAMPLES)
        .groupBy("column")
        .agg(F.array_sort(F.collect_list("value")).alias("examples"))
    )
    return counts.join(examples, "column").select(
        "column",
        F.lit("categories").alias("check_name"),
        F.lit("error").alias("severity"),
        "n",
        F.concat(F.lit("unknown: "), F.concat_ws(", ", "examples")).alias("message"),
    )


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    """A warning counting rows beyond the first of each id; missing ids count as one id."""
    repeats = df.groupBy(key).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return (
        repeats.agg(F.coalesce(F.sum("extra"), F.lit(0)).cast("long").alias("n"))
        .where("n > 0")
        .select(
            F.lit(key).alias("column"),
            F.lit("unique").alias("check_name"),
            F.lit("warning").alias("severity"),
            "n",
            F.format_string("%d duplicated id(s)", "n").alias("message"),
        )
    )


def check_features(
    df: DataFrame,
    contract: Contract = CHURN,
    min_rows: int = 1,
    max_missing: float = 0.2,
) -> DataFrame:
    """Row count, nulls, types, ranges, binary values and category domains."""
    present = [f for f in contract.fields if f.name in df.columns]
    absent = [f for f in contract.fields if f.name not in df.columns]
    row = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[cell for f in present for cell in _tallies(df, f)],
    )
    n = F.col("n_rows")
    issues = [
        _issue("*", "min_rows", n, F.format_string(f"%d rows, {min_rows} required", n), n < min_rows)
    ]
    issues += [
        _issue(f.name, "required_column", F.lit(1), F.lit("column is absent"), F.lit(True))
        for f in absent
    ]
    issues += [i for f in present for i in _field_issues(f, max_missing)]
    found = _unfold(row, issues)
    if any(f.role == "categorical" for f in present):
        found = found.unionByName(unknown_categories(df, contract))
    return found


def check_target(df: DataFrame, contract: Contract = CHURN) -> DataFrame:
    """Label checks and duplicate ids."""
    if contract.target in df.columns:
        row = df.agg(F.count(F.lit(1)).alias("n_rows"), *_target_tallies(df, contract.target))
        found = _unfold(row, _target_issues(contract.target))
    else:
        absent = _issue(
            contract.target, "required_column", F.lit(1), F.lit("column is absent"), F.lit(True)
        )
        found = _unfold(df.agg(F.count(F.lit(1)).alias("n_rows")), [absent])
    if contract.key in df.columns:
        found = found.unionByName(duplicate_ids(df, contract.key))
    return found


def validate(
    df: DataFrame,
    contract: Contract = CHURN,
    require_target: bool = True,
    min_rows: int = 1,
    max_missing: float = 0.2,
) -> DataFrame:
    """All issues of a table: (column, check_name, severity, n, message)."""
    issues = check_features(df, contract, min_rows, max_missing)
    if require_target:
        return issues.unionByName(check_target(df, contract))
    if contract.key in df.columns:
        issues = issues.unionByName(duplicate_ids(df, contract.key))
    return issues


def summarize_issues(issues: DataFrame) -> DataFrame:
    """(passed, n_errors, n_warnings)."""
    errors = F.count_if(F.col("severity") == "error")
    return issues.agg(
        (errors == 0).alias("passed"),
        errors.alias("n_errors"),
        F.count_if(F.col("severity") == "warning").alias("n_warnings"),
    )


def assert_valid(df: DataFrame, **options) -> list:
    """Run the checks; raise on blocking issues, else return the warnings.

    At most a few issues per contract column come back, whatever the table's size.
    """
    found = validate(df, **options).collect()
    errors = [i for i in found if i["severity"] == "error"]
    if errors:
        raise ContractViolation(errors)
    return [i for i in found if i["severity"] == "warning"]


def coerce_types(df: DataFrame, contract: Contract = CHURN) -> DataFrame:
    """Numeric and binary features to double (bad values NULL), categoricals to string."""
    replaced = {}
    for field in contract.fields:
        if field.name in df.columns:
            replaced[field.name] = (
                F.col(field.name).cast("string")
                if field.role == "categorical"
                else number_of(df, field.name)
            )
    return df.select(*[replaced[c].alias(c) if c in replaced else F.col(c) for c in df.columns])


def row_violations(df: DataFrame, contract: Contract = CHURN) -> Column:
    """Array of ``field:rule`` for one row; evaluated in the scan, no shuffle."""
    rules = []
    for field in contract.fields:
        if field.name not in df.columns:
            if not field.optional:
                rules.append(F.lit(f"{field.name}:missing"))
            continue
        missing = is_missing(df, field.name)
        if not field.optional:
            rules.append(F.when(missing, F.lit(f"{field.name}:missing")))
        if field.role == "categorical":
            known = F.col(field.name).cast("string").isin(*field.domain)
            rules.append(F.when(~missing & ~known, F.lit(f"{field.name}:category")))
            continue
        number = number_of(df, field.name)
        rules.append(F.when(~missing & number.isNull(), F.lit(f"{field.name}:type")))
        if field.role == "binary":
            rules.append(F.when(~number.isin(0.0, 1.0), F.lit(f"{field.name}:binary")))
            continue
        if field.whole:
            rules.append(F.when(number != F.floor(number), F.lit(f"{field.name}:integer")))
        low, high = F.lit(float(field.lower)), F.lit(float(field.upper))
        rules.append(F.when((number < low) | (number > high), F.lit(f"{field.name}:range")))
    return F.array_compact(F.array(*rules))


def quarantine(df: DataFrame, contract: Contract = CHURN, forbid_extra: bool = False) -> DataFrame:
    """Add ``violations`` and ``accepted``; unknown columns can be rejected as well."""
    violations = row_violations(df, contract)
    known = {contract.key, contract.target, *contract.features}
    extra = sorted(c for c in df.columns if c not in known) if forbid_extra else []
    if extra:
        violations = F.concat(violations, F.array(*[F.lit(f"{c}:unknown") for c in extra]))
    return df.withColumn("violations", violations).withColumn(
        "accepted", F.size("violations") == 0
    )


def split_quarantined(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows in their original shape, and rejected rows with their violations."""
    accepted = checked.where("accepted").drop("violations", "accepted")
    return accepted, checked.where("NOT accepted").drop("accepted")
