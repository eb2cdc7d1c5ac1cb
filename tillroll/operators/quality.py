"""Data-quality reports and repairs: duplicates, nulls, keys, ranges, outliers, formulas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.numbers import count, ratio, real
from tillroll.model import FOREIGN_KEYS, PRIMARY_KEYS, REVIEW_SCORES, SCHEMAS
from tillroll.operators import ranking
from tillroll.operators.settle import settled, shuffles_removed
from tillroll.sources.files import whole_number
from tillroll.sources.tables import Tables

# Columns that may be empty, are checked for outliers, are trimmed.
MAY_BE_NULL = ("Ship_Date", "Shipping_Mode", "Carrier", "Delivery_Days", "Review_Score")
OUTLIER_COLUMNS = ("Sales", "Profit", "Unit_Price")
TRIMMED = ("Category", "Sub_Category", "Brand", "State", "City", "Payment_Method")


def _stacked(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def count_per_column(df: DataFrame, counts: Mapping[str, Column], name: str, out: str) -> DataFrame:
    """All counts in one pass, then one row per column."""
    wide = df.agg(*[c.cast("bigint").alias(f"_{i}") for i, c in enumerate(counts.values())])
    pairs = [
        F.struct(F.lit(column).alias(name), F.col(f"_{i}").alias(out))
        for i, column in enumerate(counts)
    ]
    return wide.select(F.inline(F.array(*pairs)))


# -- duplicates ------------------------------------------------------------------------------


def duplicate_report(df: DataFrame, key: str | Sequence[str], table: str) -> DataFrame:
    """How many rows repeat the key of another row; missing keys count as equal."""
    keys = [key] if isinstance(key, str) else list(key)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return sizes.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicate_rows"),
    ).select(
        F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("key_columns"),
        "row_count",
        "duplicate_rows",
    )


def first_per_key(
    df: DataFrame, key: str | Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the first by ``order_by``, then by the remaining columns.

    This is a minimum over whole rows: each task keeps one row per key before the shuffle, so a key
    with very many copies arrives as one row per task. Spark sorts the rows of a task for it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    first = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in first]
    row = F.struct(*first, *rest)
    return df.groupBy(*keys).agg(F.min(row).alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def without_duplicates(
    df: DataFrame, key: str, order_by: Sequence[str] = ()
) -> tuple[DataFrame, int]:
    """The frame without repeated keys, and how many rows went.

    The count reads only the key. Rows whose key occurs once pass by; only those of repeated keys, if
    there are any, are grouped.
    """
    with shuffles_removed(df.sparkSession):
        dropped = duplicate_report(df, key, "").first()["duplicate_rows"]
    if not dropped:
        return df, 0
    repeated = settled(
        df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_key")
    )
    same = F.col(key).eqNullSafe(F.col("_key"))
    once = df.join(repeated, same, "left_anti")
    return once.unionByName(first_per_key(df.join(repeated, same, "left_semi"), key, order_by)), dropped


# -- types and text --------------------------------------------------------------------------


def to_dates(
    df: DataFrame, columns: Sequence[str], formats: Sequence[str] = ()
) -> DataFrame:
    """Dates: ISO, or the first of ``formats`` that fits; whatever is not a date becomes NULL."""

    def day(c: str) -> Column:
        if df.schema[c].dataType == T.DateType():
            return F.col(c)
        plain = F.col(c).try_cast("date")
        text = F.trim(F.col(c).cast("string"))
        return F.coalesce(plain, *[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats])

    return df.withColumns({c: day(c) for c in columns if c in df.columns})


def lost_values(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many present values of each column a coercion turned into NULL (empty text is missing)."""
    present = {c: F.count_if(F.trim(F.col(c).cast("string")) != "") for c in columns}
    was = count_per_column(before, present, "column_name", "_before")
    now = count_per_column(after, present, "column_name", "_after")
    return was.join(now, "column_name").select(
        "column_name", (F.col("_before") - F.col("_after")).alias("lost")
    )


def to_numbers(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Numbers of the given types; whatever is not such a number becomes NULL, a fraction too where
    a whole number is asked for ("3.0" is whole)."""

    def number(c: str, kind: str) -> Column:
        if kind in ("int", "bigint") and df.schema[c].dataType == T.StringType():
            return whole_number(F.trim(F.col(c)), kind)
        return F.col(c).try_cast(kind)

    return df.withColumns({c: number(c, kind) for c, kind in types.items()})


def trimmed(df: DataFrame, columns: Sequence[str] = TRIMMED) -> DataFrame:
    """Text without surrounding blanks; a missing value stays NULL and letters keep their case."""
    return df.withColumns({c: F.trim(F.col(c).cast("string")) for c in columns})


# -- nulls -----------------------------------------------------------------------------------


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    counts = {c: F.count_if(F.col(c).isNull()) for c in (columns or df.columns)}
    return count_per_column(df, counts, "column_name", "null_count")


def null_report(df: DataFrame) -> DataFrame:
    """Columns with missing values, most first."""
    return null_counts(df).filter("null_count > 0").orderBy(F.desc("null_count"), "column_name")


def unexpected_nulls(df: DataFrame, allowed: Sequence[str] = MAY_BE_NULL) -> DataFrame:
    """Columns with missing values although they must have one."""
    return null_counts(df, [c for c in df.columns if c not in allowed]).filter("null_count > 0")


# -- outliers --------------------------------------------------------------------------------


def outlier_bounds(
    df: DataFrame,
    columns: Sequence[str] = OUTLIER_COLUMNS,
    exact: bool = True,
    accuracy: int = 10_000,
) -> dict[str, tuple[float, float]]:
    """Interval outside which a value is an outlier: 1.5 quartile ranges beyond the quartiles."""
    if exact:
        quartiles = ranking.quantiles(df, columns, [0.25, 0.75])
    else:
        row = df.agg(
            *[F.percentile_approx(real(c), [0.25, 0.75], accuracy).alias(c) for c in columns]
        ).first()
        quartiles = {c: list(row[c] or [None, None]) for c in columns}
    bounds = {}
    for c, (q1, q3) in quartiles.items():
        if q1 is not None:
            bounds[c] = (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    return bounds


def is_outlier(column: str, bounds: Mapping[str, tuple[float, float]]) -> Column:
    if column not in bounds:
        return F.lit(False)
    low, high = bounds[column]
    value = real(column)
    return F.coalesce((value < F.lit(low)) | (value > F.lit(high)), F.lit(False))


def outlier_flags(
    df: DataFrame, columns: Sequence[str] = OUTLIER_COLUMNS, exact: bool = True
) -> DataFrame:
    """One ``<column>_Outlier`` flag each; no row is dropped."""
    bounds = outlier_bounds(df, columns, exact)
    return df.withColumns({f"{c}_Outlier": is_outlier(c, bounds) for c in columns})


def outlier_report(flagged: DataFrame, columns: Sequence[str] = OUTLIER_COLUMNS) -> DataFrame:
    """Count and share of the flagged rows per column."""
    counts = {c: F.count_if(F.col(f"{c}_Outlier")) for c in columns}
    counts["_all"] = F.count(F.lit(1))
    wide = flagged.agg(*[v.alias(k) for k, v in counts.items()])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(c).alias("outliers"),
            F.round(ratio(c, "_all"), 6).alias("outlier_share"),
        )
        for c in columns
    ]
    return wide.select(F.inline(F.array(*rows)))


# -- rules -----------------------------------------------------------------------------------


def integrity_violations(df: DataFrame) -> DataFrame:
    """Violations per rule; a missing amount breaks its rule as well."""

    def broken(rule: Column) -> Column:
        return F.count_if(~F.coalesce(rule, F.lit(False)))

    counts = {
        "Sales >= 0": broken(F.col("Sales") >= 0),
        "Quantity > 0": broken(F.col("Quantity") > 0),
        "Order_ID present": broken(F.col("Order_ID").isNotNull()),
        "Customer_ID present": broken(F.col("Customer_ID").isNotNull()),
    }
    return count_per_column(df, counts, "rule", "violations")


def require_integrity(df: DataFrame) -> DataFrame:
    """The frame itself, or an error that names the broken rules."""
    broken = {r["rule"]: r["violations"] for r in integrity_violations(df).collect()}
    broken = {rule: n for rule, n in broken.items() if n}
    if broken:
        raise ValueError(f"integrity rules broken: {broken}")
    return df


def primary_key_report(t: Tables) -> DataFrame:
    """Per table: keys that occur more than once, and rows without a key."""
    reports = []
    for table in t:
        key = PRIMARY_KEYS[table]
        sizes = t[table].groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        missing = F.col(key).isNull()
        reports.append(
            sizes.agg(
                F.count_if(~missing & (F.col("_rows") > 1)).alias("duplicate_keys"),
                F.coalesce(F.sum(F.when(missing, F.col("_rows"))), F.lit(0)).alias("null_keys"),
            ).select(
                F.lit(table).alias("table_name"),
                F.lit(key).alias("key_column"),
                "duplicate_keys",
                "null_keys",
            )
        )
    return _stacked(reports)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Keys of ``child`` that ``parent`` lacks, with their row counts; NULL refers to nothing."""
    used = child.filter(F.col(key).isNotNull()).groupBy(key).agg(count().alias("row_count"))
    return used.join(parent.select(key).distinct(), key, "left_anti")


def foreign_key_report(t: Tables) -> DataFrame:
    """Per reference: how many rows and how many different keys point to nothing."""
    reports = [
        orphans(t[child], t[parent], key)
        .agg(
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_rows"),
            count().alias("orphan_keys"),
        )
        .select(
            F.lit(child).alias("child_table"),
            F.lit(parent).alias("parent_table"),
            F.lit(key).alias("key_column"),
            "orphan_rows",
            "orphan_keys",
        )
        for child, parent, key in FOREIGN_KEYS
    ]
    return _stacked(reports)


def out_of_range(
    df: DataFrame, column: str = "Review_Score", low=REVIEW_SCORES[0], high=REVIEW_SCORES[1]
) -> DataFrame:
    """Rows whose value lies outside [low, high]; a missing value passes."""
    return df.filter(~F.col(column).between(low, high))


def required_report(t: Tables) -> DataFrame:
    """Per declared NOT NULL column: how many values are missing."""
    reports = []
    for table in t:
        required = [f.name for f in SCHEMAS[table] if not f.nullable]
        reports.append(
            null_counts(t[table], required).select(
                F.lit(table).alias("table_name"), "column_name", "null_count"
            )
        )
    return _stacked(reports)


def length_report(t: Tables) -> DataFrame:
    """Per declared text column: how many values are longer than declared."""
    reports = []
    for table in t:
        counts = {
            f.name: F.count_if(F.char_length(f.name) > f.metadata["max_length"])
            for f in SCHEMAS[table]
            if isinstance(f.dataType, T.StringType)
        }
        reports.append(
            count_per_column(t[table], counts, "column_name", "too_long").select(
                F.lit(table).alias("table_name"), "column_name", "too_long"
            )
        )
    return _stacked(reports)


def formula_violations(items: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Lines whose Sales differ from Quantity * Unit_Price * (1 - Discount) by more."""
    expected = F.col("Quantity") * F.col("Unit_Price") * (F.lit(1) - F.col("Discount"))
    difference = F.col("Sales") - expected
    return items.filter(F.abs(difference) > F.lit(str(tolerance)).cast("decimal(10,6)")).select(
        "Order_Item_ID",
        "Sales",
        expected.cast("decimal(18,4)").alias("Expected_Sales"),
        difference.cast("decimal(18,4)").alias("Difference"),
    )


def table_shapes(t: Tables) -> DataFrame:
    """Rows and columns per table."""
    return _stacked(
        [
            t[name]
            .agg(count().alias("row_count"))
            .select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(len(t[name].columns)).alias("column_count"),
            )
            for name in t
        ]
    )


def row_count_check(t: Tables, expected: Mapping[str, int]) -> DataFrame:
    """Rows per table against the expected number."""
    reports = [
        t[name]
        .agg(count().alias("actual_rows"))
        .select(
            F.lit(name).alias("table_name"),
            "actual_rows",
            F.lit(rows).cast("bigint").alias("expected_rows"),
            (F.col("actual_rows") == rows).alias("as_expected"),
        )
        for name, rows in expected.items()
    ]
    return _stacked(reports)


SKETCH_SIZE = 400  # of a KLL sketch: ranks are off by less than a hundredth, whatever the number of rows


def value_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """A KLL sketch of each column, per group: column_name, the group's columns and sketch.

    Sketches of parts (days, files, categories) can be stored and later merged; none grows with its rows.
    """
    names = list(columns)
    sketches = df.groupBy(*by).agg(*[F.kll_sketch_agg_double(real(c), F.lit(SKETCH_SIZE)).alias(c) for c in names])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("sketch")) for c in names]
    return sketches.select(*by, F.inline(F.array(*pairs)))


def sketched_quantiles(sketches: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Approximate quantiles of all rows behind the sketches: column_name, probability, value."""
    some = sketches.filter(F.kll_sketch_get_n_double("sketch") > 0)
    merged = some.groupBy("column_name").agg(
        F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("sketch")
    )
    asked = F.array(*map(F.lit, probabilities))
    values = F.kll_sketch_get_quantile_double("sketch", asked)
    return merged.select(
        "column_name", F.inline(F.arrays_zip(asked.alias("probability"), values.alias("value"))).alias("probability", "value")
    )
