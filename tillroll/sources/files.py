"""Reading and writing the tables: CSV in, Parquet or CSV out."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.model import DEFAULTS, SCHEMAS
from tillroll.operators.settle import settled
from tillroll.sources.tables import Tables

# Field texts that usual data-frame CSV readers take for "no value".
NULL_TEXTS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


# The key each table is joined on most.
BUCKET_KEYS = {
    "categories": "Category_ID",
    "products": "Product_ID",
    "customers": "Customer_ID",
    "orders": "Order_ID",
    "order_items": "Order_ID",
    "payments": "Order_ID",
    "shipping": "Order_ID",
    "reviews": "Order_Item_ID",
}


def typed(col: Column, kind: T.DataType) -> Column:
    """A text field as ``kind``; text that does not fit becomes NULL instead of an error."""
    if isinstance(kind, T.StringType):
        return col
    clean = F.trim(col)
    if isinstance(kind, T.IntegerType):
        return whole_number(clean)
    return clean.try_cast(kind)


def whole_number(col: Column, kind: str = "int") -> Column:
    """Text as a whole number: "3.0" is 3, as whole numbers with gaps are often written; "3.7" is NULL."""
    number = col.try_cast("decimal(38,9)")
    return F.when(number == F.floor(number), F.floor(number)).try_cast(kind)


def null_texts_removed(col: Column, null_texts: Iterable[str] = NULL_TEXTS) -> Column:
    return F.when(~F.trim(col).isin(*null_texts), col)


def from_text(df: DataFrame, table: str, null_texts: Iterable[str] = NULL_TEXTS) -> DataFrame:
    """An all-text frame brought to the declared schema of ``table``.

    Columns the frame lacks get their default; an empty field in a present column stays NULL.
    """
    defaults = DEFAULTS.get(table, {})
    present = {c.lower(): c for c in df.columns}
    columns = []
    for field in SCHEMAS[table]:
        name = present.get(field.name.lower())
        if name is None:
            value = F.lit(defaults.get(field.name)).cast(field.dataType)
        else:
            value = typed(null_texts_removed(F.col(name), null_texts), field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


# Tables whose texts may hold line breaks; their records are put together from the lines of a file.
FREE_TEXT = ("reviews",)


def _odd_before(quotes: np.ndarray, entered: int) -> np.ndarray:
    """Whether each line begins within quotes, given whether the first one does."""
    before = np.cumsum(quotes) - quotes
    return (before + entered) % 2


def _sliced(batches: Iterator[pa.RecordBatch], quote: str) -> Iterator[tuple[str, int, pa.Array, np.ndarray]]:
    """File, byte range, lines and their quotes; a task reads the lines of a range one after the other."""
    for batch in batches:
        if not batch.num_rows:
            continue
        places = np.stack([np.asarray(batch.column("file").dictionary_encode().indices, np.int64), np.asarray(batch.column("range"), np.int64)])
        quotes = np.asarray(pc.count_substring(batch.column("value"), quote), np.int64)
        starts = [0, *(np.flatnonzero((places[:, 1:] != places[:, :-1]).any(axis=0)) + 1).tolist()]
        for low, high in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.column("file")[low].as_py(), batch.column("range")[low].as_py(), batch.column("value").slice(low, high - low), quotes[low:high]


def _counted_ranges(batches: Iterator[pa.RecordBatch], quote: str) -> Iterator[pa.RecordBatch]:
    """Per byte range its quotes, and the lines that begin outside quotes if the range does so or not."""
    sums: dict[tuple[str, int], np.ndarray] = {}
    for file, start, _, quotes in _sliced(batches, quote):
        so_far = sums.setdefault((file, start), np.zeros(3, np.int64))
        odd = int(_odd_before(quotes, int(so_far[0])).sum())
        so_far += [int(quotes.sum()), len(quotes) - odd, odd]
    if sums:
        columns = [[f for f, _ in sums], [r for _, r in sums], *np.array(list(sums.values())).T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["file", "range", "quotes", "if_even", "if_odd"])


def _joined_lines(batches: Iterator[pa.RecordBatch], entered: dict[tuple[str, int], tuple[int, int]], quote: str) -> Iterator[pa.RecordBatch]:
    """The lines of each record that lie in one byte range, as one text.

    ``whole`` is false for the first and last record of a range, which may go on in the ranges beside it. After the
    records of a range comes a row with its quotes in place of a record and no text.
    """
    here, inside, number, seen, pending = None, 0, 0, 0, []  # pending: the lines so far of the record that is last

    def rows(record, whole, texts) -> pa.RecordBatch:
        columns = [pa.array([here[0]] * len(texts)), pa.array([here[1]] * len(texts), pa.int64()), pa.array(record, pa.int64()), pa.array(whole, pa.bool_()), texts]
        return pa.RecordBatch.from_arrays(columns, RECORD_PIECES)

    def ended() -> Iterator[pa.RecordBatch]:
        if pending:
            yield rows([number], [False], pa.array(["\n".join(pending)]))
        if here:
            yield rows([seen], [None], pa.array([None], pa.string()))

    for file, start, lines, quotes in _sliced(batches, quote):
        if here != (file, start):
            yield from ended()
            here, pending, first, seen = (file, start), [], True, 0
            inside, before = entered.get((file, start), (0, 0))
            number = before - 1
        seen += int(quotes.sum())
        begins = np.flatnonzero(_odd_before(quotes, inside) == 0)
        inside = (inside + int(quotes.sum())) % 2
        if not len(begins):
            pending += lines.to_pylist()
            continue
        head = lines.slice(0, int(begins[0])).to_pylist()
        if pending or head:  # the record that began earlier ends here
            yield rows([number], [not first], pa.array(["\n".join([*pending, *head])]))
            first = False
        n = len(begins) - 1
        if n:
            middle = lines.slice(int(begins[0]), int(begins[-1] - begins[0]))
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(begins - begins[0], pa.int32()), middle), "\n")
            whole = np.ones(n, bool)
            whole[0] = not first
            yield rows(np.arange(number + 1, number + 1 + n), whole, texts)
            first = False
        number += len(begins)
        pending = lines.slice(int(begins[-1])).to_pylist()
        first = first and not n
    yield from ended()


READINGS = 5  # of files whose splits differ from one pass to the next, as when executors come and go
RECORD_PIECES = ["file", "range", "record", "whole", "text"]


def quoted_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """The records of CSV files whose quoted fields may hold line breaks: file, record (from 0), text.

    Files are split like plain text, a task per byte range. A line that ends with an odd number of quotes since the
    file's start goes on in the next one. Whether a range begins within quotes follows from the quotes in the
    ranges before it, and so does the number of records before it, for which a range counts both cases:
    a row per range is all that is gathered. A task then joins the lines of its records itself; only the first and
    the last record of a range meet by their number with what lies in the ranges beside it. If the ranges of the second
    pass are not those of the first, both are done again.
    A line break is a line feed, with or without a carriage return before it at a record's end.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), "value"
    )
    for _ in range(READINGS):
        ranges = lines.mapInArrow(
            lambda batches: _counted_ranges(batches, quote), "file string, range long, quotes long, if_even long, if_odd long"
        )
        entered, quotes, file = {}, {}, None
        for row in sorted(ranges.collect()):  # a row per byte range
            if row["file"] != file:
                file, inside, before = row["file"], 0, 0
            entered[row["file"], row["range"]] = inside, before
            quotes[row["file"], row["range"]] = row["quotes"]
            before += row["if_odd"] if inside else row["if_even"]
            inside = (inside + row["quotes"]) % 2
        pieces = settled(
            lines.mapInArrow(
                lambda batches: _joined_lines(batches, entered, quote), "file string, range long, record long, whole boolean, text string"
            )
        )
        again = {(r["file"], r["range"]): r["record"] for r in pieces.filter("whole is null").select("file", "range", "record").collect()}
        if again == quotes:
            break
    else:
        raise RuntimeError(f"{path}: files or their splits change while they are read")
    parts = F.sort_array(F.collect_list(F.struct("range", "text")))
    across = pieces.filter("not whole").groupBy("file", "record").agg(
        F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text")
    )
    records = pieces.filter("whole").select("file", "record", "text").unionByName(across)
    return records.withColumn("text", F.regexp_replace("text", "\r$", ""))


def _read_quoted(spark: SparkSession, path: str, names: list[str], options: dict, by_name: bool) -> DataFrame:
    """Text columns of CSV files with line breaks in quotes; a wrong number of fields or another header is an error."""
    records = quoted_records(spark, path, options["quote"])
    parsing = {"sep": options["sep"], "quote": options["quote"], "escape": options["escape"], "mode": "FAILFAST"}
    layout = ", ".join(f"`{n}` string" for n in names)
    fields = F.from_csv("text", layout, parsing)
    if options["header"]:
        if by_name:
            heads = records.filter("record = 0").select(F.array(*[fields[n] for n in names]).alias("head")).distinct()
            for row in heads.limit(2).collect():
                if [n.strip().lower() for n in row["head"]] != [n.strip().lower() for n in names]:
                    raise ValueError(f"{path}: files with different headers")
        records = records.filter("record > 0")
    # the whole row is parsed, so that the number of fields is checked whatever columns a query asks for
    parsed = settled(records.filter("text <> ''").select(fields.alias("row")))
    return parsed.select("row.*")


def read_csv(
    spark: SparkSession,
    path: str,
    table: str,
    columns: Iterable[str] | None = None,
    sep: str = ",",
    quote: str = '"',
    header: bool = True,
    multiline: bool | None = None,
    null_texts: Iterable[str] = NULL_TEXTS,
) -> DataFrame:
    """One table from CSV, its columns found by the names in the header line, in any order.

    A column that the file lacks gets its default; a name that the table lacks is an error, as is a
    second file whose header differs, and a row with too few or too many fields fails the query. Without
    a header, or with ``columns``, the fields are taken by position (default: the schema's order).
    ``multiline`` allows line breaks within quotes (``quoted_records``); such files are stored as rows
    when this is called. Unless given it holds for the tables of ``FREE_TEXT``.
    """
    options = {
        "sep": sep,
        "quote": quote,
        "escape": quote,
        "header": header,
        "multiLine": table in FREE_TEXT if multiline is None else multiline,
    }
    known = {c.lower(): c for c in SCHEMAS[table].names}
    by_name = header and columns is None
    if by_name:
        names = spark.read.csv(path, **options).columns
        unknown = [n for n in names if n.strip().lower() not in known]
        if unknown:
            raise ValueError(f"{table} has no column {', '.join(unknown)}")
    else:
        names = list(columns or SCHEMAS[table].names)
    if options["multiLine"]:
        raw = _read_quoted(spark, path, names, options, by_name)
        return from_text(raw.toDF(*[n.strip() for n in names]), table, null_texts)
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    # without pruning, so that the number of fields is checked whatever columns a query asks for
    reader = spark.read.schema(text).option("columnPruning", False)
    raw = reader.csv(path, enforceSchema=not by_name, mode="FAILFAST", **options)
    return from_text(raw.toDF(*[n.strip() for n in names]), table, null_texts)


def read_csv_tables(spark: SparkSession, folder: str, **options) -> Tables:
    """All eight tables from ``<folder>/<table>.csv``."""
    return Tables(
        {
            name: lambda _, name=name: read_csv(spark, f"{folder}/{name}.csv", name, **options)
            for name in SCHEMAS
        }
    )


def read_parquet_tables(spark: SparkSession, folder: str) -> Tables:
    """All eight tables from ``<folder>/<table>``, as ``write_tables`` leaves them.

    The files say their own types: money may be stored wider than declared.
    """
    return Tables(
        {name: lambda _, name=name: spark.read.parquet(f"{folder}/{name}") for name in SCHEMAS}
    )


def write_table(df: DataFrame, path: str, kind: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(kind).save(path)


def write_tables(tables: Tables, folder: str) -> None:
    for name in tables:
        write_table(tables[name], f"{folder}/{name}")


def save_bucketed(
    tables: Tables,
    folder: str,
    buckets: int,
    prefix: str = "",
    bucketed: Iterable[str] = tuple(BUCKET_KEYS),
) -> None:
    """Save as catalog tables, those named in ``bucketed`` bucketed on the key their joins use.

    Bucketed tables join and group on that key without a shuffle. A bucket is read by one task, so a
    table with a hot key is better left out: its joins then shuffle, and adaptive execution can split
    the key.
    """
    chosen = set(bucketed)
    for name in tables:
        df, key = tables[name], BUCKET_KEYS[name]
        if name in chosen:
            # one file per bucket
            writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        else:
            writer = df.write
        path = f"{folder}/{name}"
        writer.mode("overwrite").option("path", path).saveAsTable(f"{prefix}{name}")


def read_catalog_tables(spark: SparkSession, prefix: str = "") -> Tables:
    """All eight tables from the catalog, as ``save_bucketed`` leaves them."""
    return Tables({name: lambda _, name=name: spark.table(f"{prefix}{name}") for name in SCHEMAS})


def write_lines(facts: DataFrame, path: str) -> None:
    """A ``(metric, value)`` frame as text, one fact per line, in its own order.

    For short reports: the lines come out as one file.
    """
    line = F.concat_ws(": ", "metric", "value").alias("value")
    facts.select(line).coalesce(1).write.mode("overwrite").text(path)


def stored_row_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows of stored Parquet tables by name, from the files' own statistics: no column is read.

    The counting is pushed down to the files, for which a session of its own reads them with the newer source;
    the caller's settings stay as they are. Without paths the result is empty.
    """
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counts = footers.createDataFrame([], "table_name string, row_count long")
    for name, path in paths.items():
        rows = footers.read.parquet(path).agg(F.count("*").alias("row_count"))
        counts = counts.unionByName(rows.select(F.lit(name).alias("table_name"), "row_count"))
    return counts


def register_views(tables: Tables, views: dict[str, DataFrame]) -> None:
    """Make the tables and the given views available to ``spark.sql``."""
    for name in tables:
        tables[name].createOrReplaceTempView(name)
    for name, view in views.items():
        view.createOrReplaceTempView(name)
