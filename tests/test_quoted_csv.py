"""CSV with line breaks in quotes, read in parallel, against Python's csv module."""

import csv
import io
import random

import pytest

from tillroll.sources import files
from tillroll.model import SCHEMAS


@pytest.fixture
def small_splits(spark):
    """Files are cut every 97 bytes, so that most records lie across a cut."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


def written(path, rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    path.write_bytes(out.getvalue().encode())


def records(spark, path):
    return [(r["record"], r["text"]) for r in sorted(files.quoted_records(spark, str(path)).collect(), key=lambda r: (r["file"], r["record"]))]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_across_splits(spark, small_splits, tmp_path, end):
    draw = random.Random(4)
    pieces = ["plain", 'say "no"', "a,b", "line\nbreak", "\n\n", "é" * 30, "x" * 250, '"', '\n"\n', "", "word " * 9]
    rows = [["id", "text", "more"]] + [[str(i), "".join(draw.choices(pieces, k=3)), draw.choice(pieces)] for i in range(150)]
    path = tmp_path / "t.csv"
    written(path, rows, end)
    lines = spark.read.option("lineSep", "\n").text(str(path))
    assert lines.rdd.getNumPartitions() > 20
    found = records(spark, path)
    assert [n for n, _ in found] == list(range(len(rows)))
    assert [next(csv.reader(io.StringIO(text, newline=""))) for _, text in found] == rows


def test_every_file_starts_anew(spark, small_splits, tmp_path):
    for name in "ab":
        written(tmp_path / f"{name}.csv", [["h"], [f'{name} "quoted"\nlines'], ["z"]])
    found = records(spark, tmp_path)
    assert [n for n, _ in found] == [0, 1, 2, 0, 1, 2]
    (tmp_path / "a.csv").write_text("")
    assert len(records(spark, tmp_path)) == 3


def test_table_from_one_large_file(spark, small_splits, tmp_path):
    columns = list(SCHEMAS["reviews"].names)
    rows = [[{"Review_Text": f'say "{i}",\nthen "more"\n'}.get(c, str(i)) for c in columns] for i in range(60)]
    path = tmp_path / "reviews.csv"
    order = columns[::-1]
    written(path, [order, *[r[::-1] for r in rows]])
    found = files.read_csv(spark, str(path), "reviews")
    assert found.columns == columns
    texts = sorted((r["Review_Text"] for r in found.select("Review_Text").collect()), key=lambda t: int(t.split('"')[1]))
    assert texts == [f'say "{i}",\nthen "more"\n' for i in range(60)]


def test_wrong_files_are_errors(spark, tmp_path):
    columns = list(SCHEMAS["reviews"].names)
    written(tmp_path / "a.csv", [columns, ["1"] * (len(columns) + 1)])
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, str(tmp_path / "a.csv"), "reviews").count()
    written(tmp_path / "b.csv", [columns, ["1"] * len(columns)])
    written(tmp_path / "a.csv", [columns[::-1], ["1"] * len(columns)])
    with pytest.raises(ValueError, match="header"):
        files.read_csv(spark, str(tmp_path), "reviews")


def test_lines_are_not_shuffled(spark, small_splits, tmp_path):
    """Only records that lie across byte ranges meet by number; the others are put together where they are read."""
    written(tmp_path / "t.csv", [["a", "b"], *[[str(i), f'say "{i}"\nmore' * (i % 4)] for i in range(300)]])
    plan = files.quoted_records(spark, str(tmp_path / "t.csv"))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange") == 1
    above = plan[: plan.index("Exchange")]
    assert "Union" in above and "ObjectHashAggregate" in above


def test_changed_splits_are_noticed(spark, small_splits, tmp_path, monkeypatch):
    """A second pass over other ranges than the first one's would cut records wrongly."""
    written(tmp_path / "t.csv", [["a", "b"], *[[str(i), '"\n' * (i % 3)] for i in range(100)]])
    expected, settle, passes = records(spark, tmp_path / "t.csv"), files.settled, []

    def settled(df):
        passes.append(spark.conf.get("spark.sql.files.maxPartitionBytes"))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "61" if len(passes) == 1 else "97")
        out = settle(spark.read.option("lineSep", "\n").text(str(tmp_path / "t.csv")).select(
            "_metadata.file_path", "_metadata.file_block_start", "value"
        ).toDF("file", "range", "value").mapInArrow(lambda b: files._joined_lines(b, {}, '"'), df.schema)) if len(passes) == 1 else settle(df)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
        return out

    monkeypatch.setattr(files, "settled", settled)
    assert records(spark, tmp_path / "t.csv") == expected and len(passes) == 2
