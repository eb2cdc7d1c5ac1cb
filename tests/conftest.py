import datetime
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tillroll.model import SCHEMAS  # noqa: E402
from tillroll.session import local_session  # noqa: E402
from tillroll.sources.star import star_tables  # noqa: E402
from tillroll.sources.tables import Tables  # noqa: E402

SMALL = "/root/testdata/sf0.001"

FILLERS = {
    "string": "x",
    "int": 1,
    "date": datetime.date(2024, 1, 1),
}


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", 4, "6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    return star_tables(spark, SMALL)


@pytest.fixture
def table(spark):
    """Builds a table of the model from rows that name only the columns of interest."""

    def build(name, rows):
        fields = SCHEMAS[name].fields

        def value(row, field):
            if field.name in row:
                given = row[field.name]
                is_money = field.dataType.typeName() == "decimal"
                return Decimal(str(given)) if is_money and given is not None else given
            kind = field.dataType.simpleString()
            return FILLERS.get(kind, Decimal("1.00") if kind.startswith("decimal") else None)

        data = [tuple(value(row, f) for f in fields) for row in rows]
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
        return spark.createDataFrame(data, kinds)

    return build


@pytest.fixture
def tables(table):
    """A table set from rows per table; tables not given are empty."""

    def build(**rows):
        return Tables({name: table(name, rows.get(name, [])) for name in SCHEMAS})

    return build


def rows_of(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
