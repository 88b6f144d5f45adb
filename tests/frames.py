"""Hand-made tables of a few rows."""

from __future__ import annotations

import json
from datetime import date, datetime

import pyarrow
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

from driver.tables import CATALOG_PRICES
from valuelens import schemas
from valuelens.sources.catalog import parse_catalogs

HOST = "support.example.com"


def table(spark, rows, ddl):
    """A local table; by way of Arrow, which needs no job to read it."""
    schema = StructType.fromDDL(ddl)
    records = [dict(zip(schema.names, row)) for row in rows]
    arrow = pyarrow.Table.from_pylist(
        [_record(record, schema) for record in records], schema=to_arrow_schema(schema)
    )
    return spark.createDataFrame(arrow, schema)


def _record(value, kind):
    """Tuples for structs become dictionaries, as Arrow wants them."""
    if isinstance(kind, StructType) and value is not None:
        fields = value if isinstance(value, dict) else dict(zip(kind.names, value))
        return {field.name: _record(fields[field.name], field.dataType) for field in kind}
    if isinstance(kind, ArrayType) and value is not None:
        return [_record(item, kind.elementType) for item in value]
    return value


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def event(time, test="T", variant="control", component="ACQUISITIONS_EPIC", action="VIEW"):
    return (at(time), action, component, test, variant)


def page_view(
    received, events=None, ab_tests=None, host="www.example.com", path="/a", country="GB"
):
    return ("https", host, path, country, events, ab_tests, date.fromisoformat(received))


def page_views(spark, *rows):
    return table(spark, rows, schemas.PAGE_VIEWS)


def acquisition(
    time,
    product="CONTRIBUTION",
    frequency="ONE_OFF",
    currency="EUR",
    amount=10.0,
    component="ACQUISITIONS_EPIC",
    country="GB",
    url="https://www.example.com/a",
    tests=(("T", "control"),),
):
    tests = None if tests is None else list(tests)
    return (at(time), product, frequency, currency, amount, component, country, url, tests)


def acquisitions(spark, *rows):
    return table(spark, rows, schemas.ACQUISITIONS)


def rates(spark, *rows):
    """Rows are (day, currency, rate)."""
    days = [(date.fromisoformat(day), target, rate) for day, target, rate in rows]
    return table(spark, days, schemas.EXCHANGE_RATES)


def configs(spark, *rows):
    return table(spark, rows, "channel string, name string")


def catalog_json(**changes) -> str:
    document: dict = {}
    for (product, plan), pricing in CATALOG_PRICES.items():
        entry = document.setdefault(product, {"active": True, "ratePlans": {}})
        entry["ratePlans"][plan] = {"billingPeriod": plan, "pricing": pricing}
    document.update(changes)
    return json.dumps(document)


def catalog(spark, text: str | None = None):
    rows = table(spark, [(text or catalog_json(),)], "document string")
    return parse_catalogs(rows, "document")


def dicts(frame, *order):
    """Rows as dictionaries, sorted by the named columns."""
    rows = [row.asDict(recursive=True) for row in frame.collect()]
    return sorted(rows, key=lambda row: [str(row[name]) for name in order or frame.columns])
