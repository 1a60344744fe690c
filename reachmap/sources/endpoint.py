"""Rows of a web endpoint that filters, selects and pages on its side, as a data source.

Such endpoints take ``$select``, ``$where``, ``$order``, ``$limit`` and ``$offset`` and answer with a JSON array of
objects. Filters on the frame go into ``$where``, the schema's columns into ``$select``,
and each page is a task of its own: what is not asked for is neither sent nor parsed. A page
that is lost with its executor is asked for again, so rows need an order that holds, by a unique key.
Spark holds the rows against the filters once more, as an endpoint may
know other types than the schema; only what can't be narrower there is handed over.
"""

from __future__ import annotations

import datetime
import json
import math
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import types as T

NAME = "rows_endpoint"
#: Rows of a page, how often a request is made at most, and the seconds it may take.
PAGE, TRIES, TIMEOUT = 50_000, 5, 60
#: Characters of a list of values in a request; longer lists stay with Spark, as addresses have a length.
LIST = 4_000
#: What a column can be, and in Arrow.
KINDS = {T.StringType(): pa.string(), T.IntegerType(): pa.int32(), T.LongType(): pa.int64(), T.DoubleType(): pa.float64(), T.BooleanType(): pa.bool_(), T.DateType(): pa.date32()}
_COMPARED = {D.GreaterThan: ">", D.GreaterThanOrEqual: ">=", D.LessThan: "<", D.LessThanOrEqual: "<="}


def literal(value: object) -> str | None:
    """A value in a condition; None if it has no form that all endpoints read alike."""
    match value:
        case bool():
            return str(value).lower()
        case int():
            return str(value)
        case float():
            return repr(value) if math.isfinite(value) else None
        case str():
            return "'" + value.replace("'", "''") + "'"
        case datetime.date() if not isinstance(value, datetime.datetime):
            return f"'{value.isoformat()}'"
    return None


def condition(f: D.Filter, schema: T.StructType) -> str | None:
    """The condition of one filter; None if it stays with Spark alone.

    Texts are compared for equality and by their beginning only, as an endpoint may sort
    them otherwise or hold numbers where the schema has texts. A negation of what may be wider there would be narrower, so none goes.
    """
    path = getattr(f, "attribute", ())
    if len(path) != 1 or not re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", name := path[0]) or name not in schema.names:
        return None
    if isinstance(f, D.IsNull | D.IsNotNull):
        return f"{name} IS {'NOT ' if isinstance(f, D.IsNotNull) else ''}NULL"
    text = isinstance(schema[name].dataType, T.StringType)
    if isinstance(f, D.In):
        values = [literal(v) for v in f.value if v is not None]
        listed = ", ".join(values) if values and None not in values else ""
        return f"{name} IN ({listed})" if 0 < len(listed) <= LIST else None
    if (value := literal(getattr(f, "value", None))) is None:
        return None
    if isinstance(f, D.EqualTo):
        return f"{name} = {value}"
    if isinstance(f, D.StringStartsWith):
        return f"starts_with({name}, {value})"
    sign = _COMPARED.get(type(f))
    return f"{name} {sign} {value}" if sign and not text else None


def column(values: list, kind: T.DataType) -> pa.Array:
    """Values of JSON objects, numbers or texts, as a column; absent ones are null."""
    texts = [v if v is None or isinstance(v, str) else json.dumps(v) for v in values]
    if isinstance(kind, T.DateType):
        texts = [t and t[:10] for t in texts]  # endpoints put a time of midnight after a date
    return pa.array(texts, pa.string()).cast(KINDS[kind])


@dataclass
class Page(D.InputPartition):
    offset: int
    rows: int


class Reader(D.DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]) -> None:
        self.schema, self.url, self.order = schema, options["url"], options.get("order")
        self.page, self.limit = int(options.get("page", PAGE)), int(options["limit"]) if "limit" in options else None
        self.where: list[str] = []

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:
        # with a limit the rows are chosen before they are filtered
        self.where = [c for f in filters if (c := condition(f, self.schema))] if self.limit is None else []
        return filters

    def ask(self, **asked: object) -> list[dict]:
        """The answer to one request; a request that fails on the way or on the other side is made again, later each time."""
        if self.where:
            asked["where"] = " AND ".join(self.where)
        url = f"{self.url}?{urllib.parse.urlencode({f'${k}': v for k, v in asked.items()})}"
        for tried in range(1, TRIES + 1):
            try:
                with urllib.request.urlopen(url, timeout=TIMEOUT) as answer:
                    return json.load(answer)
            except (urllib.error.URLError, TimeoutError, ConnectionError) as error:
                code = getattr(error, "code", 500)
                if tried == TRIES or (code < 500 and code != 429):
                    raise
                time.sleep(2 ** (tried - 1) / 2)
        raise AssertionError

    def partitions(self) -> list[Page]:
        n = int(self.ask(select="count(*) AS n")[0]["n"])
        n = n if self.limit is None else min(n, self.limit)
        if n > self.page and not self.order:
            raise ValueError("rows of several pages need an order: name a unique column")
        return [Page(at, min(self.page, n - at)) for at in range(0, n, self.page)]

    def read(self, page: Page | None) -> Iterator[pa.RecordBatch]:
        if page is None:  # no rows, no pages
            return
        order = {"order": self.order} if self.order else {}
        rows = self.ask(select=",".join(self.schema.names), **order, limit=page.rows, offset=page.offset)
        yield pa.RecordBatch.from_arrays([column([r.get(f.name) for r in rows], f.dataType) for f in self.schema], self.schema.names)


class Rows(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def reader(self, schema: T.StructType) -> Reader:
        if odd := [f.name for f in schema if f.dataType not in KINDS]:
            raise ValueError(f"no column of an endpoint can be {odd}")
        return Reader(schema, dict(self.options))


def read_endpoint(spark: SparkSession, url: str, schema: str, order: str | None = None, limit: int | None = None, page: int = PAGE) -> DataFrame:
    """The rows of an endpoint, of the columns in ``schema``; filters on the frame are handed over.

    ``order``: a unique column, needed for more than one page. ``limit``: the first so many rows, of
    which filters then choose. An endpoint without rows gives none; an absent field is null. Rows that change while they are
    read may be missed or come twice.
    """
    spark.dataSource.register(Rows)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    options = {"url": url, "page": page} | ({"order": order} if order else {}) | ({} if limit is None else {"limit": limit})
    return spark.read.format(NAME).schema(schema).options(**options).load()
