"""The endpoint source against a small server that answers from the given tables."""

import json
import threading
import urllib.parse
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import duckdb
import pytest
from pyspark.sql import datasource as D
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachmap.sources import endpoint, readers

ORDERS = "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderdate date"
ORDERS_FILE = "/root/testdata/sf0.001/orders.parquet"


@pytest.fixture
def server():
    """(url, requests, rows sent, failures to come)"""
    asked, sent, failing = [], [], []

    class Answer(BaseHTTPRequestHandler):
        def do_GET(self):
            q = dict(urllib.parse.parse_qsl(urllib.parse.urlsplit(self.path).query))
            asked.append(q)
            if failing:
                self.send_error(failing.pop())
                return
            table = urllib.parse.urlsplit(self.path).path.strip("/")
            sql = f"SELECT {q['$select']} FROM {table}"
            for key, words in (("$where", "WHERE"), ("$order", "ORDER BY"), ("$limit", "LIMIT"), ("$offset", "OFFSET")):
                sql += f" {words} {q[key]}" if key in q else ""
            db = duckdb.connect()
            db.execute(f"CREATE VIEW orders AS SELECT * FROM '{ORDERS_FILE}'")
            db.execute("CREATE TABLE odd AS SELECT * FROM (VALUES (1, 'O''Hara', 5.5), (2, NULL, NULL), (3, '5.10', -1.0)) t(id, name, v)")
            cursor = db.execute(sql)
            names = [d[0] for d in cursor.description]
            # as such endpoints do, null fields are left out
            rows = [{n: v for n, v in zip(names, r, strict=True) if v is not None} for r in cursor.fetchall()]
            sent.extend(rows if "$offset" in q else [])
            body = json.dumps(rows, default=str).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    http = ThreadingHTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{http.server_port}", asked, sent, failing
    http.shutdown()


def test_filters_columns_and_pages_are_handed_over(spark, server):
    url, asked, sent, _ = server
    where = (F.col("o_totalprice") > 100_000) & (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= F.lit("1995-01-01").cast("date")) & F.col("o_orderkey").isin(*range(1, 600))
    found = readers.pushed(endpoint.read_endpoint(spark, f"{url}/orders", ORDERS, order="o_orderkey", page=7), where, ["o_orderkey", "o_totalprice"])
    expected = duckdb.sql(f"SELECT o_orderkey, o_totalprice FROM '{ORDERS_FILE}' WHERE o_totalprice > 100000 AND o_orderstatus = 'F' AND o_orderdate >= DATE '1995-01-01' AND o_orderkey BETWEEN 1 AND 599 ORDER BY 1").fetchall()
    assert len(expected) > 14 and sorted(map(tuple, found.collect())) == expected
    assert len(sent) == len(expected)  # and no row more
    pages = [q for q in asked if "$offset" in q]
    assert sorted(int(q["$offset"]) for q in pages) == list(range(0, len(expected), 7))
    for q in pages:
        assert q["$select"] == "o_orderkey,o_orderstatus,o_totalprice,o_orderdate"
        assert "o_totalprice > 100000.0" in q["$where"] and "o_orderstatus = 'F'" in q["$where"] and "o_orderdate >= '1995-01-01'" in q["$where"] and "o_orderkey IN (" in q["$where"]


def test_a_limit_comes_before_filters(spark, server):
    url, asked, sent, _ = server
    rows = endpoint.read_endpoint(spark, f"{url}/orders", "o_orderkey long, o_totalprice double", order="o_orderkey", limit=20, page=8).filter("o_totalprice > 100000").collect()
    expected = duckdb.sql(f"SELECT o_orderkey FROM (SELECT * FROM '{ORDERS_FILE}' ORDER BY o_orderkey LIMIT 20) WHERE o_totalprice > 100000 ORDER BY 1").fetchall()
    assert sorted((r.o_orderkey,) for r in rows) == expected and len(sent) == 20 and not any("$where" in q for q in asked)


def test_odd_values(spark, server):
    url, asked, _, failing = server
    read = lambda schema="id int, name string, v double": endpoint.read_endpoint(spark, f"{url}/odd", schema)
    assert sorted(map(tuple, read().collect())) == [(1, "O'Hara", 5.5), (2, None, None), (3, "5.10", -1.0)]
    assert [r.id for r in read().filter(F.col("name") == "O'Hara").collect()] == [1] and asked[-1]["$where"].endswith("name = 'O''Hara'")
    assert [r.id for r in read().filter("name is null").collect()] == [2]
    assert [r.id for r in read().filter("name like '5%'").collect()] == [3] and "starts_with(name, '5')" in asked[-1]["$where"]
    # what an endpoint may see otherwise stays here
    assert [r.id for r in read().filter("name > '6'").collect()] == [1] and "name >" not in asked[-1].get("$where", "")
    assert sorted(r.id for r in read().filter("not (v = 5.5) or v is null").collect()) == [2, 3]
    assert read().filter("v = 77").collect() == [] and read("id long").count() == 3
    failing.extend([503, 500])
    assert read().count() == 3  # asked again
    failing.append(404)
    with pytest.raises(Exception, match="404"):
        read().count()
    with pytest.raises(Exception, match="order"):
        endpoint.read_endpoint(spark, f"{url}/odd", "id int", page=2).count()
    with pytest.raises(Exception, match="no column"):
        read("id array<int>").count()


def test_conditions():
    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b c", T.StringType())])
    assert endpoint.condition(D.LessThan(("a",), 1.5), schema) == "a < 1.5"
    for f in (D.LessThan(("a",), float("inf")), D.EqualTo(("b c",), "x"), D.EqualTo(("a", "z"), 1), D.Not(D.EqualTo(("a",), 1.0)), D.In(("a",), (None,)), D.EqualTo(("gone",), 1), D.EqualTo(("a",), None)):
        assert endpoint.condition(f, schema) is None
    assert endpoint.condition(D.In(("a",), (1, None, 2)), schema) == "a IN (1, 2)"
    assert endpoint.condition(D.In(("a",), tuple(range(2000))), schema) is None
