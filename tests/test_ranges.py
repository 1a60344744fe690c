"""Files read in ranges against the one-task readers."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from reachmap.sources import ranges, readers


@pytest.fixture
def small_ranges(spark):
    """Files are dealt out in ranges of a few bytes."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def set_to(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield set_to
    for k, v in held.items():
        spark.conf.set(k, v)


FIELDS = ["plain", "", 'say "so"', "two\nlines", "a,b", "\n\n", '"', '""\n"', "é漢", "long " * 40, "x\r\ny", ",", "end\n"]


def written_csv(tmp_path, rows, name="t.csv", **how):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n", **how).writerows(rows)
    (tmp_path / name).write_bytes(out.getvalue().encode())
    return f"file://{tmp_path}/{name}"


@pytest.mark.parametrize("size", [37, 5000])
def test_quoted_line_ends_on_every_border(spark, tmp_path, small_ranges, size):
    rng = random.Random(size)
    rows = [[str(i), rng.choice(FIELDS), rng.choice(FIELDS)] for i in range(16)]
    path = written_csv(tmp_path, [["id", "a", "b"], *rows], quoting=csv.QUOTE_ALL if size % 2 else csv.QUOTE_MINIMAL)
    small_ranges(size)
    table = readers.read_text_table(spark, path)
    assert ranges.parts(spark, path, ranges.Delimited()).rdd.getNumPartitions() > min(8, 500 // size)
    got = sorted((tuple(r) for r in table.collect()), key=lambda r: int(r[0]))
    plain = spark.read.options(header=True, quote='"', escape='"', multiLine=True).schema("id string, a string, b string").csv(path)
    want = sorted((tuple(r) for r in readers.null_tokens(plain).collect()), key=lambda r: int(r[0]))
    assert got == want and len(got) == len(rows)


def test_many_files_long_rows_and_encoding(spark, tmp_path, small_ranges):
    """Rows with a field too many go, even if it is empty; a short row stays; line ends of two bytes; a file without a last line end."""
    (tmp_path / "t").mkdir()
    for k in range(5):
        body = f'id,name\r\n{k}0,"Doña\r\nAna"\r\n\r\n{k}1,x,\r\n{k}2,y,more\r\n{k}3\r\n  \r\n{k}4,"a,b"\r\n{k}5,"last ""one""'
        (tmp_path / "t" / f"{k}.csv").write_bytes((body + ('"' if k % 2 else '"\r\n')).encode("latin-1"))
    (tmp_path / "t" / "none.csv").write_bytes(b"")
    small_ranges(60)
    got = sorted(tuple(r) for r in readers.read_text_table(spark, f"file://{tmp_path}/t", encoding="ISO-8859-1", skip_long_rows=True).collect())
    assert got == sorted(x for k in range(5) for x in [(f"{k}0", "Doña\r\nAna"), (f"{k}3", None), (f"{k}4", "a,b"), (f"{k}5", 'last "one"')])
    assert readers.read_text_table(spark, f"file://{tmp_path}/t", encoding="ISO-8859-1").count() == 30
    (tmp_path / "t" / "other.csv").write_text("id,title\n1,2\n")
    with pytest.raises(ValueError, match="title"):
        readers.read_text_table(spark, f"file://{tmp_path}/t")


def test_stray_quotes_and_an_open_end(spark, tmp_path, small_ranges):
    """A quote inside an unquoted field is text; the last record may lack its closing quote."""
    (tmp_path / "t.csv").write_text('id,a\n1,5" pipe\n2,x"y"z\n3,"in "" side"\n4,it\'s 6" and 7"\n5,"never\nclosed\n')
    small_ranges(13)
    records, heads = ranges.read_records(spark, f"file://{tmp_path}/t.csv", ranges.Delimited())
    assert sorted(r.record for r in records.collect()) == ['1,5" pipe', '2,x"y"z', '3,"in "" side"', '4,it\'s 6" and 7"', '5,"never\nclosed']
    assert [r.head for r in heads.collect()] == ["id,a"]


def test_a_first_record_over_its_range_is_an_error(spark, tmp_path, small_ranges):
    (tmp_path / "t.csv").write_text('"id\n' + "x" * 50 + '\n",a\n1,2\n')
    small_ranges(10)
    with pytest.raises(ValueError, match="first record"):
        ranges.read_records(spark, f"file://{tmp_path}/t.csv", ranges.Delimited())


VALUES = ["plain", 'quote " and ],[ in it', "]", "[", "\\", "\\]", "a\nb", "", None, "é漢\U0001f600", "},{", 'end\\"]']


@pytest.mark.parametrize(("size", "indent"), [(53, None), (97, 1)])
def test_json_arrays_in_ranges(spark, tmp_path, small_ranges, size, indent):
    """One file of one line or of many, strings with brackets in them, a nested array, another file with its columns turned."""
    rng = random.Random(size)
    rows = [[str(i), rng.choice(VALUES), rng.choice(VALUES)] for i in range(24)]
    (tmp_path / "a.json").write_text(json.dumps([["id", "a", "b"], *rows], ensure_ascii=False, indent=indent))
    (tmp_path / "b.json").write_text(json.dumps([["b", "id"], ["turned", "1000"]], separators=(",", ":")) + "\n")
    (tmp_path / "c.json").write_text("[]")
    small_ranges(size)
    got = sorted((tuple(r) for r in readers.read_json_rows(spark, f"file://{tmp_path}").select("id", "a", "b").collect()), key=lambda r: int(r[0]))
    assert got == [tuple(r) for r in rows] + [("1000", None, "turned")]
    assert ranges.parts(spark, f"file://{tmp_path}", ranges.ARRAYS).rdd.getNumPartitions() > 4


def test_nested_rows_and_numbers(spark, tmp_path, small_ranges):
    (tmp_path / "a.json").write_text('[ ["n", "x"] , [1, ["in", ["deep]"]]],[2.5,{"k": "[v]"}],\n[null,true]]')
    small_ranges(17)
    got = sorted((tuple(r) for r in readers.read_json_rows(spark, f"file://{tmp_path}/a.json").collect()), key=str)
    assert got == sorted([("1", '["in",["deep]"]]'), ("2.5", '{"k":"[v]"}'), (None, "true")], key=str)


def test_arrays_of_records_in_ranges(spark, tmp_path, small_ranges):
    rows = [{"fips": f"{i:05d}", "state": "TX", "county": VALUES[i % 12] or "none", "population": i, "rural": bool(i % 2), "miles_to_nearest": i / 10} for i in range(30)]
    (tmp_path / "areas.json").write_text(json.dumps(rows, ensure_ascii=False))
    small_ranges(200)
    got = sorted(readers.read_areas(spark, f"file://{tmp_path}/areas.json").collect(), key=lambda r: r.fips)
    assert [(r.fips, r.county, r.population, r.rural, r.miles_to_nearest, r.n_cah) for r in got] == [(x["fips"], x["county"], x["population"], x["rural"], x["miles_to_nearest"], None) for x in rows]
    with readers.held_areas(spark, f"file://{tmp_path}/areas.json") as areas:
        assert areas.filter("rural").count() == 15 and areas.is_cached
    assert not areas.is_cached


def test_other_ranges_in_the_second_pass_are_an_error(spark, tmp_path, small_ranges):
    path = written_csv(tmp_path, [["id", "a"], *[[str(i), "two\nlines"] for i in range(60)]])
    small_ranges(100)
    records, _ = ranges.read_records(spark, path, ranges.Delimited())
    small_ranges(130)
    with pytest.raises(Exception, match="not one of the first pass"):
        records.collect()


def test_a_range_is_held_by_one_task_at_a_time(spark, tmp_path, small_ranges):
    """No task reads more than its share of one large file."""
    path = written_csv(tmp_path, [["id", "a"], *[[str(i), "two\nlines " * 20] for i in range(4000)]])
    small_ranges(100_000)
    records, _ = ranges.read_records(spark, path, ranges.Delimited())
    sizes = [r[0] for r in records.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("record"))).collect()]
    assert records.count() == 4000 and len(sizes) >= 7 and max(sizes) < 110_000
