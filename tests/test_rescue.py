"""Broken CSV lines: what is told from what, and nothing lost."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from saleslake.operators import clean
from saleslake.plans import medallion
from saleslake.sources import layers, rescue
from saleslake.sources.rescue import RAW, REASON

HEADER = ["Row ID", "Order ID", "Product Name", "Sales"]


def write(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/{name}.csv", "w", encoding="utf-8", newline="") as out:
            out.write(text)
    return str(folder)


def read(spark, path, header=HEADER, **settings):
    rows = rescue.read_rescued(spark, path, header, **settings)
    assert rows.columns == [*header, REASON, RAW]
    return sorted(tuple(r) for r in rows.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("-")) for c in rows.columns]).collect())


def test_quotes_fields_and_headers(spark, tmp_path):
    path = write(
        tmp_path,
        a='Row ID,Order ID,Product Name,Sales\no1,A,"Binder, 3"" wide",1\no2,A,Desk,2,3\no3,A,Desk\no4,A,"Desk,4\n\no5,A,,\n',
        b='sales,Product_Name,order id,ROW ID\r\n6,Chair,B,o6\r\n7,"a ""b""",B,o7\r\n',
        c="Nr,Order ID,Product Name,Sales\no8,C,Desk,8\n",
        d="Row ID,Order ID,Product Name\no9,D,Desk\n",
        e="Row ID,Order ID,Product Name,Sales\n",
        f="",
    )
    empty = ("-",) * 4
    assert read(spark, path) == sorted([
        ("o1", "A", 'Binder, 3" wide', "1", "-", 'o1,A,"Binder, 3"" wide",1'), (*empty, "field_count", "o2,A,Desk,2,3"),
        (*empty, "field_count", "o3,A,Desk"), (*empty, "open_quote", 'o4,A,"Desk,4'), ("o5", "A", "-", "-", "-", "o5,A,,"),
        ("o6", "B", "Chair", "6", "-", "6,Chair,B,o6"), ("o7", "B", 'a "b"', "7", "-", '7,"a ""b""",B,o7'),
        (*empty, "wrong_header", "o8,C,Desk,8"), (*empty, "wrong_header", "o9,D,Desk"),
    ])


def test_header_of_most_files_is_taken(spark, tmp_path):
    path = write(tmp_path, a="x,y\n1,2\n", b="x,y\n3,4\n", c="z\n5\n")
    rows = rescue.read_rescued(spark, path)
    assert rows.columns == ["x", "y", REASON, RAW]
    assert sorted((r.x or "", r[REASON] or "") for r in rows.collect()) == [("", "wrong_header"), ("1", ""), ("3", "")]


def test_line_ends_in_values_and_compressed_files(spark, tmp_path):
    path = write(tmp_path / "x", a='Row ID,Order ID,Product Name,Sales\no1,A,"two\nlines",1\no2,A,Desk\n')
    assert [r[:5] for r in read(spark, path, line_ends=True)] == [("-", "-", "-", "-", "field_count"), ("o1", "A", "two\nlines", "1", "-")]
    assert [r[4] for r in read(spark, path)] == ["field_count", "field_count", "field_count"] or "open_quote" in [r[4] for r in read(spark, path)]
    os.makedirs(tmp_path / "z")
    with gzip.open(tmp_path / "z" / "a.csv.gz", "wt") as out:
        out.write("Sales,Product Name,Order ID,Row ID\n1,Desk,A,o1\n")
    assert read(spark, str(tmp_path / "z")) == [("o1", "A", "Desk", "1", "-", "1,Desk,A,o1")]


def test_reading_with_a_given_header_does_not_mix_up_columns(spark, tmp_path):
    path = write(tmp_path, b="order_id,row_id\n9,o9\n")
    with pytest.raises(Exception, match="(?i)header"):
        layers.read_bronze(spark, path, ["row_id", "order_id"]).collect()
    again = str(tmp_path / "out")
    layers.write_bronze(spark.createDataFrame([('Binder, 3" wide', "\\x")], "a string, b string"), again)
    assert tuple(layers.read_bronze(spark, again, ["a", "b"]).first()) == ('Binder, 3" wide', "\\x")


FULL = ["Row ID", "Order ID", "Order Date", "Ship Date", "Order Priority", "Postal Code", "Sales"]
TOP = ",".join(FULL)


def test_quarantine_and_replay(spark, tmp_path):
    path = write(
        tmp_path / "in",
        a=f"{TOP}\n1,A,01-02-2020,02-02-2020,High,,5\n2,B,01-02-2020,02-02-2020,High,,5,6\n3,C,01-02-2020,02-02-2020,High,,abc\n"
        "4,D,01-02-2020,02-02-2020,High,,4\n4,D,01-02-2020,02-02-2020,High,,4\n5,E,01-02-2020\n",
    )
    silver, bad = str(tmp_path / "silver"), str(tmp_path / "bad")
    assert [r.row_id for r in medallion.to_silver(spark, path, silver, bad).collect()] == [1]
    held = clean.line_ids(layers.read_silver(spark, bad))
    reasons = {r.raw_line: r.bad_reasons for r in held.collect()}
    assert reasons["2,B,01-02-2020,02-02-2020,High,,5,6"] == reasons["5,E,01-02-2020"] == ["malformed_field_count"]
    assert reasons["3,C,01-02-2020,02-02-2020,High,,abc"] == ["unreadable_sales", "no_sales"] and len(held.collect()) == 5
    ids = {r.raw_line: r.line_id for r in held.collect()}
    whole = dict(row_id="2", order_id="B", order_date="01-02-2020", ship_date="02-02-2020", order_priority="High", postal_code=None, sales="5")
    repairs = spark.createDataFrame(
        [
            (ids["2,B,01-02-2020,02-02-2020,High,,5,6"], *whole.values()), (ids["3,C,01-02-2020,02-02-2020,High,,abc"], *([None] * 6), "7"),
            # its key is taken, so it stays bad
            (ids["5,E,01-02-2020"], "1", "E", "01-02-2020", "03-02-2020", "Low", None, "9"),
        ],
        "line_id string, " + ", ".join(f"{c} string" for c in whole),
    )
    left = medallion.replay(spark, silver, bad, repairs).collect()
    assert sorted((r.row_id, float(r.sales)) for r in layers.read_silver(spark, silver).collect()) == [(1, 5.0), (2, 5.0), (3, 7.0)]
    assert sorted((r.row_id, tuple(r.bad_reasons)) for r in left) == [("1", ("repeated_row_id",)), ("4", ("repeated_row_id",)), ("4", ("repeated_row_id",))]
    # a replay that runs again adds nothing twice
    medallion.replay(spark, silver, bad, repairs)
    assert layers.read_silver(spark, silver).count() == 3


def test_the_csv_is_parsed_once(spark, tmp_path):
    path = write(tmp_path, a=f"{TOP}\n1,A,01-02-2020,02-02-2020,High,,5\n")
    plan = clean.checked(rescue.read_rescued(spark, path, FULL), clean.RULES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_a_filter_on_checked_lines_parses_each_line_once(spark, tmp_path):
    """Pushed below the parsed columns, the filter parsed a line again for each column that its rules ask for."""
    path = write(tmp_path, a="Row ID,Order ID,Product Name,Sales\n1,A,Desk,1\n2,A,Desk,x\n3,A,Desk\n")
    bad = clean.checked(rescue.read_rescued(spark, path, HEADER), {"no_sales": "sales is null"}).filter(F.size("bad_reasons") > 0)
    plan = bad._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 1
    assert sorted(tuple(r.bad_reasons) for r in bad.collect()) == [("malformed_field_count",), ("unreadable_sales", "no_sales")]


def test_replay_joins_the_lines_once_and_exports_packed_text(spark, monkeypatch):
    from datetime import date
    from decimal import Decimal

    from saleslake.plans import clean_queries

    rows = [(o, n, f"part {o}", Decimal(n), date(2020, 1, 1 + n), date(2020, 2, 1 + n), Decimal("1.5") * o) for o in range(1, 40) for n in (1, 2, 3)]
    lines = spark.createDataFrame(rows, "order_id bigint, line_no int, product_name string, quantity decimal(14,2), order_date date, ship_date date, sales decimal(18,4)")
    calls, exports = [], []
    export = clean_queries._export
    monkeypatch.setattr(clean_queries, "order_lines", lambda *a: (calls.append(a), lines)[1])

    def listed(*given):
        path = export(*given)
        exports.extend(spark.read.format("binaryFile").load(path).select("path").collect())
        return path

    monkeypatch.setattr(clean_queries, "_export", listed)
    found = clean_queries.quarantine_replay(spark, "nowhere")
    assert len(calls) == 1 and exports and all(r.path.endswith(".gz") for r in exports)
    whole = {r.row_id for r in clean_queries._exported(spark, "").selectExpr(f"cast({clean_queries._ROW_ID} as int) as row_id").collect()}
    got = [r.row_id for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) <= whole and len(got) > len(whole) / 3
