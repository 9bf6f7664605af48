"""Reading text extracts and writing JSON."""

import csv
import json
from datetime import date, datetime
from decimal import Decimal

import pytest

from dealmill.session import checkpoint_dir
from dealmill.sources.extracts import read_extract
from dealmill.sources.records import lines
from dealmill.sources.json_out import to_json_rows, write_json_rows


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def cells(df):
    return [tuple(r)[1:] for r in df.orderBy("id").collect()]


@pytest.mark.parametrize("multi_line", [True, False, "auto"])
@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig"])
def test_cells_stay_text(spark, tmp_path, multi_line, encoding):
    path = write(
        tmp_path / "c.csv",
        'company_id,name,inn,city,industry,created_at\r\n'
        'C1,"Альфа, ""ООО""",0278123456, Уфа ,"",2026-06-01\r\n'
        'C2,"  ",,,\r\n',
        encoding,
    )
    assert cells(read_extract(spark, "companies", path, multi_line)) == [
        ("C1", 'Альфа, "ООО"', "0278123456", " Уфа ", None, "2026-06-01"),
        ("C2", "  ", None, None, None, None),
    ]


def test_line_breaks_in_quotes_are_noticed(spark, tmp_path):
    path = write(tmp_path / "c.csv", 'company_id,name\nC1,"one\ntwo"\nC2,three\n')
    assert [r[:2] for r in cells(read_extract(spark, "companies", path))] == [("C1", "one\ntwo"), ("C2", "three")]


def test_columns_are_matched_by_name(spark, tmp_path):
    path = write(tmp_path / "u.csv", "name,user_id\nИван,U1\n")
    assert cells(read_extract(spark, "users", path)) == [("U1", "Иван", None, None, None, None)]


def test_unknown_columns_are_an_error(spark, tmp_path):
    path = write(tmp_path / "u.csv", "user_id,password\nU1,x\n")
    with pytest.raises(ValueError, match="password"):
        read_extract(spark, "users", path)


@pytest.mark.parametrize("multi_line", [True, False])
def test_rows_wider_than_the_header_are_an_error(spark, tmp_path, multi_line):
    path = write(tmp_path / "short.csv", 'source,campaign\nads\n"a,""b",2024-01\n')
    df = read_extract(spark, "marketing_costs", path, multi_line)
    assert df.count() == 2
    assert [(r["source"], r["campaign"]) for r in df.collect()] == [("ads", None), ('a,"b', "2024-01")]
    for row in ("ads,2024-01,EXTRA", "ads,2024-01,", '"a,b",2024-01,"x"'):
        path = write(tmp_path / "wide.csv", f"source,campaign\n{row}\n")
        with pytest.raises(Exception, match="table marketing_costs: row wider than the header"):
            read_extract(spark, "marketing_costs", path, multi_line).collect()


def test_folders_and_missing_files(spark, tmp_path):
    folder = tmp_path / "users"
    folder.mkdir()
    write(folder / "a.csv", "user_id,name\nU1,A\n")
    write(folder / "b.csv", "user_id,name\nU2,B\n")
    df = read_extract(spark, "users", str(folder))
    assert {r["user_id"] for r in df.collect()} == {"U1", "U2"} and df.select("id").distinct().count() == 2
    with pytest.raises(FileNotFoundError):
        read_extract(spark, "users", str(tmp_path / "none.csv"))


def test_json_rows(spark, tmp_path):
    df = spark.createDataFrame(
        [
            ("a", Decimal("126000.00"), date(2026, 6, 15), datetime(2026, 6, 8, 16, 45), 3, None),
            ("b", None, None, datetime(2026, 6, 8, 16, 45, 0, 250000), None, True),
        ],
        "k string, m decimal(14,2), d date, t timestamp, n int, f boolean",
    ).coalesce(1)
    want = [
        {"k": "a", "m": "126000.00", "d": "2026-06-15", "t": "2026-06-08T16:45:00+00:00", "n": 3, "f": None},
        {"k": "b", "m": None, "d": None, "t": "2026-06-08T16:45:00.250000+00:00", "n": None, "f": True},
    ]
    lines = [r["json"] for r in to_json_rows(df).collect()]
    assert [json.loads(line) for line in lines] == want
    assert list(json.loads(lines[0])) == ["k", "m", "d", "t", "n", "f"]
    write_json_rows(df, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 2


AWKWARD = [
    ["C1", "one\ntwo", "", ' 5" pipe ', None, "2026"], ["C2", 'a ""b"" "', "x,y", "", "", ""], ["C3", "\n\n", '"', "end", "", "1"],
    ["C4", "crlf\r\nkept", "z", "", "", ""], ["C5", "plain", "5\" bare", "q\"\"q", "", ""], ["C6", "Ж" * 50, "", "", "last\n", ""],
]


def _csv_text(rows, end="\n"):
    """Rows as CSV; fields with line breaks, commas or a quote in front are quoted, others stay bare, quotes and all."""
    def field(value):
        value = value or ""
        quoted = any(c in value for c in "\r\n,") or value.startswith('"')
        return '"' + value.replace('"', '""') + '"' if quoted else value

    return "".join(",".join(map(field, row)) + end for row in rows)


@pytest.mark.parametrize("split", [7, 64, 1000, 10**7])
def test_records_and_ids_do_not_depend_on_splits(spark, tmp_path, split):
    """Three files of records with line breaks, read in splits of a few bytes, against Python's csv reader."""
    header = ["company_id", "name", "inn", "city", "industry", "created_at"]
    want = []
    for name, copies in (("b", 3), ("a", 1), ("c", 2)):
        path = tmp_path / f"{name}.csv"
        path.write_bytes(("﻿" * (name == "b") + _csv_text([header, *AWKWARD * copies]) + "\n \n" * (name == "a")).encode())
    for name in "abc":
        with open(tmp_path / f"{name}.csv", encoding="utf-8-sig", newline="") as file:
            rows = list(csv.reader(file))[1:]
        want += [tuple(v or None for v in row) for row in rows if len(row) == 6]
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = read_extract(spark, "companies", str(tmp_path))
        got = df.orderBy("id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [tuple(r)[1:] for r in got] == want
    assert [r["id"] for r in got] == list(range(1, len(want) + 1))


@pytest.mark.parametrize("split", [11, 300, 10**7])
def test_ids_follow_files_when_lines_are_records(spark, tmp_path, split):
    for name, first in (("2", 100), ("1", 0), ("3", 200)):
        rows = "".join(f"U{i},name {i}\n" + "\n" * (i % 3 == 0) for i in range(first, first + 40 + first // 10))
        write(tmp_path / f"{name}.csv", "user_id,name\n" + rows)
    write(tmp_path / "4.csv", "user_id,name\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = read_extract(spark, "users", str(tmp_path)).orderBy("id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    numbers = [*range(40), *range(100, 150), *range(200, 260)]
    assert [(r["id"], r["user_id"]) for r in got] == [(i, f"U{n}") for i, n in enumerate(numbers, 1)]


def test_every_line_is_a_function_of_the_state_before(spark, tmp_path):
    """A line that both opens and closes, one that fixes the state, one that flips it."""
    cases = {'a,b': (False, True), '"a,b': (True, False), 'a"b': (False, False), '"a""b"': (False, False), 'x,"y': (True, True), '","': (False, True), '"""': (True, False)}
    path = write(tmp_path / "x.csv", "\n".join(cases) + "\n")
    got = {r["value"]: (r["from_out"], r["from_in"]) for r in lines(spark, path).collect()}

    def run(text, state):  # a plain state machine
        fresh = True  # at the start of a field, or right after a closing quote
        for c in text:
            if state:
                if c == '"':
                    state, fresh = False, True
                continue
            if c == '"' and fresh:
                state = True
            fresh = c == ","
        return state

    assert got == {t: (run(t, False), run(t, True)) for t in cases}


def test_other_headers_and_open_quotes(spark, tmp_path):
    write(tmp_path / "a.csv", 'user_id,name\nU1,"a\nb"\n')
    write(tmp_path / "b.csv", 'user_id,name\nU2,"never\nclosed\n')
    assert cells(read_extract(spark, "users", str(tmp_path)))[1][:2] == ("U2", "never\nclosed")
    write(tmp_path / "c.csv", "name,user_id\nx,U3\n")
    with pytest.raises(Exception, match="header differs"):
        read_extract(spark, "users", str(tmp_path)).collect()


class _Session:
    """What ``checkpoint_dir`` asks a session for."""

    def __init__(self, master, **conf):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": lambda _, key, default=None: conf.get(key, default), "set": lambda _, key, value: conf.update({key: value})})()


@pytest.mark.parametrize(
    ("master", "conf", "want"),
    [
        ("yarn", {"spark.checkpoint.dir": "hdfs:///c"}, "hdfs:///c"),
        ("yarn", {"spark.sql.warehouse.dir": "hdfs://n/w/"}, "hdfs://n/w/_work"),
        ("yarn", {"spark.sql.warehouse.dir": "file:/home/w"}, None),
        ("spark://m:7077", {"spark.sql.warehouse.dir": "/home/w"}, None),
        ("local[8]", {"spark.sql.warehouse.dir": "file:/home/w"}, "file:/home/w/_work"),
    ],
)
def test_work_folder_is_shared(master, conf, want):
    if want is None:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            checkpoint_dir(_Session(master, **conf))
    else:
        assert checkpoint_dir(_Session(master, **conf)) == want
