"""Every landed line is a good row or quarantined with a reason."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lucrum.sources.bronze import read_checked, read_jsonl

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.StringType()), T.StructField("at", T.TimestampNTZType()),
                       T.StructField("items", T.ArrayType(T.StructType([T.StructField("n", T.IntegerType())])))])
LINES = ['{"id":1,"x":"a","items":[{"n":1}]}', '{"id":2,"x":"b"', '{"id":"two"}', '{"id":3,"items":[{"n":"z"}]}', "[1,2]", '"text"', "7", "oops",
         "", "   ", '{"id":4,"extra":{"deep":[1,2]},"more":null}', "{}", '{"id":5,"x":null}', '{"id":1.5}', '{"id":99999999999999999999}',
         ' {"id":6,"x":7}', '{"id":8,"at":"2026-01-02T03:04:05.000006"}', '{"id":9,"at":"yesterday"}', '{"id":10,"é":"ü"}']
WHY = {'{"id":2,"x":"b"': "broken", '{"id":"two"}': "mistyped", '{"id":3,"items":[{"n":"z"}]}': "mistyped", "[1,2]": "not_object",
       '"text"': "not_object", "7": "not_object", "oops": "broken", '{"id":1.5}': "mistyped", '{"id":99999999999999999999}': "mistyped",
       '{"id":9,"at":"yesterday"}': "mistyped"}


@pytest.fixture()
def root(tmp_path):
    day = tmp_path / "bronze" / "year=2026" / "month=01" / "day=02"
    day.mkdir(parents=True)
    (day / "a.jsonl").write_text("\n".join(LINES[:9]) + "\n")
    (day / "b.jsonl").write_text("\n".join(LINES[9:]))
    return str(tmp_path / "bronze")


def test_every_line_comes_back_once(spark, root):
    good, bad = read_checked(spark, root, SCHEMA)
    assert {r.line: r.reason for r in bad.collect()} == WHY
    rows = {r.id: r for r in good.select("*", F.to_json("_unknown").alias("u")).collect()}
    assert good.count() + bad.count() == len([x for x in LINES if x.strip()])
    assert set(rows) == {1, 4, None, 5, 6, 8, 10}
    assert rows[1]["items"][0].n == 1 and rows[6].x == "7" and rows[8].at.microsecond == 6
    assert rows[4].u == '{"extra":{"deep":[1,2]},"more":null}' and rows[10].u == '{"é":"ü"}' and rows[1].u is None
    assert {(r.year, r.month, r.day) for r in bad.collect()} == {("2026", "01", "02")}
    assert bad.where("file_path like '%a.jsonl'").count() == 7


def test_quarantined_json_can_be_repaired_from_its_document(spark, root):
    _, bad = read_checked(spark, root, SCHEMA)
    docs = {r.line: r.id for r in bad.select("line", F.try_variant_get("document", "$.id", "string").alias("id")).collect()}
    assert docs['{"id":"two"}'] == "two" and docs['{"id":9,"at":"yesterday"}'] == "9" and docs["oops"] is None


def test_unknown_fields_can_be_quarantined(spark, root):
    good, bad = read_checked(spark, root, SCHEMA, unknown="quarantine")
    assert {r.line for r in bad.where("reason = 'unknown_fields'").collect()} == {LINES[10], LINES[-1]}
    assert good.count() + bad.count() == 17
    with pytest.raises(ValueError):
        read_checked(spark, root, SCHEMA, unknown="drop")


def test_good_rows_equal_the_plain_reader_on_good_lines(spark, tmp_path):
    day = tmp_path / "b" / "year=2026" / "month=01" / "day=02"
    day.mkdir(parents=True)
    (day / "a.json").write_text("\n".join(x for x in LINES if x.strip() and x not in WHY))
    good, bad = read_checked(spark, str(tmp_path / "b"), SCHEMA)
    plain = read_jsonl(spark, str(tmp_path / "b"), SCHEMA)
    assert bad.count() == 0
    assert sorted(map(str, good.drop("_unknown").collect())) == sorted(map(str, plain.select(*good.drop("_unknown").columns).collect()))


def test_no_files_of_the_pattern(spark, root):
    good, bad = read_checked(spark, root, SCHEMA, file_glob="*.none")
    assert good.count() == bad.count() == 0
