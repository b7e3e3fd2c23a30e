"""Rows with line breaks in quotes, against Spark's reader that takes a file whole."""

import random

import pytest

from fleetlake import jobs
from fleetlake.sources import csv
from fleetlake.sources.records import read_records


def awkward(rng, n, end="\n"):
    fields = [
        "plain", "", '""', '"a,b"', '"one\ntwo"', '"\n"', '"say ""hi"""', '""""', '"""\n"""', "it\"s", 'x"y"z',
        '"\n\n\n"', '", "', '"ends ""\n"', '"é\n中文,😀"', " padded ", '"""",', "5\" pipe",
    ]
    fields = [f.rstrip(",") for f in fields]
    rows = [",".join([str(i), rng.choice(fields), rng.choice(fields), rng.choice(fields)]) for i in range(n)]
    return end.join(["id,a,b,c", *rows, ""])


def by_spark(spark, path, **options):
    schema = "id string, a string, b string, c string"
    return spark.read.schema(schema).options(**csv._FORMAT, multiLine=True, **options).csv(path)


@pytest.fixture
def small_ranges(spark):
    """Files are cut into ranges of at most so many bytes."""
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield cut
    spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", [37, 300, 1 << 20])
def test_rows_equal_those_of_a_whole_file(spark, tmp_path, small_ranges, size):
    path = str(tmp_path / "x.csv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(awkward(random.Random(size), 150))
    small_ranges(size)
    df = csv.read_text(spark, path, multi_line=True)
    expected = sorted(map(tuple, by_spark(spark, path).collect()), key=str)
    assert len(expected) == 150
    assert sorted(map(tuple, df.collect()), key=str) == expected
    assert size > 1000 or read_records(spark, path).select("file").count() == 150
    ranges = spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions()
    assert size > 1000 or ranges > 1
    assert sorted(r["id"] for r in csv.read_source(spark, path, multi_line=True).collect()) == sorted(
        r[0] for r in expected
    )


def test_carriage_returns_blank_lines_and_no_last_break(spark, tmp_path, small_ranges):
    path = str(tmp_path / "x.csv")
    text = awkward(random.Random(5), 60).replace("\n", "\r\n")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text + '\r\n  \r\n60,"q\r\nr",s,"t"')
    small_ranges(200)
    found = sorted(map(tuple, csv.read_text(spark, path, multi_line=True).collect()), key=str)
    assert len(found) == 61 and ("60", "q\nr", "s", "t") in found
    assert not any("\r" in (v or "") for row in found for v in row)


def test_several_files_each_with_its_header(spark, tmp_path, small_ranges):
    directory = tmp_path / "x.csv"
    directory.mkdir()
    for k in range(3):
        (directory / f"part-{k}.csv").write_text(awkward(random.Random(k), 30), encoding="utf-8")
    small_ranges(100)
    path = str(directory)
    found = sorted(map(tuple, csv.read_text(spark, path, multi_line=True).collect()), key=str)
    assert found == sorted(map(tuple, by_spark(spark, path).collect()), key=str) and len(found) == 90


def test_a_header_alone_and_wrong_rows(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a,b\n")
    assert csv.read_text(spark, str(path), multi_line=True).collect() == []
    path.write_text('a,b\n"1\n2",3,4\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        csv.read_text(spark, str(path), multi_line=True).collect()
    with pytest.raises(Exception, match="more fields"):
        csv.read_source(spark, str(path), multi_line=True).count()
    path.write_text('a,b\n"1,2\n' + "x,y\n" * 20)
    with pytest.raises(Exception, match="not closed"):
        read_records(spark, str(path), most_lines=10).collect()


def test_jobs_take_line_breaks(spark, tmp_path):
    head = "payment_id,rental_id,payment_date,payment_method,amount,payment_type,status\n"
    (tmp_path / "payments.csv").write_text(head + '1,2,2024-05-01,"Card\nor cash",1.5,"Re\n\nntal",Done\n')
    lake = str(tmp_path / "lake")
    rows = jobs.load_raw(spark, str(tmp_path), lake, on_missing="empty", multi_line=True)
    assert rows["payments"] == 1
    found = jobs.Layer(spark, lake, "raw").table("payments").first()
    assert found["payment_method"] == "Card\nor cash" and found["payment_type"] == "Re\n\nntal"
    assert str(found["amount"]) == "1.50"
