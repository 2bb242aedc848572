"""CSV / text folder readers and the folder combine."""

from pyspark.sql import functions as F

from tidewater.plans.combine import combine_folder
from tidewater.sources.files import (export_csv, export_text, read_csv_folder_raw,
                                     read_csv_folder_typed, read_text_lines, read_text_whole)


def _folder(spark, scratch):
    a = spark.createDataFrame([(1, "x", 2.5), (2, "y", 3.5)], "id int, name string, amount double")
    b = spark.createDataFrame([("k", 10)], "code string, qty int")
    export_csv(a, scratch, "a.csv", ["id"])
    export_csv(b, scratch, "b.csv", ["code"])
    export_csv(b, scratch, "c.CSV", ["code"])
    export_text(spark.createDataFrame([("line one", 0), ("line two", 1)], "t string, n int"),
                f"{scratch}/txt", "notes.txt", ["n"])
    return scratch


def test_raw_reads_header_as_data_and_pads(spark, scratch):
    d = _folder(spark, scratch)
    rows = sorted(tuple(r) for r in read_csv_folder_raw(spark, d).collect())
    assert rows[0] == ("a.csv", "1", "x", "2.5")
    assert ("b.csv", "code", "qty", None) in rows and len(rows) == 5


def test_typed_aligns_by_name(spark, scratch):
    d = _folder(spark, scratch)
    df = read_csv_folder_typed(spark, d)
    assert set(df.columns) == {"file_name", "id", "name", "amount", "code", "qty"}
    assert dict(df.dtypes)["amount"] == "double" and df.count() == 3


def test_text_whole_and_missing(spark, scratch):
    d = _folder(spark, scratch)
    got = {r.file_name: (r.found, r.content) for r in
           read_text_whole(spark, f"{d}/txt", "notes.txt").union(read_text_whole(spark, f"{d}/txt", "nope.txt"))
           .union(read_text_whole(spark, f"{d}/no_folder", "x.txt")).collect()}
    assert got == {"notes.txt": (True, "line one\nline two\n"), "nope.txt": (False, None), "x.txt": (False, None)}


def test_lines_keep_order(spark, scratch):
    d = _folder(spark, scratch)
    assert [(r.line_no, r.line) for r in read_text_lines(spark, f"{d}/txt/notes.txt").collect()] == \
        [(0, "line one"), (1, "line two")]


def test_combine_writes_one_output_per_csv(spark, scratch):
    d = _folder(spark, scratch)
    out = f"{d}/out"
    combine_folder(spark, d, f"{d}/txt/notes.txt", out)
    back = spark.read.text(out)
    names = sorted(r.out_name for r in back.select("out_name").distinct().collect())
    assert names == ["combined_a.csv", "combined_b.csv"]
    import glob
    import os
    local = out.replace("file:", "")
    parts = sorted(glob.glob(os.path.join(local, "out_name=combined_a.csv", "part-*")))
    text = "".join(open(p).read() for p in parts)
    assert text == "id,name,amount\n1,x,2.5\n2,y,3.5\nline one\nline two\n"


def test_raw_read_never_truncates(spark, scratch):
    import pytest
    d = f"{scratch}/wide"
    spark.createDataFrame([("a,b",), ('1,"x,y"',), ("5",), ("1,2,3,4",)], "v string").coalesce(1) \
        .write.text(d + "/tmp")
    # put the text file in place as a .csv
    from tidewater.sources.files import _single_file
    _single_file(spark, d + "/tmp", d + "/w.csv", ".txt")
    with pytest.raises(Exception):
        read_csv_folder_raw(spark, d, width=2).collect()
    assert read_csv_folder_raw(spark, d).columns == ["file_name", "_c0", "_c1", "_c2", "_c3"]
    rows = sorted(tuple(r) for r in read_csv_folder_raw(spark, d, width=4).collect())
    assert ("w.csv", "1", "2", "3", "4") in rows and ("w.csv", "1", "x,y", None, None) in rows


def test_lines_numbered_across_many_splits(spark, scratch):
    """A file read as several splits keeps its line order and dense numbers."""
    lines = [f"line {i:05d} " + "x" * (i % 50) for i in range(20000)]
    d = f"{scratch}/big"
    local = d.replace("file:", "")
    import os
    os.makedirs(local, exist_ok=True)
    with open(os.path.join(local, "big.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    with open(os.path.join(local, "small.txt"), "w") as f:
        f.write("a\n\nb")
    prev = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = read_text_lines(spark, d)
        assert df.rdd.getNumPartitions() > 4
        got = {}
        for r in df.collect():
            got.setdefault(r.file_name, {})[r.line_no] = r.line
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)
    assert [got["big.txt"][i] for i in range(len(lines))] == lines
    assert got["small.txt"] == {0: "a", 1: "", 2: "b"}


def test_export_csv_split_writes_one_sorted_file_per_residue(spark, scratch):
    from tidewater.sources.files import export_csv_split
    df = spark.createDataFrame([(i, f"n{i}") for i in range(100)], "k long, name string")
    files = export_csv_split(df, scratch, "part", "k", 30)
    assert [f.rsplit("/", 1)[1] for f in files] == ["part_0.csv", "part_1.csv", "part_2.csv", "part_3.csv"]
    lines = read_text_lines(spark, scratch, "part_*.csv").collect()
    by_file = {}
    for r in sorted(lines, key=lambda r: (r.file_name, r.line_no)):
        by_file.setdefault(r.file_name, []).append(r.line)
    assert by_file["part_1.csv"][0] == "k,name"
    assert [int(x.split(",")[0]) for x in by_file["part_1.csv"][1:]] == list(range(1, 100, 4))


def _small_splits(spark):
    """Splits of a few dozen bytes, so that quotes and records lie across their borders."""
    import contextlib

    @contextlib.contextmanager
    def run(size):
        names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
        before = [spark.conf.get(n) for n in names]
        for n in names:
            spark.conf.set(n, str(size))
        try:
            yield
        finally:
            for n, v in zip(names, before, strict=True):
                spark.conf.set(n, v)
    return run


def _write_csv(folder, name, text):
    import os
    local = folder.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    with open(os.path.join(local, name), "w", newline="") as f:
        f.write(text)


def test_quoted_records_are_cut_over_split_borders(spark, scratch):
    import csv
    import io
    import random

    from tidewater.sources.files import read_csv_records
    rng = random.Random(4)
    pieces = ["a", ",", '"', "\n", "\n\n", "x y", "é", '""', ",\n,", "0"]
    want = []
    for name in ("one.csv", "two.csv", "three.csv"):
        out = io.StringIO()
        writer = csv.writer(out, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]), lineterminator=rng.choice(["\n", "\r\n"]))
        for i in range(150):
            row = [f"r{i}"] + ["".join(rng.choices(pieces, k=rng.randrange(6))) for _ in range(rng.randrange(4))]
            writer.writerow(row)
            want.append((name, row))
        _write_csv(scratch, name, out.getvalue())
    for size in (40, 700, 1 << 20):
        with _small_splits(spark)(size):
            records = read_csv_records(spark, scratch)
            got = [(r.file_name, list(r.fields)) for r in records.collect()]
            if size == 40:
                assert spark.read.text(scratch).rdd.getNumPartitions() > 20
        assert sorted(got) == sorted(want), size


def test_quotes_inside_a_field_are_text(spark, scratch):
    from tidewater.sources.files import read_csv_records
    _write_csv(scratch, "odd.csv", 'a,5" pipe,c\n"x ""y"" z",1\n\n"two\nlines","b"tail\nlast,"q"\r\n,,\n"open to the\nend')
    want = [["a", '5" pipe', "c"], ['x "y" z', "1"], ["two\nlines", '"b"tail'], ["last", "q"], ["", "", ""], ['"open to the\nend']]
    for size in (8, 1 << 20):
        with _small_splits(spark)(size):
            assert sorted(list(r.fields) for r in read_csv_records(spark, scratch).collect()) == sorted(want)


def test_types_are_the_narrowest_that_hold_all_values(spark, scratch):
    import datetime as dt
    import decimal
    _write_csv(scratch, "a.csv", "i,l,d,when,day,b,t,none,dup,dup,\n1,5,1.5,2024-01-02,2024-01-02,true,x,,1,2,3\n"
                                 '-2,6,7,2024-01-03 10:00:00,2024-02-29,FALSE,"",,,,\n')
    _write_csv(scratch, "b.csv", "L,D,big,t,extra\n99999999999,1e3,123456789012345678901,2024-13-45,NaN\n,,7,1\n1,2,3,4,5,6\n")
    df = read_csv_folder_typed(spark, scratch)
    assert dict(df.dtypes) == {"file_name": "string", "i": "int", "l": "bigint", "d": "double", "when": "timestamp", "day": "date",
                               "b": "boolean", "t": "string", "none": "string", "dup8": "int", "dup9": "int", "_c10": "int",
                               "big": "decimal(38,0)", "extra": "double"}
    assert df.columns[:4] == ["file_name", "i", "l", "d"] and df.columns[-2:] == ["big", "extra"]
    rows = {(r.file_name, r.i, r.l): r for r in df.collect()}
    assert rows["a.csv", -2, 6].t == "" and rows["a.csv", 1, 5].none is None
    assert rows["a.csv", -2, 6].when == dt.datetime(2024, 1, 3, 10) and rows["a.csv", 1, 5].when == dt.datetime(2024, 1, 2)
    assert rows["b.csv", None, 99999999999].big == decimal.Decimal("123456789012345678901")
    assert rows["b.csv", None, None].t == "1" and rows["b.csv", None, None].extra is None and len(rows) == 5


def test_headers_only_and_empty_files(spark, scratch):
    _write_csv(scratch, "a.csv", "x,y\n")
    _write_csv(scratch, "b.csv", "")
    _write_csv(scratch, "c.csv", "\n\ny,z\n\n1,2\n")
    df = read_csv_folder_typed(spark, scratch)
    assert dict(df.dtypes) == {"file_name": "string", "x": "string", "y": "int", "z": "int"}
    assert [tuple(r) for r in df.collect()] == [("c.csv", None, 1, 2)]
    assert read_csv_folder_raw(spark, scratch).count() == 3


def test_typed_read_brings_no_file_to_one_task(spark, scratch):
    _write_csv(scratch, "a.csv", "x,y\n" + "".join(f"{i},{i}.5\n" for i in range(3000)))
    _write_csv(scratch, "b.csv", "Y,z\n1,2024-01-02\n")
    with _small_splits(spark)(4096):
        df = read_csv_folder_typed(spark, scratch)
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        plan = df._jdf.queryExecution().toString()
        assert sum(sizes) == 3001 and len(sizes) > 4 and max(sizes) < 1500
    assert "SortMergeJoin" not in plan
    assert dict(df.dtypes) == {"file_name": "string", "x": "int", "y": "double", "z": "date"}
