"""Rename / select / coercions (the original unit cases, as result checks)."""

import pytest

from tidewater.functions.coerce import fill_missing, nan_to_null, try_number, try_timestamp
from tidewater.operators.rename import rename_columns, select_mapped
from tidewater.spec import MigrationSpec


def test_rename_keeps_unmapped_and_order(spark):
    df = spark.createDataFrame([(1, "x", True), (2, "y", False)], "col_a long, col_b string, extra_col boolean")
    out = rename_columns(df, {"col_a": "new_a", "col_b": "new_b"})
    assert out.columns == ["new_a", "new_b", "extra_col"]
    assert [tuple(r) for r in out.collect()] == [(1, "x", True), (2, "y", False)]


def test_rename_no_mapping_is_identity(spark):
    df = spark.createDataFrame([(1, "x")], "col_a long, col_b string")
    assert rename_columns(df, {}).columns == ["col_a", "col_b"]


def test_rename_ignores_absent_source_columns(spark):
    df = spark.createDataFrame([(1,), (2,)], "col_a long")
    assert rename_columns(df, {"col_a": "new_a", "col_b": "new_b"}).columns == ["new_a"]


def test_rename_is_simultaneous_and_case_insensitive(spark):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    out = rename_columns(df, {"A": "b", "b": "a"})
    assert out.columns == ["b", "a"] and tuple(out.first()) == (1, 2)


def test_rename_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    with pytest.raises(ValueError):
        rename_columns(df, {"a": "b"})


def test_select_mapped(spark):
    df = spark.createDataFrame([(1, "x", True)], "col_a long, col_b string, extra_col boolean")
    assert select_mapped(df, {"col_b": "nb"}).columns == ["nb"]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(1, 10.5), (2, float("nan")), (3, None)], "id long, value double")
    out = {r["id"]: r["value"] for r in nan_to_null(df).collect()}
    assert out == {1: 10.5, 2: None, 3: None}


def test_try_number_and_timestamp(spark):
    df = spark.createDataFrame([("12.5",), ("abc",), ("NaN",), (None,)], "s string")
    assert [r[0] for r in df.select(try_number("s")).collect()] == [12.5, None, None, None]
    t = spark.createDataFrame([("2024-03-10T12:00:00Z",), ("nope",)], "s string")
    got = [r[0] for r in t.select(try_timestamp("s").cast("string")).collect()]
    assert got == ["2024-03-10 12:00:00", None]


def test_fill_missing(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", float("nan"))], "id long, s string, d double")
    out = {r["id"]: (r["s"], r["d"]) for r in fill_missing(df, {"s": "?", "d": 0.0}).collect()}
    assert out == {1: ("?", 0.0), 2: ("a", 0.0)}


def test_settings_routing():
    settings = {
        "ora_emp": "mysql_staff", "ora_dept": "mysql_departments",
        "ora_emp.emp_id": "mysql_staff.staff_id", "ora_emp.hire_date": "mysql_staff.start_date",
        "ora_dept.dept_no": "mysql_departments.id", "ora_emp.incremental_column": "LAST_UPDATED",
        "chunk_size": "5000", "state_file_path": "state/hwm",
    }
    spec = MigrationSpec.from_settings(settings, source_root="/src", target_root="/tgt")
    by = {t.source: t for t in spec.tables}
    assert set(by) == {"ora_emp", "ora_dept"}
    assert by["ora_emp"].target == "mysql_staff"
    assert dict(by["ora_emp"].columns) == {"emp_id": "staff_id", "hire_date": "start_date"}
    assert by["ora_emp"].incremental_column == "LAST_UPDATED"
    assert by["ora_dept"].incremental_column is None
    assert by["ora_emp"].chunk_size == 5000
    assert spec.state_path == "state/hwm"


def test_settings_without_tables():
    spec = MigrationSpec.from_settings({}, source_root="/s", target_root="/t")
    assert spec.tables == () and spec.state_path == "/t/_control"


def test_settings_without_chunk_size_read_one_range():
    spec = MigrationSpec.from_settings({"a": "b"}, source_root="/s", target_root="/t")
    assert spec.tables[0].chunk_size is None


def test_settings_from_ini(tmp_path):
    from tidewater.spec import settings_from_ini
    ini = tmp_path / "db.ini"
    ini.write_text("[mysql]\nport = 3306\n[migration]\nora_emp = mysql_staff\nchunk_size = 5000\n"
                   "ORA_EMP.EMP_ID = mysql_staff.staff_id\n")
    s = settings_from_ini(str(ini))
    assert s == {"ora_emp": "mysql_staff", "chunk_size": "5000", "ora_emp.emp_id": "mysql_staff.staff_id"}
    spec = MigrationSpec.from_settings(s, source_root="/s", target_root="/t")
    assert spec.tables[0].chunk_size == 5000 and dict(spec.tables[0].columns) == {"emp_id": "staff_id"}
    with pytest.raises(FileNotFoundError):
        settings_from_ini(str(tmp_path / "missing.ini"))


def test_measure_rows_and_bytes(spark):
    from tidewater.functions.size import fits_broadcast, measure
    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "é")], "id long, s string")
    assert measure(df) == (3, 3 * 8 + 3 + 0 + 2)
    assert fits_broadcast(df, 3) and not fits_broadcast(df, 2) and not fits_broadcast(df, 3, max_bytes=10)
