"""Every refusal has its class, names the column, and does not fire on good input."""

import pytest
from pyspark.sql import functions as F

from holdfast import config
from holdfast.errors import ColumnTypeError, DataNotFoundError, MissingColumnsError, SchemaError, ValueRangeError
from holdfast.operators.contract import HOUSING, check_log_domain
from holdfast.sources.csv import load_raw, read_csv, resolve_csv


def test_good_table_passes_unchanged(house):
    assert HOUSING.validate(house) is house


def test_column_order():
    names = HOUSING.expected_columns()
    assert names == [*config.NUMERIC_COLUMNS, config.TARGET, "ocean_proximity"]
    assert config.TARGET not in HOUSING.expected_columns(require_target=False)


@pytest.mark.parametrize("column", ["median_income", "households", "latitude"])
def test_missing_column_is_named(house, column):
    with pytest.raises(MissingColumnsError, match=column):
        HOUSING.validate(house.drop(column))


def test_wrong_type_is_named(house):
    with pytest.raises(ColumnTypeError, match="total_rooms"):
        HOUSING.validate(house.withColumn("total_rooms", F.lit("many")))
    with pytest.raises(ColumnTypeError, match="ocean_proximity"):
        HOUSING.validate(house.withColumn("ocean_proximity", F.lit(1)))


def test_out_of_range_is_counted_and_shown(house):
    bad = house.withColumn("latitude", F.when(F.col("id") == 7, 45.6).otherwise(F.col("latitude")))
    with pytest.raises(ValueRangeError, match=r"latitude: 1 row.*45\.6"):
        HOUSING.validate(bad)


def test_nulls_are_in_range(house):
    assert HOUSING.violations(house.withColumn("total_rooms", F.lit(None).cast("double"))).count() == 0


def test_missing_is_reported_before_type_and_type_before_range(house):
    bad = house.withColumn("latitude", F.lit(99.0)).withColumn("total_rooms", F.lit("x"))
    with pytest.raises(ColumnTypeError):
        HOUSING.validate(bad)
    with pytest.raises(MissingColumnsError):
        HOUSING.validate(bad.drop("median_income"))


def test_scoring_request_needs_no_target(house):
    HOUSING.validate(house.drop(config.TARGET), require_target=False)
    with pytest.raises(MissingColumnsError):
        HOUSING.validate(house.drop(config.TARGET))


def test_one_family_of_three():
    kinds = (MissingColumnsError, ColumnTypeError, ValueRangeError)
    assert all(issubclass(k, SchemaError) for k in kinds)
    assert not any(issubclass(a, b) for a in kinds for b in kinds if a is not b)
    assert not issubclass(DataNotFoundError, SchemaError)


def test_log_domain(house):
    found = {r["column"]: r for r in check_log_domain(house, ["longitude", "population"]).collect()}
    assert set(found) == {"longitude"} and found["longitude"]["n_bad"] == house.count()


def write(df, path):
    df.select(*config.SCHEMA.fieldNames()).write.csv(str(path), header=True)
    return str(path)


def test_csv_round_trip(spark, house, tmp_path):
    df = load_raw(spark, write(house, tmp_path / "housing.csv"))
    assert df.schema == config.SCHEMA
    assert df.exceptAll(house.select(*df.columns)).count() == 0


def test_csv_with_text_in_a_number_column_names_it(spark, house, tmp_path):
    bad = house.withColumn("population", F.when(F.col("id") == 1, "1,200").otherwise(F.col("population").cast("string")))
    with pytest.raises(ColumnTypeError, match="population"):
        load_raw(spark, write(bad, tmp_path / "housing.csv"))


def test_csv_without_a_column_is_a_missing_column(spark, house, tmp_path):
    path = str(tmp_path / "x.csv")
    house.select("longitude", "latitude").write.csv(path, header=True)
    with pytest.raises(MissingColumnsError, match="median_income"):
        load_raw(spark, path)


def test_resolution_order(spark, house, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    monkeypatch.delenv(config.CSV_ENV_VAR, raising=False)
    with pytest.raises(DataNotFoundError, match="housing.csv"):
        resolve_csv(spark, search=[str(tmp_path)])
    house.limit(3).toPandas().to_csv(tmp_path / "housing.csv", index=False)
    deep = tmp_path / "a" / "b"
    deep.mkdir(parents=True)
    (tmp_path / "housing.csv").rename(deep / "housing.csv")
    assert resolve_csv(spark, search=[str(tmp_path)]).endswith("a/b/housing.csv")
    monkeypatch.setenv(config.CSV_ENV_VAR, str(deep / "housing.csv"))
    assert resolve_csv(spark) == str(deep / "housing.csv")
    with pytest.raises(DataNotFoundError, match="nowhere"):
        resolve_csv(spark, str(tmp_path / "nowhere.csv"))


def _housing_csv(folder, name="a.csv", header=None, rows=None):
    from holdfast import config

    columns = header or [f.name for f in config.SCHEMA]
    good = ["-120", "35", "20", "100", "20", "50", "10", "3", "100000", "INLAND"]
    (folder / name).write_text("\n".join(",".join(r) for r in [columns, *(rows or [good])]) + "\n")
    return good


@pytest.mark.parametrize("checked", [True, False])
@pytest.mark.parametrize("change", [lambda row: [*row, "1", "2"], lambda row: row[:-3]])
def test_rows_with_another_number_of_fields_are_refused(spark, tmp_path, checked, change):
    good = _housing_csv(tmp_path)
    _housing_csv(tmp_path, rows=[good, change(good)])
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, str(tmp_path / "a.csv"), checked=checked).collect()


def test_a_file_with_another_header_is_refused(spark, tmp_path):
    from holdfast import config

    names = [f.name for f in config.SCHEMA]
    _housing_csv(tmp_path)
    names[3], names[4] = names[4], names[3]
    _housing_csv(tmp_path, "b.csv", header=names)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("checked", [True, False])
def test_spellings_of_a_missing_value(spark, tmp_path, checked):
    good = _housing_csv(tmp_path)
    rows = [[*good[:4], spelling, *good[5:]] for spelling in ("NA", "N/A", "null", "nan", "")]
    _housing_csv(tmp_path, rows=rows)
    found = read_csv(spark, str(tmp_path / "a.csv"), checked=checked).select("total_bedrooms", "total_rooms").collect()
    assert [tuple(r) for r in found] == [(None, 100.0)] * 5
