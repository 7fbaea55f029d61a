import os

import pytest

from creditframe.operators import sampling
from creditframe.sources import files, layouts, sinks


def line(fields, **given):
    return "|".join(given.get(name, "") for name in fields)


def write(folder, name, lines):
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture
def folder(tmp_path):
    loans = [
        line(layouts.ORIGINATION_FIELDS, loan_sequence_number="F05Q10000001", credit_score="700", first_payment_date="200503", orig_upb="100000"),
        line(layouts.ORIGINATION_FIELDS, loan_sequence_number="F05Q10000002", credit_score="abc", first_payment_date="200601"),
        "too|few|fields",
        line(layouts.ORIGINATION_FIELDS, loan_sequence_number="F05Q10000003") + "|extra",
    ]
    perf = [
        line(layouts.PERFORMANCE_FIELDS, loan_sequence_number="F05Q10000001", monthly_reporting_period="200504", current_delinquency_status="RA", loan_age="1"),
        "broken",
    ]
    write(tmp_path, "sample_orig_2005.txt", loans)
    write(tmp_path, "sample_svcg_2005.txt", perf)
    return str(tmp_path)


def test_rows_with_a_wrong_field_count_are_left_out_whatever_is_read(spark, folder):
    raw = files.read_raw_loans(spark, folder)
    assert raw.count() == 2
    assert raw.select("loan_sequence_number").count() == 2
    assert len(raw.select("credit_score", "msa").collect()) == 2


def test_types_and_bad_values(spark, folder):
    rows = {r.loan_sequence_number: r for r in files.read_loans(spark, folder).collect()}
    assert rows["F05Q10000001"].credit_score == 700 and rows["F05Q10000001"].orig_upb == 100000.0
    assert rows["F05Q10000002"].credit_score is None and rows["F05Q10000002"].orig_upb is None
    assert rows["F05Q10000002"].vintage_year == 2006
    perf = files.read_performance(spark, folder).collect()
    assert len(perf) == 1 and perf[0].current_delinquency_status == "RA" and perf[0].zero_balance_code is None
    assert len(perf[0]) == 10


@pytest.mark.parametrize(
    "names, layout",
    [
        (["sample_orig_2005.txt", "historical_data_time_2005Q1.txt"], "sample"),
        (["historical_data_2005Q1.txt", "historical_data_time_2005Q1.txt"], "quarterly"),
        (["historical_data_2005.txt", "historical_data_time_2005.txt"], "standard"),
        (["readme.txt"], "quarterly"),
    ],
)
def test_layout_detection(spark, tmp_path, names, layout):
    for name in names:
        write(tmp_path, name, ["x"])
    assert files.detect_layout(spark, str(tmp_path)) == layout


def test_loan_pattern_skips_performance_files(spark, tmp_path):
    one = line(layouts.ORIGINATION_FIELDS, loan_sequence_number="F05Q10000001")
    write(tmp_path, "historical_data_2005Q1.txt", [one])
    write(tmp_path, "historical_data_time_2005Q1.txt", [line(layouts.PERFORMANCE_FIELDS, loan_sequence_number="F05Q10000001")] * 3)
    assert files.read_raw_loans(spark, str(tmp_path)).count() == 1
    assert files.read_raw_performance(spark, str(tmp_path)).count() == 3


def test_sampling_keeps_whole_histories(spark):
    loans = spark.range(2000).selectExpr("concat('F05Q1', lpad(string(id), 7, '0')) AS k")
    months = loans.selectExpr("k", "explode(sequence(1, 3)) AS m")
    kept = sampling.sample_by_key(loans, "k", 0.2)
    rows = sampling.sample_by_key(months, "k", 0.2)
    assert 300 < kept.count() < 500
    assert rows.count() == 3 * kept.count()
    assert sampling.keep_keys(months, kept, "k").exceptAll(rows).count() == 0
    assert sampling.first_n_by_hash(loans, "k", 10).collect() == sampling.first_n_by_hash(loans.repartition(3), "k", 10).collect()


def test_a_hot_key_is_spread_and_no_row_is_lost(spark):
    rows = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id % 500 END AS k", "id % 7 AS v")
    keys = spark.range(0, 100).selectExpr("id - 1 AS k").union(spark.range(0, 100).selectExpr("id - 1 AS k"))
    kept = sampling.keep_keys(rows, keys, "k")
    assert "_spread" in kept._jdf.queryExecution().optimizedPlan().toString() and kept.columns == ["k", "v"]
    expected = rows.where("k < 99")
    assert kept.count() == expected.count() and kept.exceptAll(expected).count() == 0


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_sinks(spark, tmp_path, fmt):
    df = spark.createDataFrame([("F05Q10000001", 1), ("F17Q20000002", 2)], "loan_sequence_number string, x int")
    sinks.write_marts({"a": df}, str(tmp_path), fmt)
    back = spark.read.schema(df.schema).option("header", "true").format(fmt).load(f"{tmp_path}/a")
    assert sorted(back.collect()) == sorted(df.collect())


def test_small_facts_file(spark, tmp_path):
    write(tmp_path, "macro.csv", ["quarter,hpi", "2005Q1,100.5", "2005Q2,"])
    rows = files.read_facts(spark, str(tmp_path / "macro.csv"), "quarter string, hpi double").collect()
    assert [(r.quarter, r.hpi) for r in rows] == [("2005Q1", 100.5), ("2005Q2", None)]


def test_vintage_folders_prune(spark, tmp_path):
    df = spark.createDataFrame([("F05Q10000001", 1), ("F17Q20000002", 2)], "loan_sequence_number string, x int")
    sinks.write_by_vintage(df, str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t")).where("vintage_part = 2017")
    assert [r.x for r in read.collect()] == [2]
    assert "PartitionFilters: [isnotnull(vintage_part" in read._jdf.queryExecution().executedPlan().toString()


def test_rejected_lines_are_counted_and_kept_apart(spark, folder, tmp_path_factory):
    from creditframe.plans import pipeline

    pattern, fields = layouts.FILE_PATTERNS["sample"][0], layouts.ORIGINATION_FIELDS
    rejected = files.rejected_lines(spark, folder, pattern, fields).collect()
    assert sorted(r.line for r in rejected) == sorted(["too|few|fields", line(fields, loan_sequence_number="F05Q10000003") + "|extra"])
    tables = str(tmp_path_factory.mktemp("tables"))
    counts = pipeline.load(spark, folder, tables, layout="sample")
    assert counts["origination_lines_read"] == 4 and counts["origination_lines_rejected"] == 2 and counts["origination_rows_kept"] == 2
    assert counts["performance_lines_read"] == 2 and counts["performance_lines_rejected"] == 1 and counts["performance_rows_kept"] == 1
    assert spark.read.parquet(f"{tables}/rejected_performance").collect()[0].line == "broken"
    written = {r.measure: r.n for r in spark.read.parquet(f"{tables}/load_counts").collect()}
    assert written == counts
