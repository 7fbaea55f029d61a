"""The whole flow on raw text files written from the loan views."""

from pyspark.sql import functions as F

from checks import views
from creditframe.operators import target
from creditframe.plans import pipeline
from creditframe.sources import layouts

SF = "/root/testdata/sf0.001"


def write_raw(df, fields, path):
    columns = [F.col(f).cast("string") if f in df.columns else F.lit(None).cast("string").alias(f) for f in fields]
    df.select(*columns).write.option("sep", "|").option("emptyValue", "").csv(path)


def test_raw_files_to_marts(spark, tmp_path):
    loans, perf = views.origination(spark, SF), views.performance(spark, SF)
    write_raw(loans, layouts.ORIGINATION_FIELDS, str(tmp_path / "o"))
    write_raw(perf, layouts.PERFORMANCE_FIELDS, str(tmp_path / "p"))
    raw = tmp_path / "raw"
    raw.mkdir()
    for folder, name in (("o", "sample_orig_2005"), ("p", "sample_svcg_2005")):
        with open(raw / f"{name}.txt", "w") as out:
            for part in sorted((tmp_path / folder).glob("part-*")):
                out.write(part.read_text())
    tables, out = str(tmp_path / "tables"), str(tmp_path / "out")
    pipeline.load(spark, str(raw), tables, fraction=1.0)
    pipeline.build_features(spark, tables)
    assert pipeline.table(spark, tables, "performance").count() == perf.count()
    direct = target.target_summary(target.loan_target(loans, target.performance_summary(perf))).first()
    assert target.target_summary(pipeline.table(spark, tables, "loan_target")).first() == direct

    from creditframe.operators import macro
    from creditframe.functions.scalars import quarter_label

    history = macro.macro_table(views.macro_observations(spark, SF)).withColumn("quarter", quarter_label(F.col("quarter_key")))
    history.select("quarter", "unemployment_rate", "mortgage_rate", "gdp_growth", "hpi", "hpi_yoy").coalesce(1).write.option("header", "true").csv(str(tmp_path / "macro"))
    pipeline.stress_test(spark, tables, pipeline.read_macro(spark, str(tmp_path / "macro")), out)
    dim = spark.read.option("header", "true").csv(f"{out}/marts/dim_scenario").collect()
    assert sorted(r.scenario_label for r in dim) == ["Baseline", "Severely Adverse"]
    assert spark.read.option("header", "true").csv(f"{out}/marts/fact_projection").count() == 26
    assert spark.read.json(f"{out}/series").count() == 2
    assert spark.read.json(f"{out}/headline").first().severe_to_base > 0
