"""The batch flow from raw loan files to marts, cut at written tables.

Each stage reads the tables an earlier stage wrote, so the large performance table is parsed once,
later stages read only the columns they use, and a lost executor costs no more than its own stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from creditframe.functions.hazards import ASSUMED_LGD
from creditframe.functions.scalars import quarter_key_of_label
from creditframe.operators import features as feat
from creditframe.operators import loss, marts, panel, pd_models, projection, sampling, segments
from creditframe.operators.target import LOAN, loan_target, performance_summary
from creditframe.plans import scenarios
from creditframe.sources import files, layouts, sinks

MACRO_SCHEMA = (
    "quarter string, unemployment_rate double, mortgage_rate double, gdp_growth double, hpi double, hpi_yoy double"
)


def load(spark: SparkSession, raw: str, tables: str, fraction: float | None = None, layout: str | None = None) -> dict[str, int]:
    """Raw files to typed tables, partitioned by vintage: all loans, or the given fraction of them.

    Sampling is a filter on the loan key in both tables, so nothing is joined or shuffled. Lines read,
    rejected and written are counted in the writing pass itself (``observe``) and written as the table
    ``load_counts``; the rejected lines themselves go to ``rejected_<table>``.
    """
    layout = layout or files.detect_layout(spark, raw)
    counts: dict[str, int] = {}
    for name, fields, pattern, typed in (
        ("origination", layouts.ORIGINATION_FIELDS, layouts.FILE_PATTERNS[layout][0], files.type_loans),
        ("performance", layouts.PERFORMANCE_FIELDS, layouts.FILE_PATTERNS[layout][1], files.type_performance),
    ):
        rows, watch = files.counted(spark, raw, pattern, fields, f"load_{name}")
        kept = typed(rows) if fraction is None else sampling.sample_by_key(typed(rows), LOAN, fraction)
        written = Observation(f"kept_{name}")
        sinks.write_by_vintage(kept.observe(written, F.count(F.lit(1)).alias("kept")), f"{tables}/{name}")
        seen = watch.get
        counts |= {f"{name}_lines_read": seen["read"], f"{name}_lines_rejected": seen["rejected"], f"{name}_rows_kept": written.get["kept"]}
        sinks.write_table(files.rejected_lines(spark, raw, pattern, fields), f"{tables}/rejected_{name}")
    sinks.write_table(spark.createDataFrame(sorted(counts.items()), "measure string, n long"), f"{tables}/load_counts")
    return counts


def table(spark: SparkSession, tables: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{tables}/{name}")


def build_features(spark: SparkSession, tables: str) -> None:
    """Target and feature tables from the typed tables."""
    orig, perf = table(spark, tables, "origination"), table(spark, tables, "performance")
    sinks.write_table(loan_target(orig, performance_summary(perf)), f"{tables}/loan_target")
    sinks.write_table(feat.features(orig, table(spark, tables, "loan_target")), f"{tables}/features")


def read_macro(spark: SparkSession, path: str) -> DataFrame:
    """A quarterly macro file (``YYYYQn`` first) keyed by running quarter."""
    return files.read_facts(spark, path, MACRO_SCHEMA).withColumn("quarter_key", quarter_key_of_label(F.col("quarter")))


def stress_test(spark: SparkSession, tables: str, macro: DataFrame, out: str, cohort: str = "covid") -> None:
    """Panel, fitted hazards, projection, expected loss, segments and marts."""
    features = table(spark, tables, "features")
    sinks.write_table(panel.hazard_panel(table(spark, tables, "performance"), features, macro), f"{out}/panel")
    rows = table(spark, out, "panel")
    wanted = {"default_event": pd_models.DEFAULT_FEATURES, "prepay_event": pd_models.PREPAY_FEATURES}
    hazards = dict(zip(("default", "prepay"), pd_models.fit_hazards(rows, wanted).values()))
    paths = scenarios.scenario_paths(spark)
    book = segments.with_bands(feat.as_of_book(features, cohort))
    rolled = projection.roll_forward(book, paths, hazards["default"], hazards["prepay"])
    severity = loss.lgd(table(spark, tables, "loan_target")).select("lgd").scalar()
    sinks.write_table(loss.expected_loss(projection.by_quarter(rolled, paths), severity), f"{out}/projection")
    losses = table(spark, out, "projection")
    sinks.write_table(segments.cells(projection.by_loan(rolled, ASSUMED_LGD)), f"{out}/segment_cells")
    report = segments.segment_report(table(spark, out, "segment_cells"))
    dim = marts.dim_scenario(losses)
    sinks.write_marts(
        {
            "dim_scenario": dim,
            "fact_projection": marts.fact_projection(losses, dim),
            "fact_segment_loss": marts.fact_segment(report, dim),
        },
        f"{out}/marts",
    )
    sinks.write_table(marts.series_bundle(losses), f"{out}/series", "json")
    sinks.write_table(loss.headline(losses), f"{out}/headline", "json")
    sinks.write_table(pd_models.coefficient_table(spark, hazards["default"]), f"{out}/hazard_coefficients", "csv")
