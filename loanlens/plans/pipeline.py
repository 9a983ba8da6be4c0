"""Full run (R1): ETL -> profiling -> segmentation -> models.

All tables of a run go to a version folder of their own, and a manifest written
last makes them the result (:mod:`loanlens.sources.commit`).

Each step reads DataFrames and writes its result tables to one directory
per table under ``out_dir``. The clean dataset is written once and read
back, so every later step starts from a stored table (lineage cut, and a
lost executor only recomputes from that table). A failing step raises
``PipelineError`` naming it, and later steps do not run.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from loanlens.config import ModelConfig, RiskConfig
from loanlens.operators import clean as C
from loanlens.operators import eda as E
from loanlens.operators import segments as S
from loanlens.operators.conform import conform, reject_report
from loanlens.operators.dates import date_order
from loanlens.operators.model import run_models, top_features
from loanlens.sources import sinks
from loanlens.sources.commit import ResultVersion
from loanlens.sources.profiles import get_profile
from loanlens.sources.raw import read_clean
from loanlens.session import checkpoint_dir

TOP_FEATURES = 15


class PipelineError(RuntimeError):
    def __init__(self, step: str, cause: Exception):
        super().__init__(f"step '{step}' failed: {cause}")
        self.step = step
        self.cause = cause


@dataclass
class PipelineResult:
    out_dir: str
    tables: dict[str, str] = field(default_factory=dict)   # name -> path
    summary: dict = field(default_factory=dict)


def run_pipeline(spark: SparkSession, raw: DataFrame, out_dir: str, profile: str = "banner",
                 risk: RiskConfig = RiskConfig(), model: ModelConfig | None = ModelConfig(),
                 table_format: str = "json") -> PipelineResult:
    prof = get_profile(profile)
    res = PipelineResult(out_dir=out_dir.rstrip("/"))
    version = ResultVersion(spark, res.out_dir)

    def note(name: str, fmt: str) -> None:
        res.tables[name] = version.path(name)
        written = spark.read.option("header", True).format(fmt).load(version.path(name))
        version.add(name, fmt, written if written.columns else None)

    def put(name: str, df: DataFrame) -> None:
        sinks.write_table(df, version.path(name), table_format)
        note(name, table_format)

    checkpoint_dir(spark)
    step = "etl"
    try:
        dates = date_order(conform(raw, prof), "birth_date").checkpoint(eager=True)
        put("date_order", dates)
        risk = replace(risk, day_first=dates.first()["date_order"] == "day")
        clean_path = version.path("dataset")
        sinks.write_clean(C.clean_dataset(raw, prof, risk), clean_path)
        note("dataset", "parquet")
        clean = read_clean(spark, clean_path)
        pop = C.population_counts(raw, prof, risk).checkpoint(eager=True)   # read twice below
        put("population_counts", pop)
        put("reject_report", reject_report(conform(raw, prof), risk.level_codes))
        put("level_breakdown", C.level_breakdown(clean, risk.level_codes))
        put("default_rate_by_level", C.default_rate_by_level(clean))
        put("enrollment_breakdown", C.enrollment_breakdown(raw, prof, risk))
        put("feature_completeness", C.feature_completeness(clean))
        res.summary["etl"] = pop.first().asDict()

        step = "eda"
        put("class_balance", E.class_balance(clean))
        put("missing_values", E.missing_values(clean))
        put("numeric_distribution", E.numeric_distribution(clean, risk))
        put("correlation_with_default", E.correlation_with_default(clean))

        step = "segmentation"
        # counted once each; every table below reads the stored rows
        rates = S.segment_rates(clean, risk).checkpoint(eager=True)
        status = S.status_rates(clean).checkpoint(eager=True)
        idr = S.idr_finding(clean, risk).checkpoint(eager=True)
        put("segment_rates", S.ordered(rates))
        put("top_segments", S.top_segments(rates))
        put("page_cuts", S.top_segments(rates, S.PAGE_CUTS))
        put("status_rates", status)
        put("idr_finding", idr)
        sinks.write_segment_report(S.segment_report(clean, risk, rates, status, idr), version.path("segment_report_csv"))
        note("segment_report_csv", "csv")
        res.summary["segmentation"] = idr.first().asDict()

        if model is not None:
            step = "model"
            rep = run_models(clean, model)
            put("cv_metrics", rep.cv_metrics)
            put("cv_summary", rep.cv_summary)
            put("feature_importance", rep.importance)
            put("feature_importance_rollup", rep.importance_rollup)
            put("top_features", top_features(rep.importance, TOP_FEATURES))     # L7
            put("subgroup_auc", rep.subgroup)
            sinks.write_model(rep.fitted, version.path("best_model"))
            version.add("best_model", "parquet")
            res.tables["best_model"] = version.path("best_model")
            res.summary["model"] = {"best_model": rep.best_model, "best_auc": rep.best_auc,
                                    "training_rows": rep.training_rows,
                                    "class_balance": rep.class_balance}
        step = "commit"
        res.summary["version"] = version.commit()
    except Exception as exc:  # noqa: BLE001 - re-raised with the step name
        raise PipelineError(step, exc) from exc
    return res
