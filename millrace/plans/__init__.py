from millrace.plans.changes import apply_changes, read_kept
from millrace.plans.curated import Link, aggregate_view, dimension, fact_table, refresh_view
from millrace.plans.staging import (
    PipelineRun,
    QualityError,
    RunConflictError,
    SchemaDriftError,
    run_pipeline,
    transform,
)
from millrace.plans.views import apply_delta, create_view, read_view

__all__ = [
    "Link",
    "PipelineRun",
    "QualityError",
    "RunConflictError",
    "SchemaDriftError",
    "aggregate_view",
    "apply_changes",
    "apply_delta",
    "create_view",
    "dimension",
    "fact_table",
    "read_kept",
    "read_view",
    "refresh_view",
    "run_pipeline",
    "transform",
]
