"""tabflow: profile a wide business table, fit a feature pipeline, select
features, search and ensemble regressors, and score in batch -- all as
Spark DataFrame plans and Spark ML stages."""

from tabflow.roles import FIXTURE_ROLES, REFERENCE_ROLES, Roles
from tabflow.session import get_spark
from tabflow.plans.features import FeaturePipeline, FeaturePipelineModel
from tabflow.plans.modeling import Budget, run_eda_and_features, run_modeling

__all__ = ["Roles", "REFERENCE_ROLES", "FIXTURE_ROLES", "get_spark", "FeaturePipeline", "FeaturePipelineModel",
           "Budget", "run_modeling", "run_eda_and_features"]
