"""Exploring and cleaning tables on Spark."""

from rowmill.functions.columns import (
    ROW_ID,
    categorical_columns,
    default_picks,
    existing,
    hidden_columns,
    nan_to_null,
    numeric_columns,
    raw_columns,
    scaled_columns,
    suggested_columns,
)
from rowmill.operators.distribution import (
    box_outliers,
    box_stats,
    category_shares,
    distribution,
    histogram,
    kde,
    numeric_distribution,
    scatter,
)
from rowmill.operators.encode import BinaryEncode, LabelEncode, OneHotEncode, OrdinalEncode
from rowmill.operators.impute import Impute, modes
from rowmill.operators.normality import normality
from rowmill.operators.outliers import TreatOutliers
from rowmill.operators.profile import (
    categorical_stats,
    column_report,
    columns_with_nulls,
    describe_numeric,
    distinct_count,
    encoding_status,
    missing_report,
    moment_stats,
    null_counts,
    numeric_stats,
    outlier_report,
    outlier_summary,
    overview_shape,
    raw_stats,
    run_summary,
    scaled_stats,
    selection_counts,
    table_status,
    value_counts,
)
from rowmill.operators.quantiles import quantiles
from rowmill.operators.relations import (
    average_ranks,
    correlation,
    covariance,
    mean_abs_correlation,
)
from rowmill.operators.retype import Retype
from rowmill.operators.scale import Scale
from rowmill.operators.select import DropColumns, DropTemporary, KeepColumns, realign
from rowmill.plans.pipeline import Pipeline
from rowmill.plans.step import ALL, Action, Step, StepRefused, apply_actions
from rowmill.plans.storage import release
from rowmill.sources.delimited import infer_types, read_delimited, with_row_id
from rowmill.sources.output import preview, preview_rows, write_csv
from rowmill.streaming.replay import replay

__all__ = [name for name in dir() if not name.startswith("_")]
