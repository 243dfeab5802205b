"""Column contracts of each layer."""

from __future__ import annotations

from pyspark.sql import types as T

TARGET = "serious_dlqin2yrs"
PARTITION = "ingestion_date"
ROW_ID = "row_id"

# Source column names and the names they get.
RENAMES = {
    "SeriousDlqin2yrs": "serious_dlqin2yrs",
    "RevolvingUtilizationOfUnsecuredLines": "revolving_utilization_of_unsecured_lines",
    "age": "age",
    "NumberOfTime30-59DaysPastDueNotWorse": "number_of_time30_59_days_past_due_not_worse",
    "DebtRatio": "debt_ratio",
    "MonthlyIncome": "monthly_income",
    "NumberOfOpenCreditLinesAndLoans": "number_of_open_credit_lines_and_loans",
    "NumberOfTimes90DaysLate": "number_of_times90_days_late",
    "NumberRealEstateLoansOrLines": "number_real_estate_loans_or_lines",
    "NumberOfTime60-89DaysPastDueNotWorse": "number_of_time60_89_days_past_due_not_worse",
    "NumberOfDependents": "number_of_dependents",
}
INDEX_COLUMN = "_c0"

FLOATS = (
    "revolving_utilization_of_unsecured_lines",
    "debt_ratio",
    "monthly_income",
    "number_of_dependents",
)
CLEAN_TYPES = {name: "float" if name in FLOATS else "int" for name in RENAMES.values()}

# Caps, legal minimum, bucket bounds and names.
REVOLVING_CAP = 1.0
DEBT_RATIO_CAP = 4985.1
MONTHLY_INCOME_CAP = 25000.0
AGE_MIN = 18
AGE_BOUNDS = (30, 50, 65)
AGE_BUCKETS = ("young", "middle", "senior", "elderly")
MIN_TRAINING_ROWS = 100_000

SOURCE_FEATURES = [n for n in RENAMES.values() if n != TARGET]
CATEGORICAL = ["age_risk_bucket"]
DERIVED_FEATURES = [
    "monthly_income_is_missing",
    "number_of_dependents_is_missing",
    "delinquency_score",
    "debt_to_income_ratio",
    "unsecured_to_total_lines_ratio",
    "age_risk_bucket",
    "has_any_delinquency",
]
FEATURES = SOURCE_FEATURES + DERIVED_FEATURES
NUMERIC = [f for f in FEATURES if f not in CATEGORICAL]
MODEL_ORDER = NUMERIC + CATEGORICAL

RAW = T.StructType([T.StructField(n, T.StringType()) for n in [INDEX_COLUMN, *RENAMES]])
CLEAN = T.StructType(
    [T.StructField(n, T.FloatType() if t == "float" else T.IntegerType()) for n, t in CLEAN_TYPES.items()]
)
PREDICTIONS = T.StructType(
    [
        T.StructField(ROW_ID, T.LongType()),
        T.StructField("probability", T.DoubleType()),
        T.StructField("prediction", T.IntegerType()),
    ]
)
RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]
)
SAMPLES = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("metric", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("value", T.DoubleType()),
    ]
)
EVALUATION_REPORT = T.StructType(
    [
        T.StructField("champion_name", T.StringType()),
        T.StructField("champion_run_id", T.StringType()),
        *[
            T.StructField(n, T.DoubleType())
            for n in (
                "val_auc",
                "test_auc",
                "test_ks",
                "test_gini",
                "test_pr_auc",
                "optimal_threshold",
                "auc_threshold",
            )
        ],
        T.StructField("passes_threshold", T.BooleanType()),
        T.StructField("registered_version", T.StringType()),
        T.StructField("feature_columns", T.ArrayType(T.StringType())),
    ]
)
MONITORING_REPORT = T.StructType(
    [
        T.StructField("ingestion_date", T.StringType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField(
            "checks",
            T.StructType(
                [
                    T.StructField(
                        "data_quality",
                        T.StructType(
                            [
                                T.StructField("row_count", T.LongType()),
                                T.StructField("null_rates", T.MapType(T.StringType(), T.DoubleType())),
                                T.StructField("missing_columns", T.ArrayType(T.StringType())),
                                T.StructField("constant_columns", T.ArrayType(T.StringType())),
                            ]
                        ),
                    ),
                    T.StructField(
                        "feature_drift",
                        T.StructType(
                            [
                                T.StructField("per_feature_drift", T.MapType(T.StringType(), T.DoubleType())),
                                T.StructField("drifted_features", T.ArrayType(T.StringType())),
                                T.StructField("drift_share", T.DoubleType()),
                                T.StructField("overall_drift_detected", T.BooleanType()),
                                T.StructField("skipped", T.BooleanType()),
                                T.StructField("reason", T.StringType()),
                            ]
                        ),
                    ),
                    T.StructField(
                        "score_distribution",
                        T.StructType(
                            [
                                *[
                                    T.StructField(n, T.DoubleType())
                                    for n in (
                                        "mean_probability",
                                        "std_probability",
                                        "p25",
                                        "p50",
                                        "p75",
                                        "pct_predicted_default",
                                    )
                                ],
                                T.StructField("record_count", T.LongType()),
                                T.StructField("skipped", T.BooleanType()),
                                T.StructField("reason", T.StringType()),
                            ]
                        ),
                    ),
                ]
            ),
        ),
    ]
)
