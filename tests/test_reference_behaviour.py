"""The reference's own pipeline tests, re-expressed on Spark with our rows."""

import pytest
from pyspark.sql import functions as F

from churnlens.constants import DROP_FEATURES, EXPECTED_COLUMNS, SCALED_COLUMNS
from churnlens.operators import clean as C
from churnlens.operators import fitted as D
from churnlens.operators.quality import validate_schema

ROWS = [
    ("0001-AAAA", "Female", 0, "Yes", "No", 1, "No", "No phone service", "DSL", "No", "Yes", "No", "No",
     "No", "No", "Month-to-month", "Yes", "Electronic check", 29.85, "29.85", "No"),
    ("0002-BBBB", "Male", 1, "No", "Yes", 34, "Yes", "No", "Fiber optic", "Yes", "No", "Yes", "No",
     "Yes", "No", "One year", "No", "Mailed check", 56.95, "1889.5", "Yes"),
]
TYPES = {"SeniorCitizen": "int", "tenure": "int", "MonthlyCharges": "double"}
SCHEMA = ", ".join(f"{c} {TYPES.get(c, 'string')}" for c in EXPECTED_COLUMNS)
NUMERIC = ["tenure", "MonthlyCharges", "TotalCharges"]
CATEGORICAL = [c for c in EXPECTED_COLUMNS if c not in NUMERIC + ["customerID"]]


@pytest.fixture()
def subs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def spec():
    return {"id": "customerID", "target": "Churn", "numeric_text": ["TotalCharges"], "numeric": NUMERIC,
            "categorical": CATEGORICAL, "drop": DROP_FEATURES, "scaled": SCALED_COLUMNS, "scaler": "minmax"}


def test_shape(subs):
    assert (subs.count(), len(subs.columns)) == (2, 21)


def test_cleaning_coerces_bad_total_to_zero(subs):
    bad = subs.withColumn("TotalCharges", F.when(F.col("customerID") == "0001-AAAA", "invalid")
                          .otherwise(F.col("TotalCharges")))
    out = C.clean_table(C.as_categorical(bad, ["SeniorCitizen"]), ["TotalCharges"], NUMERIC, CATEGORICAL)
    assert dict(out.dtypes)["TotalCharges"] == "double"
    got = {r.customerID: r.TotalCharges for r in out.collect()}
    assert got == {"0001-AAAA": 0.0, "0002-BBBB": 1889.5}


def test_target_encodes_to_01(subs):
    out = C.encode_binary(subs, "Churn")
    assert {r.Churn for r in out.collect()} == {0, 1}


def test_validate_schema_pass_and_fail(subs):
    assert validate_schema(subs, EXPECTED_COLUMNS) is True
    with pytest.raises(ValueError, match="Churn"):
        validate_schema(subs.drop("Churn"), EXPECTED_COLUMNS)


def test_identity_hooks_keep_shape(subs):
    out = D.hooks(subs, lambda df: df, lambda df: df)
    assert (out.count(), out.columns) == (2, subs.columns)


def test_feature_selection_drops_seven(subs):
    out = C.drop_if_present(subs, DROP_FEATURES + ["not_present"])
    assert not set(DROP_FEATURES) & set(out.columns)
    assert len(out.columns) == 21 - 7


def test_scaled_into_unit_interval(subs):
    feats, params = D.prepare_training(C.as_categorical(subs, ["SeniorCitizen"]), spec())
    for r in feats.collect():
        for c in SCALED_COLUMNS:
            assert 0.0 <= r[c] <= 1.0
    assert set(params["scaler"]) == set(SCALED_COLUMNS)
