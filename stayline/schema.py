"""Subscriber schema, column groups and thresholds."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: the subscriber column names, their order and their domains ---
KEY = "customerID"
TARGET = "Churn"
POSITIVE, NEGATIVE = "Yes", "No"

NUMERIC_FEATURES = ["tenure", "MonthlyCharges", "TotalCharges"]
CATEGORICAL_FEATURES = [
    "gender", "Contract", "PaymentMethod", "InternetService", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies",
    "Partner", "Dependents", "PhoneService", "MultipleLines", "PaperlessBilling",
]
SERVICE_COLUMNS = [
    "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies",
]
STREAMING_COLUMNS = ["StreamingTV", "StreamingMovies"]
PROTECTION_COLUMNS = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport"]
SERVICE_NAME_PARTS = ["service", "backup", "protection", "support", "streaming"]
BINARY_COLUMNS = ["Partner", "Dependents", "PhoneService", "PaperlessBilling", "Churn"]
CONTRACTS = ["Month-to-month", "One year", "Two year"]

SEED = 42
TEST_SHARE = 0.2
CV_FOLDS = 5
SUCCESS_GATE = 95.0
WINDOW_SIZE = 100

# Business assumptions
MONTHLY_REVENUE = 70.0
LIFESPAN_MONTHS = 24
ACQUISITION_COST = 300.0
CONTACT_COST = 50.0
CAMPAIGN_SUCCESS = 0.5
# --- End of fixed values ---


def subscriber_schema() -> T.StructType:
    """TotalCharges stays text: new customers arrive with a blank."""
    text, whole, real = T.StringType(), T.IntegerType(), T.DoubleType()
    kinds = [
        (KEY, text), ("gender", text), ("SeniorCitizen", whole), ("Partner", text), ("Dependents", text),
        ("tenure", whole), ("PhoneService", text), ("MultipleLines", text), ("InternetService", text),
        ("OnlineSecurity", text), ("OnlineBackup", text), ("DeviceProtection", text), ("TechSupport", text),
        ("StreamingTV", text), ("StreamingMovies", text), ("Contract", text), ("PaperlessBilling", text),
        ("PaymentMethod", text), ("MonthlyCharges", real), ("TotalCharges", text), (TARGET, text),
    ]
    return T.StructType([T.StructField(name, kind, True) for name, kind in kinds])


def event_schema() -> T.StructType:
    """Payload of an event message."""
    return T.StructType([
        T.StructField(KEY, T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("event_ts", T.StringType()),
    ])


def subscriber_message_schema() -> T.StructType:
    """A subscriber row as it travels in a message: no target, plus its event time."""
    fields = [f for f in subscriber_schema().fields if f.name != TARGET]
    return T.StructType([*fields, T.StructField("event_ts", T.StringType())])
