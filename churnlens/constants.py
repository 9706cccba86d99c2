"""Fixed values that must equal the reference behaviour.

Everything in this module is a fixed value taken from the behaviour being
reproduced (column contracts, domains, cut-offs and decision constants).
They are stated here once, in their natural order.
"""

# --- fixed values: subscriber contract (21 columns, order is the contract) ---
EXPECTED_COLUMNS = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
    "MonthlyCharges", "TotalCharges", "Churn",
]

# --- fixed values: columns dropped before training ---
DROP_FEATURES = ["customerID", "PhoneService", "gender", "StreamingTV",
                 "StreamingMovies", "MultipleLines", "InternetService"]

# --- fixed values: numeric columns that are scaled ---
SCALED_COLUMNS = ["tenure", "MonthlyCharges", "TotalCharges"]

# --- fixed values: allowed values per subscriber column ---
SUBSCRIBER_DOMAINS = {
    "gender": ["Male", "Female"],
    "SeniorCitizen": ["0", "1"],
    "Partner": ["Yes", "No"],
    "Dependents": ["Yes", "No"],
    "PhoneService": ["Yes", "No"],
    "MultipleLines": ["Yes", "No", "No phone service"],
    "InternetService": ["DSL", "Fiber optic", "No"],
    "OnlineSecurity": ["Yes", "No", "No internet service"],
    "OnlineBackup": ["Yes", "No", "No internet service"],
    "DeviceProtection": ["Yes", "No", "No internet service"],
    "TechSupport": ["Yes", "No", "No internet service"],
    "StreamingTV": ["Yes", "No", "No internet service"],
    "StreamingMovies": ["Yes", "No", "No internet service"],
    "Contract": ["Month-to-month", "One year", "Two year"],
    "PaperlessBilling": ["Yes", "No"],
    "PaymentMethod": ["Electronic check", "Mailed check",
                      "Bank transfer (automatic)", "Credit card (automatic)"],
    "Churn": ["Yes", "No"],
}

# --- fixed values: tenure bands, right-open edges (labels are our own) ---
TENURE_EDGES = [0, 12, 48, 73]
TENURE_LABELS = ["[0,12)", "[12,48)", "[48,73)"]

# --- fixed values: risk bands on churn probability ---
RISK_CUTS = [0.33, 0.66]
RISK_LABELS = ["Low", "Medium", "High"]

# --- fixed values: classification and column typing ---
DECISION_THRESHOLD = 0.5
CATEGORICAL_DISTINCT_BELOW = 10
CARDINAL_DISTINCT_ABOVE = 20

# --- fixed values: monitoring gates ---
MIN_ROWS_MONITORING = 10
MIN_ROWS_CANARY = 30

# --- fixed values: canary decision ---
CANARY_MIN_IMPROVEMENT = 0.01
CANARY_LATENCY_WEIGHT = 0.1
CANARY_MAX_LATENCY_SEC = 2.0
CANARY_STEPS = [0.05, 0.25, 1.0]
CANARY_STEP_WAIT = "6 hours"

# --- fixed values: decay and drift decision bands ---
DECAY_F1_THRESHOLD = 0.80
DECAY_CRITICAL_FACTOR = 1.05
DECAY_EARLY_FACTOR = 1.10
DRIFT_SHARE_THRESHOLD = 0.5
DRIFT_CRITICAL_FACTOR = 0.8
DRIFT_EARLY_FACTOR = 0.6

# --- fixed values: metric scrape interval ---
SCRAPE_INTERVAL = "10 seconds"
INTERNAL_ENDPOINTS = ["/metrics", "/verify-session", "/update_metrics",
                      "/iframe_data_monitoring_proxy"]
