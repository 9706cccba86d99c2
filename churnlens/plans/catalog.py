"""Registered queries: one per operator (or operator family) of the survey.

Every query reads the given tables through the bridge views, over whole
tables; a DuckDB twin is registered next to it when the result is expressible
in SQL.  Floating outputs are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.constants import INTERNAL_ENDPOINTS, RISK_CUTS, RISK_LABELS, TENURE_EDGES, TENURE_LABELS
from churnlens.operators import clean as C
from churnlens.operators import explore as E
from churnlens.plans import fixtures as FX
from churnlens.plans.fixtures import SQL_VIEWS, with_views
from churnlens.streaming.streams import DEFAULT_LATENCY_EDGES

SQL_VIEWS_PL = SQL_VIEWS["prediction_log"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

DIGITS = 6
SUB_NUMERIC = ["tenure", "monthly_charges", "total_charges"]
SUB_CATEGORICAL = ["gender", "senior", "segment", "contract", "payment", "churn"]


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, DIGITS)


# ---------------------------------------------------------------------------
# shared inputs
# ---------------------------------------------------------------------------

def clean_subscribers(spark: SparkSession, sf: str, fill: str = "zero") -> DataFrame:
    raw = FX.subscribers(spark, sf).withColumnRenamed("total_charges_raw", "total_charges")
    raw = C.as_categorical(raw, ["senior"])
    return C.clean_table(raw, ["total_charges"], SUB_NUMERIC, SUB_CATEGORICAL, fill=fill)


SQL_SUBS_CLEAN = """
    SELECT customer_id, gender, CAST(senior AS VARCHAR) AS senior,
           coalesce(segment, (SELECT value FROM (SELECT segment AS value, count(*) AS n FROM subscribers
                              WHERE segment IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 1))) AS segment,
           contract, payment, tenure, monthly_charges,
           coalesce(TRY_CAST(trim(total_charges_raw) AS DOUBLE), 0.0) AS total_charges, churn
    FROM subscribers"""


def subs_clean_views(extra: str = "") -> str:
    body = f"subs_clean AS ({SQL_SUBS_CLEAN})"
    return with_views("subscribers", extra=body + (",\n" + extra if extra else ""))


SQL_BAND = ("CASE WHEN tenure >= 0 AND tenure < 12 THEN '[0,12)' WHEN tenure >= 12 AND tenure < 48 "
            "THEN '[12,48)' WHEN tenure >= 48 AND tenure < 73 THEN '[48,73)' END")


# ---------------------------------------------------------------------------
# flagship: churn rate by tenure band
# ---------------------------------------------------------------------------

@register("churn_rate_by_tenure_band", subs_clean_views() + f"""
SELECT {SQL_BAND} AS tenure_band, count(*) AS n,
       CAST(sum(CASE churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END) AS BIGINT) AS n_flag,
       round(avg(CASE churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END), 6) AS rate
FROM subs_clean GROUP BY 1""")
def churn_rate_by_tenure_band(spark, sf):
    df = clean_subscribers(spark, sf)
    df = C.encode_binary(df, "churn")
    df = C.bin_column(df, "tenure", TENURE_EDGES, TENURE_LABELS, out="tenure_band")
    out = E.rate_by(df, "tenure_band", "churn")
    return out.select("tenure_band", "n", F.col("n_flag").cast("bigint").alias("n_flag"), r6("rate").alias("rate"))


# ---------------------------------------------------------------------------
# SQL helpers for the twins
# ---------------------------------------------------------------------------

def sql_melt(src: str, cols, ids=(), cast: str = "VARCHAR") -> str:
    idl = "".join(f"{i}, " for i in ids)
    return "\n UNION ALL ".join(
        f"SELECT {idl}'{c}' AS \"column\", CAST({c} AS {cast}) AS value FROM {src}" for c in cols)


RAW_COLS = ["customer_id", "gender", "senior", "segment", "contract", "payment", "tenure",
            "monthly_charges", "total_charges_raw", "churn"]
ENC_COLS = ["gender", "senior", "segment", "contract", "payment"]


# ---------------------------------------------------------------------------
# B: schema and quality
# ---------------------------------------------------------------------------

@register("null_counts", with_views("subscribers", extra=f"""
s AS (SELECT * REPLACE (TRY_CAST(trim(total_charges_raw) AS DOUBLE) AS total_charges_raw) FROM subscribers),
c AS ({" UNION ALL ".join(f"SELECT '{c}' AS col, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM s"
                           for c in RAW_COLS)})""") + """
SELECT col AS "column", n_null FROM c
UNION ALL SELECT '__all__', CAST(sum(n_null) AS BIGINT) FROM c""")
def q_null_counts(spark, sf):
    from churnlens.operators.quality import null_counts
    df = C.to_numeric(FX.subscribers(spark, sf), "total_charges_raw")
    return null_counts(df, RAW_COLS)


@register("split_incomplete", with_views("subscribers") + """
SELECT customer_id, CASE """ + " ".join(
    f"WHEN {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '' THEN '{c}'" for c in RAW_COLS) + """ END AS bad_field
FROM subscribers WHERE """ + " OR ".join(f"({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '')" for c in RAW_COLS))
def q_split_incomplete(spark, sf):
    from churnlens.operators.quality import split_incomplete
    df = split_incomplete(FX.subscribers(spark, sf), RAW_COLS)
    return df.where(F.col("bad_field").isNotNull()).select("customer_id", "bad_field")


# fixed values: the allowed lists used by the domain check query
QUERY_DOMAINS = {
    "gender": ["F", "M"],
    "contract": ["F", "O"],
    "segment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"],
    "payment": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
}


@register("domain_violations", with_views("subscribers", extra="dom(col, val) AS (VALUES " + ", ".join(
    f"('{c}', '{v}')" for c, vs in QUERY_DOMAINS.items() for v in vs) + ")") + f"""
SELECT m."column", m.value, count(*) AS n FROM ({sql_melt("subscribers", list(QUERY_DOMAINS))}) m
WHERE m.value IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dom WHERE dom.col = m."column" AND dom.val = m.value)
GROUP BY 1, 2""")
def q_domain_violations(spark, sf):
    from churnlens.operators.quality import domain_violations
    return domain_violations(FX.subscribers(spark, sf), QUERY_DOMAINS)


_RAW_TYPES = {"customer_id": "string", "gender": "string", "senior": "int", "segment": "string",
              "contract": "string", "payment": "string", "tenure": "int", "monthly_charges": "double",
              "total_charges_raw": "string", "churn": "string"}


@register("classify_columns", with_views("subscribers", extra=f"""
nd AS (SELECT "column", count(DISTINCT value) AS n FROM ({sql_melt("subscribers", RAW_COLS)}) GROUP BY 1),
ty(col, dtype, is_text) AS (VALUES """ + ", ".join(
    f"('{c}', '{t}', {str(t == 'string').upper()})" for c, t in _RAW_TYPES.items()) + """)""") + """
SELECT ty.col AS "column", ty.dtype, CAST(coalesce(nd.n, 0) AS BIGINT) AS n_distinct,
       CASE WHEN is_text AND coalesce(nd.n, 0) > 20 THEN 'cardinal' WHEN is_text THEN 'categorical'
            WHEN coalesce(nd.n, 0) < 10 THEN 'categorical' ELSE 'numeric' END AS kind
FROM ty LEFT JOIN nd ON nd."column" = ty.col""")
def q_classify_columns(spark, sf):
    from churnlens.operators.quality import classify_columns
    return classify_columns(FX.subscribers(spark, sf))


@register("sorted_distinct", subs_clean_views() + f"""
SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS BIGINT) AS position,
       count(*) OVER (PARTITION BY "column") AS n_values
FROM (SELECT DISTINCT "column", value FROM ({sql_melt("subs_clean", ENC_COLS)}) WHERE value IS NOT NULL)""")
def q_sorted_distinct(spark, sf):
    from churnlens.operators.quality import sorted_distinct
    return sorted_distinct(clean_subscribers(spark, sf), ENC_COLS)


@register("profile_numeric", subs_clean_views() + f"""
SELECT "column", count(*) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       round(min(value), 6) AS min, round(max(value), 6) AS max,
       round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50,
       round(quantile_cont(value, 0.75), 6) AS q75, count(DISTINCT value) AS n_distinct
FROM ({sql_melt("subs_clean", SUB_NUMERIC, cast="DOUBLE")}) WHERE value IS NOT NULL GROUP BY 1""")
def q_profile_numeric(spark, sf):
    from churnlens.operators.quality import profile_numeric
    p = profile_numeric(clean_subscribers(spark, sf), SUB_NUMERIC)
    return p.select("column", "count", *[r6(c).alias(c) for c in ["mean", "std", "min", "max", "q25", "q50", "q75"]],
                    "n_distinct")


@register("profile_categorical", with_views("subscribers", extra=f"""
cnt AS (SELECT "column", value, count(*) AS n FROM ({sql_melt("subscribers", ENC_COLS + ["churn"])})
        WHERE value IS NOT NULL GROUP BY 1, 2)""") + """
SELECT "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS n_distinct,
       arg_min(value, (-n, value)) AS top, CAST(max(n) AS BIGINT) AS freq
FROM cnt GROUP BY 1""")
def q_profile_categorical(spark, sf):
    from churnlens.operators.quality import profile_categorical
    return profile_categorical(C.as_categorical(FX.subscribers(spark, sf), ["senior"]), ENC_COLS + ["churn"])


@register("groups_with_rows", with_views("prediction_log") + """
SELECT customer_id, endpoint, count(*) AS n_rows FROM prediction_log GROUP BY 1, 2 HAVING count(*) >= 10""")
def q_groups_with_rows(spark, sf):
    from churnlens.constants import MIN_ROWS_MONITORING
    from churnlens.operators.quality import groups_with_rows
    return groups_with_rows(FX.prediction_log(spark, sf), ["customer_id", "endpoint"], MIN_ROWS_MONITORING)


# ---------------------------------------------------------------------------
# C: cleaning and scalar rules
# ---------------------------------------------------------------------------

@register("clean_subscribers", subs_clean_views() + "SELECT * FROM subs_clean")
def q_clean_subscribers(spark, sf):
    return clean_subscribers(spark, sf)


@register("clean_subscribers_median", with_views("subscribers") + """
SELECT customer_id, coalesce(TRY_CAST(trim(total_charges_raw) AS DOUBLE),
       (SELECT quantile_cont(TRY_CAST(trim(total_charges_raw) AS DOUBLE), 0.5) FROM subscribers)) AS total_charges
FROM subscribers""")
def q_clean_subscribers_median(spark, sf):
    return clean_subscribers(spark, sf, fill="median").select("customer_id", "total_charges")


SALT = "churnlens"


@register("subscriber_rules", subs_clean_views() + f"""
SELECT customer_id, CASE churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS churn_flag,
       CASE senior WHEN '1' THEN 'Yes' WHEN '0' THEN 'No' ELSE senior END AS senior_label,
       round(total_charges / CASE WHEN tenure = 0 THEN 1 ELSE tenure END, 6) AS mean_charges,
       {SQL_BAND} AS tenure_band,
       sha256('{SALT}' || customer_id) AS customer_hash
FROM subs_clean""")
def q_subscriber_rules(spark, sf):
    df = clean_subscribers(spark, sf)
    df = C.encode_binary(df, "churn").withColumnRenamed("churn", "churn_flag")
    df = C.recode(df, "senior", {1: "Yes", 0: "No"}, out="senior_label")
    df = C.add_ratio(df, "total_charges", "tenure", "mean_charges")
    df = C.bin_column(df, "tenure", TENURE_EDGES, TENURE_LABELS, out="tenure_band")
    df = C.pseudonymise(df, "customer_id", SALT, out="customer_hash")
    return df.select("customer_id", "churn_flag", "senior_label", r6("mean_charges").alias("mean_charges"),
                     "tenure_band", "customer_hash")


@register("log_rules", with_views("prediction_log") + """
SELECT request_id,
       CASE WHEN probability < 0.33 THEN 'Low' WHEN probability < 0.66 THEN 'Medium' ELSE 'High' END AS risk,
       CAST(probability >= 0.5 AS INT) AS pred_inclusive, CAST(probability > 0.5 AS INT) AS pred_exclusive,
       CASE WHEN probability >= 0.5 THEN 'Yes' ELSE 'No' END AS churn_label,
       round(probability, 3) AS probability, round(probability * 100, 1) AS probability_pct
FROM prediction_log""")
def q_log_rules(spark, sf):
    df = FX.prediction_log(spark, sf)
    df = C.add_risk_band(df, "probability", "risk")
    df = C.add_threshold_label(df, "probability", 0.5, True, "pred_inclusive")
    df = C.add_threshold_label(df, "probability", 0.5, False, "pred_exclusive")
    df = C.decode_binary(df, "pred_inclusive", out="churn_label")
    df = df.withColumn("probability_pct", F.col("probability") * 100)
    df = C.round_cols(df, ["probability"], 3)
    df = C.round_cols(df, ["probability_pct"], 1)
    return df.select("request_id", "risk", "pred_inclusive", "pred_exclusive", "churn_label", "probability",
                     "probability_pct")


@register("conform_contract", with_views("subscribers") + """
SELECT customer_id, contract, CAST(NULL AS VARCHAR) AS region_code, tenure FROM subscribers""")
def q_conform_contract(spark, sf):
    df = C.drop_if_present(FX.subscribers(spark, sf), ["gender", "not_a_column"])
    return C.conform(df, ["customer_id", "contract", "region_code", "tenure"])


@register("filter_rows", with_views("subscribers") + """
SELECT customer_id, segment, tenure FROM subscribers WHERE segment IS NOT NULL AND churn = 'Yes'""")
def q_filter_rows(spark, sf):
    df = C.filter_rows(FX.subscribers(spark, sf), F.col("churn") == "Yes", dropna_subset=["segment"])
    return df.select("customer_id", "segment", "tenure")


@register("null_charges_rows", with_views("subscribers") + """
SELECT customer_id, tenure, TRY_CAST(trim(total_charges_raw) AS DOUBLE) AS total_charges FROM subscribers
WHERE TRY_CAST(trim(total_charges_raw) AS DOUBLE) IS NULL""")
def q_null_charges_rows(spark, sf):
    df = C.to_numeric(FX.subscribers(spark, sf).withColumnRenamed("total_charges_raw", "total_charges"),
                      "total_charges")
    return C.null_rows(df, "total_charges").select("customer_id", "tenure", "total_charges")


# ---------------------------------------------------------------------------
# D: fitted transforms
# ---------------------------------------------------------------------------

SUB_SPEC = {"id": "customer_id", "target": "churn", "numeric_text": ["total_charges"],
            "numeric": SUB_NUMERIC, "categorical": SUB_CATEGORICAL, "drop": ["customer_id", "gender"],
            "scaled": SUB_NUMERIC, "scaler": "minmax", "fill": "zero"}


def raw_subscribers(spark, sf):
    raw = FX.subscribers(spark, sf).withColumnRenamed("total_charges_raw", "total_charges")
    return C.as_categorical(raw, ["senior"])


def sql_encoder(src: str, cols=ENC_COLS) -> str:
    return f"""SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS BIGINT) AS code
    FROM (SELECT DISTINCT "column", value FROM ({sql_melt(src, cols)}) WHERE value IS NOT NULL)"""


def sql_code(enc: str, col: str, src: str) -> str:
    return (f"coalesce((SELECT code FROM {enc} WHERE {enc}.\"column\" = '{col}' "
            f"AND {enc}.value = CAST({src}.{col} AS VARCHAR)), -1) AS {col}")


def sql_minmax(mm: str, col: str, src: str) -> str:
    return (f"round((CAST({src}.{col} AS DOUBLE) - {mm}.mn_{col}) / "
            f"CASE WHEN {mm}.r_{col} = 0 THEN 1.0 ELSE {mm}.r_{col} END, 6) AS {col}")


def sql_mm_params(src: str) -> str:
    return "SELECT " + ", ".join(f"CAST(min({c}) AS DOUBLE) AS mn_{c}, CAST(max({c}) - min({c}) AS DOUBLE) AS r_{c}"
                                 for c in SUB_NUMERIC) + f" FROM {src}"


@register("label_encoder_fit", subs_clean_views() + sql_encoder("subs_clean"))
def q_label_encoder_fit(spark, sf):
    from churnlens.operators.fitted import fit_label_encoder
    return fit_label_encoder(clean_subscribers(spark, sf), ENC_COLS)


@register("label_encoder_apply", with_views("drift", extra=f"""
enc AS ({sql_encoder("drift_ref", ["o_orderstatus", "o_orderpriority"])})""") + f"""
SELECT o_orderstatus AS status, o_orderpriority AS priority,
       {sql_code("enc", "o_orderstatus", "drift_cur").replace(" AS o_orderstatus", " AS status_code")},
       {sql_code("enc", "o_orderpriority", "drift_cur").replace(" AS o_orderpriority", " AS priority_code")},
       count(*) AS n
FROM drift_cur GROUP BY ALL""")
def q_label_encoder_apply(spark, sf):
    from churnlens.operators.fitted import apply_label_encoder, fit_label_encoder
    ref, cur = FX.drift_sides(spark, sf)
    cols = ["o_orderstatus", "o_orderpriority"]
    enc = fit_label_encoder(ref, cols)
    cur = cur.select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), *cols)
    out = apply_label_encoder(cur, enc, cols)
    return (out.groupBy("status", "priority", F.col("o_orderstatus").alias("status_code"),
                        F.col("o_orderpriority").alias("priority_code"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("minmax_scaled", subs_clean_views(extra=f"mm AS ({sql_mm_params('subs_clean')})") + """
SELECT customer_id, """ + ", ".join(sql_minmax("mm", c, "s") for c in SUB_NUMERIC) + " FROM subs_clean s, mm")
def q_minmax_scaled(spark, sf):
    from churnlens.operators.fitted import apply_affine, fit_minmax
    df = clean_subscribers(spark, sf)
    out = apply_affine(df, fit_minmax(df, SUB_NUMERIC))
    return out.select("customer_id", *[r6(c).alias(c) for c in SUB_NUMERIC])


@register("standard_scaled", subs_clean_views(extra="sd AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SUB_NUMERIC) + " FROM subs_clean)") + """
SELECT customer_id, """ + ", ".join(
    f"round((s.{c} - sd.m_{c}) / CASE WHEN sd.s_{c} = 0 THEN 1.0 ELSE sd.s_{c} END, 6) AS {c}"
    for c in SUB_NUMERIC) + " FROM subs_clean s, sd")
def q_standard_scaled(spark, sf):
    from churnlens.operators.fitted import apply_affine, fit_standard
    df = clean_subscribers(spark, sf)
    out = apply_affine(df, fit_standard(df, SUB_NUMERIC))
    return out.select("customer_id", *[r6(c).alias(c) for c in SUB_NUMERIC])


FEATURE_CATS = ["senior", "segment", "contract", "payment"]


def _features_sql(fit_src: str, srv_src: str) -> str:
    return ("SELECT " + ", ".join(sql_code("enc", c, "s") for c in FEATURE_CATS) + ", "
            + ", ".join(sql_minmax("mm", c, "s") for c in SUB_NUMERIC)
            + f", CASE s.churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS churn FROM {srv_src} s, mm")


@register("training_features", subs_clean_views(extra=f"""
enc AS ({sql_encoder("subs_clean")}), mm AS ({sql_mm_params("subs_clean")})""") + _features_sql("subs_clean",
                                                                                                 "subs_clean"))
def q_training_features(spark, sf):
    from churnlens.operators.fitted import prepare_training
    feats, _ = prepare_training(raw_subscribers(spark, sf), SUB_SPEC)
    return feats.select(*FEATURE_CATS, *[r6(c).alias(c) for c in SUB_NUMERIC], "churn")


def _cohort_clean(src: str, mode_src: str) -> str:
    return f"""SELECT customer_id, gender, CAST(senior AS VARCHAR) AS senior,
           coalesce(segment, (SELECT value FROM (SELECT segment AS value, count(*) AS n FROM {mode_src}
                              WHERE segment IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 1))) AS segment,
           contract, payment, tenure, monthly_charges,
           coalesce(TRY_CAST(trim(total_charges_raw) AS DOUBLE), 0.0) AS total_charges, churn FROM {src}"""


@register("saved_pipeline_features", ORACLE["training_features"])
def q_saved_pipeline_features(spark, sf):
    """Cleaning, encoding and scaling as fitted stages that are saved, loaded and applied to the raw rows."""
    from churnlens.operators.pipeline import churn_pipeline, load_pipeline
    from churnlens.session import scratch_path
    from churnlens.sources.io import save_model
    raw, path = raw_subscribers(spark, sf), scratch_path(spark, "models", "features")
    save_model(churn_pipeline(SUB_SPEC, []).fit(raw), path)
    feats = load_pipeline(spark, path).transform(raw)
    return feats.select(*FEATURE_CATS, *[r6(c).alias(c) for c in SUB_NUMERIC], "churn")


@register("serving_features", with_views("subscribers", extra=f"""
fit_raw AS (SELECT * FROM subscribers WHERE tenure < 48),
srv_raw AS (SELECT * FROM subscribers),
fit_c AS ({_cohort_clean("fit_raw", "fit_raw")}),
srv_c AS ({_cohort_clean("srv_raw", "fit_raw")}),
enc AS ({sql_encoder("fit_c")}), mm AS ({sql_mm_params("fit_c")})""") + _features_sql("fit_c", "srv_c"))
def q_serving_features(spark, sf):
    from churnlens.operators.fitted import prepare_serving, prepare_training
    raw = raw_subscribers(spark, sf)
    _, params = prepare_training(raw, SUB_SPEC, fit_on=raw.where(F.col("tenure") < 48))
    feats = prepare_serving(raw, params)  # every row, with the parameters of the fitting cohort
    return feats.select(*FEATURE_CATS, *[r6(c).alias(c) for c in SUB_NUMERIC], "churn")


# ---------------------------------------------------------------------------
# E: exploration
# ---------------------------------------------------------------------------

def subs_explore(spark, sf):
    df = clean_subscribers(spark, sf)
    df = C.bin_column(df, "tenure", TENURE_EDGES, TENURE_LABELS, out="tenure_band")
    df = df.withColumn("churn_flag", F.when(F.col("churn") == "Yes", 1).when(F.col("churn") == "No", 0))
    return C.add_ratio(df, "total_charges", "tenure", "mean_charges")


def explore_views(extra: str = "") -> str:
    body = (f"sx AS (SELECT *, {SQL_BAND} AS tenure_band, CASE churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END "
            "AS churn_flag, total_charges / CASE WHEN tenure = 0 THEN 1 ELSE tenure END AS mean_charges "
            "FROM subs_clean)")
    return subs_clean_views(body + (",\n" + extra if extra else ""))


@register("class_share", explore_views() + """
SELECT churn, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM sx GROUP BY 1""")
def q_class_share(spark, sf):
    out = E.class_share(subs_explore(spark, sf), "churn")
    return out.select("churn", "n", r6("pct").alias("pct"))


XTAB_COLS = ["gender", "senior", "segment", "contract", "payment", "tenure_band"]


@register("crosstab_all", explore_views() + f"""
SELECT "column", value, churn, count(*) AS n FROM ({sql_melt("sx", XTAB_COLS, ids=["churn"])}) GROUP BY 1, 2, 3""")
def q_crosstab_all(spark, sf):
    return E.crosstab_all(subs_explore(spark, sf), XTAB_COLS, "churn")


@register("crosstab_wide", explore_views() + f"""
SELECT "column", value, count(*) FILTER (WHERE churn = 'No') AS "No", count(*) FILTER (WHERE churn = 'Yes') AS "Yes"
FROM ({sql_melt("sx", XTAB_COLS, ids=["churn"])}) GROUP BY 1, 2""")
def q_crosstab_wide(spark, sf):
    return E.crosstab_wide(subs_explore(spark, sf), XTAB_COLS, "churn", ["No", "Yes"])


@register("churn_rate_by_tenure", explore_views() + """
SELECT tenure, count(*) AS n, CAST(sum(churn_flag) AS BIGINT) AS n_flag, round(avg(churn_flag), 6) AS rate
FROM sx GROUP BY 1""")
def q_churn_rate_by_tenure(spark, sf):
    out = E.rate_by(subs_explore(spark, sf), "tenure", "churn_flag")
    return out.select("tenure", "n", F.col("n_flag").cast("bigint").alias("n_flag"), r6("rate").alias("rate"))


MEAN_COLS = ["tenure", "monthly_charges", "total_charges", "mean_charges"]


@register("means_by_class", explore_views() + "SELECT churn, " + ", ".join(
    f"round(avg({c}), 6) AS mean_{c}" for c in MEAN_COLS) + " FROM sx GROUP BY 1")
def q_means_by_class(spark, sf):
    out = E.means_by_class(subs_explore(spark, sf), MEAN_COLS, "churn")
    return out.select("churn", *[r6(f"mean_{c}").alias(f"mean_{c}") for c in MEAN_COLS])


@register("histogram_monthly", explore_views(extra="""
mm AS (SELECT min(monthly_charges) AS xmin, max(monthly_charges) AS xmax FROM sx),
bb AS (SELECT CAST(CASE WHEN xmax = xmin THEN 0 ELSE least(floor((monthly_charges - xmin) / ((xmax - xmin) / 30.0)), 29)
              END AS INT) AS bin FROM sx, mm WHERE monthly_charges IS NOT NULL)""") + """
SELECT CAST(k AS INT) AS bin, round(xmin + k * ((xmax - xmin) / 30.0), 6) AS lo,
       round(xmin + (k + 1) * ((xmax - xmin) / 30.0), 6) AS hi, (SELECT count(*) FROM bb WHERE bb.bin = k) AS n
FROM range(0, 30) r(k), mm WHERE xmax > xmin OR (xmax = xmin AND k = 0)""")
def q_histogram_monthly(spark, sf):
    out = E.histogram(subs_explore(spark, sf), "monthly_charges", 30)
    return out.select("bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "n")


@register("density_tenure", explore_views(extra="""
d AS (SELECT churn AS c, CAST(tenure AS DOUBLE) AS x FROM sx WHERE tenure IS NOT NULL AND churn IS NOT NULL),
st AS (SELECT c, count(*) AS n, pow(count(*), -0.2) * stddev_samp(x) AS h, min(x) AS mn, max(x) AS mx FROM d GROUP BY c),
st3 AS (SELECT c, n, h, mn - 3.0 * h AS g0, (mx - mn + 6.0 * h) / 199 AS step FROM st WHERE h > 0),
dv AS (SELECT c, x, count(*) AS cnt FROM d GROUP BY 1, 2)""") + """
SELECT st3.c AS churn, CAST(g.g AS INT) AS grid_index, round(g0 + g.g * step, 6) AS x,
       round(sum(cnt * exp(-0.5 * ((g0 + g.g * step - dv.x) / h) * ((g0 + g.g * step - dv.x) / h)))
             / (n * h * sqrt(2 * pi())), 6) AS density
FROM dv JOIN st3 ON st3.c = dv.c CROSS JOIN range(0, 200) g(g) GROUP BY st3.c, g.g, g0, step, n, h""")
def q_density_tenure(spark, sf):
    out = E.density(subs_explore(spark, sf), "tenure", "churn")
    return out.select("churn", "grid_index", r6("x").alias("x"), r6("density").alias("density"))


@register("density_monthly", ORACLE["density_tenure"].replace("CAST(tenure AS DOUBLE)", "CAST(monthly_charges AS DOUBLE)")
          .replace("tenure IS NOT NULL", "monthly_charges IS NOT NULL"))
def q_density_monthly(spark, sf):
    """A continuous column: bins and one convolution a class, held against the direct sum."""
    out = E.density_binned(subs_explore(spark, sf), "monthly_charges", "churn")
    return out.select("churn", "grid_index", r6("x").alias("x"), r6("density").alias("density"))


@register("box_monthly_by_contract", explore_views(extra="""
d AS (SELECT contract, churn, monthly_charges AS y FROM sx WHERE monthly_charges IS NOT NULL),
q AS (SELECT contract, churn, count(*) AS n, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS med,
             quantile_cont(y, 0.75) AS q3 FROM d GROUP BY 1, 2),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)""") + """
SELECT f.contract, f.churn, f.n, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
       round(iqr, 6) AS iqr, round(min(y) FILTER (WHERE y >= lo AND y <= hi), 6) AS whisker_lo,
       round(max(y) FILTER (WHERE y >= lo AND y <= hi), 6) AS whisker_hi,
       count(*) FILTER (WHERE y < lo OR y > hi) AS n_outliers
FROM f JOIN d ON d.contract = f.contract AND d.churn = f.churn
GROUP BY f.contract, f.churn, f.n, q1, med, q3, iqr""")
def q_box_monthly_by_contract(spark, sf):
    out = E.box_stats(subs_explore(spark, sf), "contract", "monthly_charges", "churn")
    return out.select("contract", "churn", "n", *[r6(c).alias(c) for c in
                                                  ["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"]],
                      "n_outliers")


CORR_COLS = ["tenure", "monthly_charges", "total_charges", "churn_flag"]


@register("corr_matrix", explore_views() + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM sx"
    for a in CORR_COLS for b in CORR_COLS))
def q_corr_matrix(spark, sf):
    out = E.corr_matrix(subs_explore(spark, sf), CORR_COLS)
    return out.select("col_a", "col_b", r6("corr").alias("corr"))


@register("count_distinct_all", with_views("subscribers") + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM subscribers" for c in RAW_COLS))
def q_count_distinct_all(spark, sf):
    return E.count_distinct_all(FX.subscribers(spark, sf), RAW_COLS)


# ---------------------------------------------------------------------------
# significance tests (statistic checked by the oracle, p by unit tests)
# ---------------------------------------------------------------------------

@register("chi_square", explore_views(extra=f"""
cells AS (SELECT "column", value, churn, count(*) AS o
          FROM ({sql_melt("sx", XTAB_COLS, ids=["churn"])}) WHERE value IS NOT NULL AND churn IS NOT NULL GROUP BY 1, 2, 3),
vals AS (SELECT DISTINCT "column", value FROM cells),
cls AS (SELECT DISTINCT churn FROM cells),
grid AS (SELECT v."column", v.value, c.churn, coalesce(cells.o, 0) AS o FROM vals v CROSS JOIN cls c
         LEFT JOIN cells ON cells."column" = v."column" AND cells.value = v.value AND cells.churn = c.churn),
rt AS (SELECT "column", value, sum(o) AS rt FROM grid GROUP BY 1, 2),
ct AS (SELECT "column", churn, sum(o) AS ct FROM grid GROUP BY 1, 2),
nt AS (SELECT "column", sum(o) AS n, count(DISTINCT value) AS r FROM grid GROUP BY 1),
kp AS (SELECT "column", count(*) FILTER (WHERE ct > 0) AS kp FROM ct GROUP BY 1),
e AS (SELECT g."column", g.o, rt.rt * ct.ct / nt.n AS e, ct.ct FROM grid g
      JOIN rt ON rt."column" = g."column" AND rt.value = g.value
      JOIN ct ON ct."column" = g."column" AND ct.churn = g.churn JOIN nt ON nt."column" = g."column"),
agg AS (SELECT "column", sum(CASE WHEN ct > 0 THEN (o - e) * (o - e) / e ELSE 0 END) AS plain,
               sum(CASE WHEN ct > 0 THEN (o + least(0.5, abs(e - o)) * sign(e - o) - e)
                                         * (o + least(0.5, abs(e - o)) * sign(e - o) - e) / e ELSE 0 END) AS yates
        FROM e GROUP BY 1)""") + """
SELECT agg."column", round(CASE WHEN (r - 1) * (kp - 1) = 1 THEN yates ELSE plain END, 6) AS statistic,
       CAST((r - 1) * (kp - 1) AS BIGINT) AS dof
FROM agg JOIN nt ON nt."column" = agg."column" JOIN kp ON kp."column" = agg."column\"""")
def q_chi_square(spark, sf):
    from churnlens.operators.stats import chi_square
    out = chi_square(subs_explore(spark, sf), XTAB_COLS, "churn", with_p=False)
    return out.select("column", r6("statistic").alias("statistic"), "dof")


@register("chi_square_tests")
def q_chi_square_tests(spark, sf):
    from churnlens.operators.stats import chi_square
    out = chi_square(subs_explore(spark, sf), XTAB_COLS, "churn", with_p=True)
    return out.select("column", r6("statistic").alias("statistic"), "dof", r6("p_value").alias("p_value"), "significant")


@register("t_test", explore_views(extra=f"""
l AS (SELECT * FROM ({sql_melt("sx", MEAN_COLS, ids=["churn"], cast="DOUBLE")})
      WHERE churn IN ('Yes', 'No') AND value IS NOT NULL),
g AS (SELECT "column", count(*) FILTER (WHERE churn = 'Yes') AS n1, count(*) FILTER (WHERE churn = 'No') AS n2,
             avg(value) FILTER (WHERE churn = 'Yes') AS m1, avg(value) FILTER (WHERE churn = 'No') AS m2,
             var_samp(value) FILTER (WHERE churn = 'Yes') AS v1, var_samp(value) FILTER (WHERE churn = 'No') AS v2
      FROM l GROUP BY 1)""") + """
SELECT "column", round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)), 6)
       AS statistic, CAST(n1 + n2 - 2 AS BIGINT) AS dof, round(m1, 6) AS mean_pos, round(m2, 6) AS mean_neg FROM g""")
def q_t_test(spark, sf):
    from churnlens.operators.stats import t_test
    out = t_test(subs_explore(spark, sf), MEAN_COLS, "churn", with_p=False)
    return out.select("column", r6("statistic").alias("statistic"), "dof", r6("mean_pos").alias("mean_pos"),
                      r6("mean_neg").alias("mean_neg"))


@register("t_tests")
def q_t_tests(spark, sf):
    from churnlens.operators.stats import t_test
    out = t_test(subs_explore(spark, sf), MEAN_COLS, "churn", with_p=True)
    return out.select("column", r6("statistic").alias("statistic"), "dof", r6("p_value").alias("p_value"), "significant")


# ---------------------------------------------------------------------------
# Drift (orders before / from the split date)
# ---------------------------------------------------------------------------

DRIFT_NUM = ["o_totalprice"]
DRIFT_CAT = ["o_orderpriority", "o_orderstatus"]


def sql_side_counts(cols, cast, ref="drift_ref", cur="drift_cur") -> str:
    u = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS {cast}) AS value, {side} AS side FROM {src}"
                           for c in cols for side, src in ((0, ref), (1, cur)))
    return (f"SELECT \"column\", value, count(*) FILTER (WHERE side = 0) AS a, count(*) FILTER (WHERE side = 1) AS b "
            f"FROM ({u}) WHERE value IS NOT NULL GROUP BY 1, 2")


def sql_ecdf(cols, ref="drift_ref", cur="drift_cur") -> str:
    return f"""SELECT "column", value,
        sum(a) OVER w / sum(a) OVER (PARTITION BY "column") AS f,
        sum(b) OVER w / sum(b) OVER (PARTITION BY "column") AS g,
        sum(a) OVER (PARTITION BY "column") AS ta, sum(b) OVER (PARTITION BY "column") AS tb,
        lead(value) OVER (PARTITION BY "column" ORDER BY value) AS nxt
      FROM ({sql_side_counts(cols, "DOUBLE", ref, cur)})
      WINDOW w AS (PARTITION BY "column" ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def sql_wasserstein(cols, ref="drift_ref", cur="drift_cur") -> str:
    sd = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", stddev_pop(CAST({c} AS DOUBLE)) AS sd FROM {ref}"
                            for c in cols)
    return f"""SELECT e."column", CASE WHEN sd > 0 THEN w / sd ELSE w END AS statistic FROM
      (SELECT "column", sum(CASE WHEN nxt IS NOT NULL THEN abs(f - g) * (nxt - value) ELSE 0 END) AS w
       FROM ({sql_ecdf(cols, ref, cur)}) GROUP BY 1) e JOIN ({sd}) s ON s."column" = e."column\""""


def sql_shares(cols, ref="drift_ref", cur="drift_cur") -> str:
    return f"""SELECT *, sum(a) OVER (PARTITION BY "column") AS ta, sum(b) OVER (PARTITION BY "column") AS tb,
        count(*) OVER (PARTITION BY "column") AS k, min(value) OVER (PARTITION BY "column") AS first_value
      FROM ({sql_side_counts(cols, "VARCHAR", ref, cur)})"""


def sql_js(cols, ref="drift_ref", cur="drift_cur") -> str:
    return f"""SELECT "column", sqrt(greatest(sum(
        CASE WHEN a > 0 THEN (a / ta) * ln((a / ta) / ((a / ta + b / tb) / 2)) ELSE 0 END +
        CASE WHEN b > 0 THEN (b / tb) * ln((b / tb) / ((a / ta + b / tb) / 2)) ELSE 0 END) / 2, 0.0)) AS statistic
      FROM ({sql_shares(cols, ref, cur)}) GROUP BY 1"""


@register("ks_drift", with_views("drift") + f"""
SELECT "column", round(max(abs(f - g)), 6) AS statistic, CAST(max(ta) AS BIGINT) AS n_ref,
       CAST(max(tb) AS BIGINT) AS n_cur FROM ({sql_ecdf(DRIFT_NUM)}) GROUP BY 1""")
def q_ks_drift(spark, sf):
    from churnlens.operators.drift import ks_two_sample
    ref, cur = FX.drift_sides(spark, sf)
    out = ks_two_sample(ref, cur, DRIFT_NUM, with_p=False)
    return out.select("column", r6("statistic").alias("statistic"), "n_ref", "n_cur")


@register("wasserstein_drift", with_views("drift") + f"""
SELECT "column", round(statistic, 6) AS statistic FROM ({sql_wasserstein(DRIFT_NUM)})""")
def q_wasserstein_drift(spark, sf):
    from churnlens.operators.drift import wasserstein_norm
    ref, cur = FX.drift_sides(spark, sf)
    return wasserstein_norm(ref, cur, DRIFT_NUM).select("column", r6("statistic").alias("statistic"))


@register("js_drift", with_views("drift") + f"""
SELECT "column", round(statistic, 6) AS statistic FROM ({sql_js(DRIFT_CAT)})""")
def q_js_drift(spark, sf):
    from churnlens.operators.drift import js_distance
    ref, cur = FX.drift_sides(spark, sf)
    return js_distance(ref, cur, DRIFT_CAT).select("column", r6("statistic").alias("statistic"))


def sql_category_shift_raw(cols, ref="drift_ref", cur="drift_cur") -> str:
    return f"""SELECT "column", CASE WHEN max(k) = 2 THEN 'z' ELSE 'chi_square' END AS test,
       CASE WHEN max(k) = 2 THEN max(CASE WHEN value = first_value THEN
             (a / ta - b / tb) / sqrt(((a + b) / (ta + tb)) * (1 - (a + b) / (ta + tb)) * (1.0 / ta + 1.0 / tb)) END)
             ELSE sum((a - (a + b) * ta / (ta + tb)) * (a - (a + b) * ta / (ta + tb)) / ((a + b) * ta / (ta + tb))
                      + (b - (a + b) * tb / (ta + tb)) * (b - (a + b) * tb / (ta + tb)) / ((a + b) * tb / (ta + tb)))
             END AS statistic,
       CAST(max(k) - 1 AS BIGINT) AS dof
FROM ({sql_shares(cols, ref, cur)}) GROUP BY 1"""


@register("category_shift", with_views("drift") + f"""
SELECT "column", test, round(statistic, 6) AS statistic, dof FROM ({sql_category_shift_raw(DRIFT_CAT)})""")
def q_category_shift(spark, sf):
    from churnlens.operators.drift import category_shift
    ref, cur = FX.drift_sides(spark, sf)
    out = category_shift(ref, cur, DRIFT_CAT, with_p=False)
    return out.select("column", "test", r6("statistic").alias("statistic"), "dof")


def _sql_report(num_sql: str, cat_sql: str) -> str:
    return f"""SELECT "column", 'numeric' AS kind, 'wasserstein' AS method, round(statistic, 6) AS statistic,
       round(statistic, 6) AS score, CAST(0.1 AS DOUBLE) AS threshold, statistic >= 0.1 AS drifted FROM ({num_sql})
UNION ALL SELECT "column", 'categorical', 'jensen_shannon', round(statistic, 6), round(statistic, 6),
       CAST(0.1 AS DOUBLE), statistic >= 0.1 FROM ({cat_sql})"""


def sql_gamma_q(a: str, x: str) -> str:
    """Upper regularised incomplete gamma Q(a, x) by its power series (enough
    terms for the series to pass its peak near k = x)."""
    return f"""(CASE WHEN {x} <= 0 THEN 1.0 ELSE greatest(0.0, 1.0 - (SELECT sum(exp(({a} + k) * ln({x}) - {x}
               - lgamma({a} + k + 1))) FROM range(0, CAST({x} + 10 * sqrt({x}) + 200 AS BIGINT)) t(k))) END)"""


def sql_t_p(t: str, dof: str, steps: int = 40_000) -> str:
    """Two-sided p of Student's t: the share of the integral of cos^(dof - 1) beyond atan(|t| / sqrt(dof)), by Simpson's rule."""
    def area(start: str) -> str:
        width = f"((pi() / 2 - ({start})) / {steps})"
        weight = f"CASE WHEN k = 0 OR k = {steps} THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END"
        return f"(SELECT sum({weight} * pow(greatest(cos(({start}) + k * {width}), 0.0), {dof} - 1)) * {width} / 3 FROM range(0, {steps} + 1) t(k))"
    return f"({area(f'atan(abs({t}) / sqrt({dof}))')} / {area('0.0')})"


def _unrounded(name: str, rounded: str) -> str:
    if rounded not in ORACLE[name]:
        raise ValueError(f"{name} has no {rounded}")
    return ORACLE[name].replace(rounded, rounded.removeprefix("round(").removesuffix(", 6)"))


def _with_p(raw: str, p: str) -> str:
    return f"""SELECT "column", round(statistic, 6) AS statistic, dof, round(p, 6) AS p_value, p < 0.05 AS significant
FROM (SELECT *, {p} AS p FROM ({raw}))"""


ORACLE["chi_square_tests"] = _with_p(_unrounded("chi_square", "round(CASE WHEN (r - 1) * (kp - 1) = 1 THEN yates ELSE plain END, 6)"),
                                     sql_gamma_q("(dof / 2e0)", "(statistic / 2e0)"))
ORACLE["t_tests"] = _with_p(_unrounded("t_test", "round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)), 6)"),
                            sql_t_p("statistic", "dof"))


def _sql_report_tests(num_cols, cat_cols, ref, cur) -> str:
    """The small-reference branch: KS (asymptotic p) and z / chi-square tests at 0.05."""
    ks = f"""SELECT "column", 'numeric' AS kind, 'ks' AS method, round(d, 6) AS statistic, round(p, 6) AS score,
       CAST(0.05 AS DOUBLE) AS threshold, p < 0.05 AS drifted
    FROM (SELECT "column", d, CASE WHEN lam < 0.001 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * (SELECT
            sum(CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * lam * lam)) FROM range(1, 101) t(k))))
          END AS p
          FROM (SELECT "column", d, (en + 0.12 + 0.11 / en) * d AS lam FROM
                (SELECT "column", max(abs(f - g)) AS d,
                        sqrt(CAST(max(ta) AS DOUBLE) * max(tb) / (CAST(max(ta) AS DOUBLE) + max(tb))) AS en
                 FROM ({sql_ecdf(num_cols, ref, cur)}) GROUP BY 1)))"""
    cat = f"""SELECT "column", 'categorical' AS kind, test AS method, round(statistic, 6) AS statistic,
       round(p, 6) AS score, CAST(0.05 AS DOUBLE) AS threshold, p < 0.05 AS drifted
    FROM (SELECT *, {sql_gamma_q("qa", "qx")} AS p FROM
          (SELECT "column", test, statistic, CASE WHEN test = 'z' THEN 0.5 ELSE dof / 2.0 END AS qa,
                  CASE WHEN test = 'z' THEN statistic * statistic / 2.0 ELSE statistic / 2.0 END AS qx
           FROM ({sql_category_shift_raw(cat_cols, ref, cur)})))"""
    return f"{ks} UNION ALL {cat}"


def sql_report_all(num_cols, cat_cols, ref="drift_ref", cur="drift_cur", method="distance") -> str:
    """F7 by distances or by tests."""
    if method == "test":
        return _sql_report_tests(num_cols, cat_cols, ref, cur)
    return _sql_report(sql_wasserstein(num_cols, ref, cur), sql_js(cat_cols, ref, cur))


def _report_cols(df):
    return df.select("column", "kind", "method", r6("statistic").alias("statistic"), r6("score").alias("score"),
                     "threshold", "drifted")


@register("drift_report", with_views("drift") + sql_report_all(DRIFT_NUM, DRIFT_CAT))
def q_drift_report(spark, sf):
    from churnlens.operators.drift import drift_report
    ref, cur = FX.drift_sides(spark, sf)
    return _report_cols(drift_report(ref, cur, DRIFT_NUM + DRIFT_CAT))


@register("drift_report_tests", with_views("drift") + sql_report_all(DRIFT_NUM, DRIFT_CAT, method="test"))
def q_drift_report_tests(spark, sf):
    from churnlens.operators.drift import drift_report
    ref, cur = FX.drift_sides(spark, sf)
    return _report_cols(drift_report(ref, cur, DRIFT_NUM + DRIFT_CAT, method="test"))


@register("drift_decision", with_views("drift", extra=f"""
rep AS ({sql_report_all(DRIFT_NUM, DRIFT_CAT)}),
sh AS (SELECT count(*) AS n_columns, count(*) FILTER (WHERE drifted) AS drift_count,
              avg(CAST(drifted AS DOUBLE)) AS drift_share FROM rep)""") + """
SELECT n_columns, drift_count, round(drift_share, 6) AS drift_share,
       CASE WHEN drift_share > 0.5 THEN 'retrain' WHEN drift_share >= 0.4 THEN 'critical'
            WHEN drift_share >= 0.3 THEN 'early' ELSE 'healthy' END AS level FROM sh""")
def q_drift_decision(spark, sf):
    from churnlens.operators.decide import drift_level
    from churnlens.operators.drift import drift_report, drift_share
    ref, cur = FX.drift_sides(spark, sf)
    out = drift_level(drift_share(drift_report(ref, cur, DRIFT_NUM + DRIFT_CAT)))
    return out.select("n_columns", "drift_count", r6("drift_share").alias("drift_share"), "level")


LOG_FEATURES_NUM = ["tenure", "monthly_charges", "total_charges"]
LOG_FEATURES_CAT = ["gender", "senior", "segment", "contract", "payment"]
LAST_N = 1000


def logged_features(spark, sf, cleaned=None):
    """Inference log joined with the subscriber features it scored."""
    log = FX.prediction_log(spark, sf).select("request_id", "customer_id", "event_time")
    return log.join(cleaned if cleaned is not None else clean_subscribers(spark, sf), "customer_id")


@register("drift_last_n", subs_clean_views(extra=f"""
pl AS ({SQL_VIEWS_PL}),
lf AS (SELECT l.request_id, l.event_time, s.* FROM pl l JOIN subs_clean s ON s.customer_id = l.customer_id),
cur AS (SELECT * FROM lf ORDER BY event_time DESC NULLS LAST, request_id DESC LIMIT {LAST_N})""")
    + sql_report_all(LOG_FEATURES_NUM, LOG_FEATURES_CAT, "subs_clean", "cur"))
def q_drift_last_n(spark, sf):
    from churnlens.operators.drift import drift_last_n
    ref = clean_subscribers(spark, sf)
    out = drift_last_n(ref, logged_features(spark, sf, ref), LOG_FEATURES_NUM + LOG_FEATURES_CAT, LAST_N,
                       "event_time", "request_id")
    return _report_cols(out)


# ---------------------------------------------------------------------------
# Metrics and decisions over the prediction log
# ---------------------------------------------------------------------------

STAGE_BY = ["model_stage", "model_version"]
METRIC_COLS = ["accuracy", "precision", "recall", "f1"]


def sql_confusion(src: str, cut: str, by=STAGE_BY) -> str:
    b = ", ".join(by)
    return f"""SELECT {b}, count(*) AS n,
        count(*) FILTER (WHERE label = 1 AND probability {cut} 0.5) AS tp,
        count(*) FILTER (WHERE label = 0 AND probability {cut} 0.5) AS fp,
        count(*) FILTER (WHERE label = 1 AND NOT (probability {cut} 0.5)) AS fn,
        count(*) FILTER (WHERE label = 0 AND NOT (probability {cut} 0.5)) AS tn,
        avg(latency) AS mean_latency
      FROM {src} WHERE label IS NOT NULL GROUP BY {b}"""


SQL_METRICS = """CASE WHEN tp + fp + fn + tn > 0 THEN (tp + tn) / (tp + fp + fn + tn) ELSE 0.0 END AS accuracy,
        CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
        CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
        CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1"""


def sql_auc(src: str, by=STAGE_BY) -> str:
    b = ", ".join(by)
    part = f"PARTITION BY {b}" if by else ""
    sel = f"{b}, " if by else ""
    grp = f"GROUP BY {b}" if by else ""
    return f"""SELECT {sel}CASE WHEN sum(pos) > 0 AND sum(neg) > 0
               THEN sum(pos * (cneg - neg + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS roc_auc
      FROM (SELECT *, sum(neg) OVER ({part} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cneg
            FROM (SELECT {sel}probability AS p, count(*) FILTER (WHERE label = 1) AS pos,
                         count(*) FILTER (WHERE label <> 1) AS neg
                  FROM {src} WHERE probability IS NOT NULL AND label IS NOT NULL
                  GROUP BY {sel}probability)) {grp}"""


def sql_round_metrics(prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{c}, 6) AS {c}" for c in METRIC_COLS)


@register("binary_metrics", with_views("prediction_log") + f"""
SELECT model_stage, model_version, n, tp, fp, fn, tn, {sql_round_metrics()}
FROM (SELECT *, {SQL_METRICS} FROM ({sql_confusion("prediction_log", ">=")}))""")
def q_binary_metrics(spark, sf):
    from churnlens.operators.metrics import binary_metrics
    log = C.add_threshold_label(FX.prediction_log(spark, sf), "probability", 0.5, True, "pred")
    out = binary_metrics(log, "label", "pred", by=STAGE_BY)
    return out.select(*STAGE_BY, "n", "tp", "fp", "fn", "tn", *[r6(c).alias(c) for c in METRIC_COLS])


@register("roc_auc_by_stage", with_views("prediction_log") + f"""
SELECT model_stage, model_version, round(roc_auc, 6) AS roc_auc FROM ({sql_auc("prediction_log")})""")
def q_roc_auc_by_stage(spark, sf):
    from churnlens.operators.metrics import roc_auc
    out = roc_auc(FX.prediction_log(spark, sf), "label", "probability", by=STAGE_BY)
    return out.select(*STAGE_BY, r6("roc_auc").alias("roc_auc"))


@register("roc_auc_overall", with_views("prediction_log") + f"""
SELECT round(roc_auc, 6) AS roc_auc FROM ({sql_auc("prediction_log", by=[])})""")
def q_roc_auc_overall(spark, sf):
    from churnlens.operators.metrics import roc_auc
    return roc_auc(FX.prediction_log(spark, sf), "label", "probability").select(r6("roc_auc").alias("roc_auc"))


def sql_stage_metrics(src: str = "prediction_log", by=STAGE_BY, min_n: int = 30) -> str:
    j = " AND ".join(f"a.{c} = u.{c}" for c in by)
    return f"""SELECT c.*, {SQL_METRICS.replace("tp", "c.tp").replace("fp", "c.fp").replace("fn", "c.fn")
                           .replace("tn", "c.tn")}, u.roc_auc
      FROM ({sql_confusion(src, ">", by)}) c
      LEFT JOIN ({sql_auc(src, by)}) u ON {j.replace("a.", "c.")}
      WHERE c.n >= {min_n}"""


@register("stage_metrics", with_views("prediction_log") + f"""
SELECT model_stage, model_version, n AS num_samples, {sql_round_metrics()}, round(roc_auc, 6) AS roc_auc,
       round(mean_latency, 6) AS mean_latency FROM ({sql_stage_metrics()})""")
def q_stage_metrics(spark, sf):
    from churnlens.operators.metrics import stage_metrics
    out = stage_metrics(FX.prediction_log(spark, sf))
    return out.select(*STAGE_BY, "num_samples", *[r6(c).alias(c) for c in METRIC_COLS + ["roc_auc", "mean_latency"]])


def sql_canary(sm: str, by=()) -> str:
    b = "".join(f"{c}, " for c in by)
    g = f"GROUP BY {', '.join(by)}" if by else ""
    return f"""SELECT {b}prod_f1, stag_f1, prod_latency, stag_latency, stag_samples, prod_version, stag_version,
         prod_f1 - 0.1 * prod_latency AS prod_score, stag_f1 - 0.1 * stag_latency AS stag_score,
         (stag_f1 - 0.1 * stag_latency > prod_f1 - 0.1 * prod_latency + 0.01 AND stag_latency <= 2.0
          AND stag_samples >= 30) AS promote
      FROM (SELECT {b}
          coalesce(max(m.f1) FILTER (WHERE model_stage = 'Production'), 0.0) AS prod_f1,
          coalesce(max(m.f1) FILTER (WHERE model_stage = 'Staging'), 0.0) AS stag_f1,
          coalesce(max(m.lat) FILTER (WHERE model_stage = 'Production'), 0.0) AS prod_latency,
          coalesce(max(m.lat) FILTER (WHERE model_stage = 'Staging'), 0.0) AS stag_latency,
          coalesce(max(m.n) FILTER (WHERE model_stage = 'Staging'), 0) AS stag_samples,
          max(m.v) FILTER (WHERE model_stage = 'Production') AS prod_version,
          max(m.v) FILTER (WHERE model_stage = 'Staging') AS stag_version
        FROM (SELECT {b}model_stage, arg_max({{'f1': f1, 'lat': mean_latency, 'n': n, 'v': model_version}},
                     TRY_CAST(regexp_extract(model_version, '(\\d+)', 1) AS INT)) AS m
              FROM ({sm}) GROUP BY {b}model_stage) {g})"""


@register("canary_decision", with_views("prediction_log") + f"""
SELECT round(prod_f1, 6) AS prod_f1, round(stag_f1, 6) AS stag_f1, round(prod_latency, 6) AS prod_latency,
       round(stag_latency, 6) AS stag_latency, stag_samples, prod_version, stag_version,
       round(prod_score, 6) AS prod_score, round(stag_score, 6) AS stag_score, promote,
       CASE WHEN promote THEN 'Staging' ELSE 'Production' END AS better_model
FROM ({sql_canary(sql_stage_metrics())})""")
def q_canary_decision(spark, sf):
    from churnlens.operators.decide import canary_decision
    from churnlens.operators.metrics import stage_metrics
    d = canary_decision(stage_metrics(FX.prediction_log(spark, sf), with_auc=False))
    return d.select(*[r6(c).alias(c) for c in ["prod_f1", "stag_f1", "prod_latency", "stag_latency"]],
                    "stag_samples", "prod_version", "stag_version", r6("prod_score").alias("prod_score"),
                    r6("stag_score").alias("stag_score"), "promote", "better_model")


SQL_DECAY = ("CASE WHEN f1 < 0.8 THEN 'retrain' WHEN f1 < 0.8 * 1.05 THEN 'critical' "
             "WHEN f1 < 0.8 * 1.1 THEN 'early' ELSE 'healthy' END")


@register("decay_levels", with_views("prediction_log") + f"""
SELECT model_stage, model_version, round(f1, 6) AS f1, {SQL_DECAY} AS level
FROM (SELECT *, {SQL_METRICS} FROM ({sql_confusion("prediction_log", ">=")}))""")
def q_decay_levels(spark, sf):
    from churnlens.operators.decide import decay_level
    from churnlens.operators.metrics import binary_metrics
    log = C.add_threshold_label(FX.prediction_log(spark, sf), "probability", 0.5, True, "pred")
    out = decay_level(binary_metrics(log, "label", "pred", by=STAGE_BY))
    return out.select(*STAGE_BY, r6("f1").alias("f1"), "level")


@register("retrain_actions", with_views("prediction_log") + f"""
SELECT model_stage, model_version, 'decay' AS "check", {SQL_DECAY} AS level,
       CASE {SQL_DECAY} WHEN 'retrain' THEN 'combine_data' WHEN 'healthy' THEN 'no_model_decay'
            ELSE 'send_warning_email' END AS action
FROM (SELECT *, {SQL_METRICS} FROM ({sql_confusion("prediction_log", ">=")}))""")
def q_retrain_actions(spark, sf):
    from churnlens.operators.decide import decay_level, retrain_action
    from churnlens.operators.metrics import binary_metrics
    log = C.add_threshold_label(FX.prediction_log(spark, sf), "probability", 0.5, True, "pred")
    lv = decay_level(binary_metrics(log, "label", "pred", by=STAGE_BY)).withColumn("check", F.lit("decay"))
    return retrain_action(lv.select(*STAGE_BY, "check", "level")).select(*STAGE_BY, "check", "level", "action")


@register("rollout_replay", with_views("prediction_log", extra="""
w AS (SELECT *, time_bucket(INTERVAL '6 hours', event_time) AS win FROM prediction_log)""") + f"""
SELECT win AS window_start, CAST(row_number() OVER (ORDER BY win) - 1 AS INT) AS step,
       CAST([0.05, 0.25, 1.0] AS DOUBLE[])[least(row_number() OVER (ORDER BY win) - 1, 2) + 1] AS weight,
       round(prod_score, 6) AS prod_score, round(stag_score, 6) AS stag_score, promote,
       min(CAST(promote AS INT)) OVER (ORDER BY win ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1
         AS still_rolling
FROM ({sql_canary(sql_stage_metrics("w", by=["win"] + STAGE_BY), by=["win"])})""")
def q_rollout_replay(spark, sf):
    from churnlens.operators.decide import rollout_replay
    out = rollout_replay(FX.prediction_log(spark, sf))
    return out.select("window_start", F.col("step").cast("int").alias("step"), "weight",
                      r6("prod_score").alias("prod_score"), r6("stag_score").alias("stag_score"),
                      "promote", "still_rolling")


@register("route_share", with_views("prediction_log") + """
SELECT CASE WHEN CAST('0x' || substr(md5(CAST(request_id AS VARCHAR) || ':canary'), 1, 8) AS BIGINT) % 10000 < 2500
            THEN 'Staging' ELSE 'Production' END AS model_stage, count(*) AS n FROM prediction_log GROUP BY 1""")
def q_route_share(spark, sf):
    from churnlens.operators.decide import route
    routed = route(FX.prediction_log(spark, sf), "request_id", 0.25)
    return routed.groupBy("model_stage").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# G: union, upsert, top-k, sampling, run tables
# ---------------------------------------------------------------------------

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
OVERLAP_FROM = "1997-07-01"


@register("combine_distinct", f"""
SELECT DISTINCT * FROM (
  SELECT {", ".join(ORDER_COLS)} FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
  UNION ALL SELECT {", ".join(ORDER_COLS)} FROM orders WHERE o_orderdate >= TIMESTAMP '{OVERLAP_FROM}')""")
def q_combine_distinct(spark, sf):
    from churnlens.operators.merge import combine_distinct
    o = FX.table(spark, sf, "orders")
    base = o.where(F.col("o_orderdate") < F.lit(FX.DRIFT_SPLIT_DATE).cast("timestamp_ntz"))
    new = o.where(F.col("o_orderdate") >= F.lit(OVERLAP_FROM).cast("timestamp_ntz"))
    return combine_distinct(base, new, ORDER_COLS)


def feedback_rows(spark, sf):
    """Feedback: orders from the split date relabelled, carrying only key, sequence and label."""
    return feedback_of(FX.table(spark, sf, "orders"))


def feedback_of(orders, more=()):
    return (orders.where(F.col("o_orderdate") >= F.lit(FX.DRIFT_SPLIT_DATE).cast("timestamp_ntz"))
            .select("o_custkey", "o_orderkey", F.lit("R").alias("o_orderstatus"), *more))


SQL_UPSERT = """
u AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 0 AS src FROM orders
      UNION ALL SELECT o_custkey, o_orderkey, 'R', NULL, NULL, NULL, 1 FROM orders
      WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
up AS (SELECT * EXCLUDE (rn, src) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
       ORDER BY src DESC, o_orderkey DESC) AS rn FROM u) WHERE rn = 1)"""


@register("upsert_log", "WITH " + SQL_UPSERT + " SELECT * FROM up")
def q_upsert_log(spark, sf):
    from churnlens.operators.merge import upsert_log
    log = FX.table(spark, sf, "orders")
    return upsert_log(log, feedback_rows(spark, sf), "o_custkey", ["o_orderkey"])


@register("upsert_buckets", ORACLE["upsert_log"])
def q_upsert_buckets(spark, sf):
    """The log table in buckets of its key; the feedback rewrites its own buckets only."""
    from churnlens.operators.merge import upsert_log
    from churnlens.session import scratch_path
    from churnlens.sources.buckets import read_bucketed, upsert_bucketed, write_bucketed
    log = FX.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    path = scratch_path(spark, "tables", "orders_by_customer")
    write_bucketed(upsert_log(log, log.limit(0), "o_custkey", ["o_orderkey"]), path, "o_custkey")
    upsert_bucketed(feedback_rows(spark, sf), path, ["o_orderkey"])
    return read_bucketed(spark, path)


@register("upsert_training", "WITH " + SQL_UPSERT + " SELECT count(*) AS rows, 6 AS columns FROM up")
def q_upsert_training(spark, sf):
    from churnlens.operators.merge import upsert_training
    log = FX.table(spark, sf, "orders")
    _, report = upsert_training(log, feedback_rows(spark, sf), "o_custkey",
                                ["o_custkey", "o_orderkey", "o_orderstatus"], ["o_orderkey"])
    return report.select("rows", F.col("columns").cast("int").alias("columns"))


TOP_COLS = ["request_id", "customer_id", "event_time", "probability", "model_stage"]


@register("top_recent", with_views("prediction_log") + f"""
SELECT {", ".join(TOP_COLS)} FROM prediction_log ORDER BY event_time DESC NULLS LAST, request_id DESC LIMIT 50""")
def q_top_recent(spark, sf):
    from churnlens.operators.merge import top_recent
    return top_recent(FX.prediction_log(spark, sf), 50, "event_time", "request_id", TOP_COLS)


@register("last_n_log", with_views("prediction_log") + """
SELECT * FROM prediction_log ORDER BY event_time DESC NULLS LAST, request_id DESC LIMIT 200""")
def q_last_n_log(spark, sf):
    from churnlens.operators.merge import last_n
    return last_n(FX.prediction_log(spark, sf), 200, "event_time", "request_id")


@register("sample_n", """
SELECT * FROM customer ORDER BY md5(CAST(c_custkey AS VARCHAR) || ':42'), c_custkey LIMIT 100""")
def q_sample_n(spark, sf):
    from churnlens.operators.merge import sample_n
    return sample_n(FX.table(spark, sf, "customer"), 100, 42, "c_custkey")


@register("preview", with_views("subscribers") + "SELECT * FROM subscribers ORDER BY customer_id LIMIT 5")
def q_preview(spark, sf):
    from churnlens.operators.merge import preview
    return preview(FX.subscribers(spark, sf), 5, ["customer_id"])


def model_runs(spark, sf):
    """Run table derived from the log: one run per (stage, version), metrics as a map."""
    from churnlens.operators.metrics import binary_metrics, roc_auc
    log = C.add_threshold_label(FX.prediction_log(spark, sf), "probability", 0.5, True, "pred")
    m = binary_metrics(log, "label", "pred", by=STAGE_BY).join(
        roc_auc(log, "label", "probability", by=STAGE_BY), STAGE_BY)
    names = METRIC_COLS + ["roc_auc"]
    return m.select(F.col("model_version").alias("version"), F.col("model_stage").alias("stage"),
                    F.concat(F.lit("run-"), F.col("model_version")).alias("run_id"),
                    F.concat_ws("-", "model_stage", "model_version").alias("run_name"),
                    F.create_map(*[x for n in names for x in (F.lit(n), F.round(F.col(n), DIGITS))]).alias("metrics"))


SQL_RUNS = f"""
runs AS (SELECT c.model_version AS version, c.model_stage AS stage, 'run-' || c.model_version AS run_id,
                round(c.f1, 6) AS f1, round(c.accuracy, 6) AS accuracy, round(c."precision", 6) AS "precision",
                round(c.recall, 6) AS recall, round(u.roc_auc, 6) AS roc_auc
         FROM (SELECT *, {SQL_METRICS} FROM ({sql_confusion("prediction_log", ">=")})) c
         JOIN ({sql_auc("prediction_log")}) u ON u.model_stage = c.model_stage AND u.model_version = c.model_version)"""


@register("best_run", with_views("prediction_log", extra=SQL_RUNS) + """
SELECT version, stage, run_id, f1 FROM runs ORDER BY f1 DESC NULLS LAST, run_id LIMIT 1""")
def q_best_run(spark, sf):
    from churnlens.operators.merge import best_run
    b = best_run(model_runs(spark, sf), "f1")
    return b.select("version", "stage", "run_id", F.col("metrics")["f1"].alias("f1"))


@register("latest_in_stage", with_views("prediction_log", extra="""
v AS (SELECT DISTINCT model_version AS version, model_stage AS stage FROM prediction_log)""") + """
SELECT 'Production' AS target_stage, arg_max(version, (stage = 'Production', TRY_CAST(regexp_extract(version,
       '(\\d+)', 1) AS INT))) AS version FROM v
UNION ALL SELECT 'Archived', arg_max(version, (stage = 'Archived', TRY_CAST(regexp_extract(version, '(\\d+)', 1)
       AS INT))) FROM v""")
def q_latest_in_stage(spark, sf):
    from churnlens.operators.merge import latest_in_stage
    v = FX.prediction_log(spark, sf).select(F.col("model_version").alias("version"),
                                            F.col("model_stage").alias("stage")).distinct()
    parts = [latest_in_stage(v, s).select(F.lit(s).alias("target_stage"), "version") for s in ("Production", "Archived")]
    return parts[0].unionByName(parts[1])


@register("version_metrics", with_views("prediction_log", extra=SQL_RUNS) + """
SELECT version, stage, accuracy, f1, "precision", recall, roc_auc FROM runs""")
def q_version_metrics(spark, sf):
    from churnlens.operators.merge import version_metrics
    return version_metrics(model_runs(spark, sf), METRIC_COLS + ["roc_auc"])


# ---------------------------------------------------------------------------
# A3, B2: record parsing and type contract
# ---------------------------------------------------------------------------

@register("parse_records", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events""")
def q_parse_records(spark, sf):
    from churnlens.sources.io import parse_records
    ev = FX.table(spark, sf, "events")
    return parse_records(ev, "props", "k int").select("event_id", "k")


@register("parse_csv_text", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""")
def q_parse_csv_text(spark, sf):
    """Each order arrives as a small CSV upload (header + one line)."""
    from churnlens.sources.io import parse_csv_text
    o = FX.table(spark, sf, "orders")
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in ["o_orderkey", "o_custkey", "o_orderstatus",
                                                                 "o_totalprice"]])
    docs = o.select(F.concat(F.lit("o_orderkey,o_custkey,o_orderstatus,o_totalprice\n"), line).alias("body"))
    return parse_csv_text(docs, "body", "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
                                        "o_totalprice double")


@register("enforce_types", with_views("subscribers") + """
SELECT customer_id, TRY_CAST(trim(total_charges_raw) AS DOUBLE) AS total_charges, tenure,
       CASE WHEN total_charges_raw IS NOT NULL AND trim(total_charges_raw) <> ''
                 AND TRY_CAST(trim(total_charges_raw) AS DOUBLE) IS NULL THEN 'total_charges' END AS bad_field
FROM subscribers""")
def q_enforce_types(spark, sf):
    from pyspark.sql import types as T
    from churnlens.operators.quality import enforce_types
    raw = FX.subscribers(spark, sf).withColumnRenamed("total_charges_raw", "total_charges")
    schema = T.StructType([T.StructField("customer_id", T.StringType()),
                           T.StructField("total_charges", T.DoubleType()),
                           T.StructField("tenure", T.IntegerType())])
    return enforce_types(raw, schema)


# ---------------------------------------------------------------------------
# H: split, balance, train, score, explain (model outputs: rows-only checks)
# ---------------------------------------------------------------------------

ML_SPEC = {**SUB_SPEC, "drop": ["gender"]}
ML_FEATURES = FEATURE_CATS + SUB_NUMERIC
# demonstration grids for the registered tuning queries (library defaults
# follow the reference configuration, see operators/ml.py)
FOREST_GRID = {"numTrees": [20, 50], "maxDepth": [5, 10]}
BOOSTED_GRID = {"stepSize": [0.05, 0.1], "maxDepth": [3, 6], "maxIter": [20, 40], "subsamplingRate": [0.8, 1.0]}


def ml_table(spark, sf):
    """Prepared features (id kept) with a stratified train/test split."""
    from churnlens.operators.fitted import prepare_training
    from churnlens.operators.ml import stratified_split
    feats, params = prepare_training(raw_subscribers(spark, sf), ML_SPEC)
    return stratified_split(feats, "churn", 0.2, seed=2, key="customer_id"), params


@register("stratified_split", subs_clean_views() + """
SELECT churn, 'test' AS split, CAST(round(0.2 * count(*)) AS BIGINT) AS n FROM
  (SELECT CASE churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS churn FROM subs_clean) GROUP BY churn
UNION ALL SELECT churn, 'train', CAST(count(*) - round(0.2 * count(*)) AS BIGINT) FROM
  (SELECT CASE churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS churn FROM subs_clean) GROUP BY churn""")
def q_stratified_split(spark, sf):
    t, _ = ml_table(spark, sf)
    return t.groupBy("churn", "split").agg(F.count(F.lit(1)).alias("n"))


@register("oversample_minority", subs_clean_views() + """
SELECT churn, max(n) OVER () AS n FROM (SELECT churn, CAST(count(*) - round(0.2 * count(*)) AS BIGINT) AS n FROM
  (SELECT CASE churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS churn FROM subs_clean) GROUP BY churn)""")
def q_oversample_minority(spark, sf):
    from churnlens.operators.ml import oversample_minority
    t, _ = ml_table(spark, sf)
    train = t.where(F.col("split") == "train")
    bal = oversample_minority(train, "churn", ML_FEATURES, k=5, seed=42, key="customer_id")
    return bal.groupBy("churn").agg(F.count(F.lit(1)).alias("n"))


def _train_test(spark, sf):
    from churnlens.session import materialize
    t, params = ml_table(spark, sf)
    t = materialize(t, "ml_split")
    return t.where(F.col("split") == "train"), t.where(F.col("split") == "test"), params


def _scores(model, test):
    from churnlens.operators.ml import score
    s = score(test, model)
    return s.select("customer_id", "churn", r6("probability_1").alias("probability"), "predicted")


@register("forest_scores")
def q_forest_scores(spark, sf):
    from churnlens.operators.ml import train_forest
    train, test, _ = _train_test(spark, sf)
    return _scores(train_forest(train, ML_FEATURES, "churn"), test)


@register("boosted_scores")
def q_boosted_scores(spark, sf):
    from churnlens.operators.ml import train_boosted
    train, test, _ = _train_test(spark, sf)
    return _scores(train_boosted(train, ML_FEATURES, "churn"), test)


@register("mlp_scores")
def q_mlp_scores(spark, sf):
    from churnlens.operators.ml import train_mlp
    train, test, _ = _train_test(spark, sf)
    return _scores(train_mlp(train, ML_FEATURES, "churn"), test)


@register("logistic_scores")
def q_logistic_scores(spark, sf):
    from churnlens.operators.ml import train_logistic
    train, test, _ = _train_test(spark, sf)
    return _scores(train_logistic(train, ML_FEATURES, "churn"), test)


@register("forest_grid_search")
def q_forest_grid_search(spark, sf):
    from pyspark.ml.classification import RandomForestClassifier
    from churnlens.operators.ml import grid_search
    train, _, _ = _train_test(spark, sf)
    # the node that each row has reached is kept, instead of walking every tree from its root at each level
    forest = RandomForestClassifier(seed=42, cacheNodeIds=True)
    cvm = grid_search(train, ML_FEATURES, "churn", forest, FOREST_GRID, folds=3)
    return spark.createDataFrame([(i, float(m)) for i, m in enumerate(cvm.avgMetrics)], "param_set int, mean_f1 double")


@register("boosted_random_search")
def q_boosted_random_search(spark, sf):
    from pyspark.ml.classification import GBTClassifier
    from churnlens.operators.ml import random_search
    train, _, _ = _train_test(spark, sf)
    cvm = random_search(train, ML_FEATURES, "churn", GBTClassifier(seed=42), BOOSTED_GRID, n_iter=5, folds=3)
    return spark.createDataFrame([(i, float(m)) for i, m in enumerate(cvm.avgMetrics)], "param_set int, mean_f1 double")


# Queries about serving, decay and attribution score with a stated logistic model, so that SQL can follow them.
FIXED_WEIGHTS = {"senior": 0.4, "segment": -0.3, "contract": -0.8, "payment": 0.2, "tenure": -1.5,
                 "monthly_charges": 0.9, "total_charges": 0.1}
FIXED_INTERCEPT = 0.5

FEATS_SQL = ("SELECT customer_id, " + ", ".join(sql_code("enc", c, "s") for c in FEATURE_CATS) + ", " + ", ".join(
    f"(CAST(s.{c} AS DOUBLE) - mm.mn_{c}) / CASE WHEN mm.r_{c} = 0 THEN 1.0 ELSE mm.r_{c} END AS {c}"
    for c in SUB_NUMERIC) + " FROM subs_clean s, mm")
MARGIN_SQL = f"{FIXED_INTERCEPT} + " + " + ".join(f"({w}) * {c}" for c, w in FIXED_WEIGHTS.items())


def scored_views(extra: str = "") -> str:
    """View ``sc``: customer_id, features and probability p under the stated model."""
    return subs_clean_views(extra=f"""
enc AS ({sql_encoder("subs_clean")}), mm AS ({sql_mm_params("subs_clean")}),
ft AS ({FEATS_SQL}),
sc AS (SELECT *, 1 / (1 + exp(-({MARGIN_SQL}))) AS p FROM ft)""" + (", " + extra if extra else ""))


def _fixed_model():
    from churnlens.operators.ml import LinearScorer
    return LinearScorer(list(FIXED_WEIGHTS), list(FIXED_WEIGHTS.values()), FIXED_INTERCEPT)


def _served(spark, sf):
    """(features of every subscriber, parameters)."""
    from churnlens.operators.fitted import prepare_training
    feats, params = prepare_training(raw_subscribers(spark, sf), ML_SPEC)
    return feats.select("customer_id", *ML_FEATURES), params


@register("predict_table", scored_views() + f"""
SELECT customer_id, CASE WHEN p >= 0.5 THEN 'Yes' ELSE 'No' END AS "Churn", round(p, 6) AS probability,
       CASE WHEN p < {RISK_CUTS[0]} THEN '{RISK_LABELS[0]}' WHEN p < {RISK_CUTS[1]} THEN '{RISK_LABELS[1]}'
            ELSE '{RISK_LABELS[2]}' END AS risk FROM sc""")
def q_predict_table(spark, sf):
    from churnlens.operators.ml import predict_table
    _, params = _served(spark, sf)
    raw = raw_subscribers(spark, sf)
    out = predict_table(raw, _fixed_model(), params, keep=raw.columns, features=ML_FEATURES, id_col="customer_id")
    return out.select("customer_id", "Churn", r6("probability").alias("probability"), "risk")


@register("decay_check", scored_views(extra=f"""
pl AS ({SQL_VIEWS_PL}),
lg AS (SELECT label AS y, p, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS h FROM pl JOIN sc USING (customer_id)
       WHERE label IS NOT NULL),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE y = 1 AND h = 1) AS tp, count(*) FILTER (WHERE y = 0 AND h = 1) AS fp,
             count(*) FILTER (WHERE y = 1 AND h = 0) AS fn, count(*) FILTER (WHERE y = 0 AND h = 0) AS tn FROM lg),
ps AS (SELECT p, count(*) FILTER (WHERE y = 1) AS a, count(*) FILTER (WHERE y <> 1) AS b FROM lg GROUP BY p),
cu AS (SELECT a, b, sum(b) OVER (ORDER BY p) AS cb FROM ps),
au AS (SELECT sum(a * (cb - b + 0.5 * b)) / (sum(a) * sum(b)) AS auc FROM cu)""") + """
SELECT n, tp, fp, fn, tn, round(CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0 END, 6) AS accuracy,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1,
       round(auc, 6) AS roc_auc,
       (SELECT count(*) FROM pl WHERE label IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM sc)) AS unscored FROM c, au""")
def q_decay_check(spark, sf):
    from churnlens.operators.ml import decay_check
    feats, _ = _served(spark, sf)
    log = FX.prediction_log(spark, sf).select("request_id", "customer_id", "label")
    out = decay_check(log.join(feats, "customer_id", "left"), _fixed_model(), "label", expected=[*ML_FEATURES, "label"])
    return out.select("n", "tp", "fp", "fn", "tn", *[r6(c).alias(c) for c in
                                                     ("accuracy", "precision", "recall", "f1", "roc_auc")], "unscored")


def _linear_phi(spark, sf):
    from churnlens.operators.explain import explain_linear
    feats, _ = _served(spark, sf)
    return explain_linear(feats, "customer_id", ML_FEATURES, [FIXED_WEIGHTS[c] for c in ML_FEATURES], FIXED_INTERCEPT)


LINEAR_PHI_SQL = " UNION ALL ".join(
    f"SELECT customer_id, '{c}' AS feature, ({w}) * ({c} - (SELECT avg({c}) FROM ft)) AS phi FROM ft"
    for c, w in FIXED_WEIGHTS.items())
LINEAR_BASE_SQL = f"{FIXED_INTERCEPT} + " + " + ".join(f"({w}) * avg({c})" for c, w in FIXED_WEIGHTS.items())


@register("explain_linear", scored_views(extra=f"ph AS ({LINEAR_PHI_SQL})") + f"""
SELECT customer_id, feature, round(phi, 6) AS phi, round((SELECT {LINEAR_BASE_SQL} FROM ft), 6) AS base FROM ph""")
def q_explain_linear(spark, sf):
    return _linear_phi(spark, sf).select("customer_id", "feature", r6("phi").alias("phi"), r6("base").alias("base"))


@register("explain_sampled")
def q_explain_sampled(spark, sf):
    from churnlens.operators.explain import default_background, explain_sampled
    from churnlens.operators.ml import train_forest
    train, test, _ = _train_test(spark, sf)
    model = train_forest(train, ML_FEATURES, "churn")
    bg = default_background(train, "customer_id", 100)
    phi = explain_sampled(train.unionByName(test), model, "customer_id", ML_FEATURES, bg)
    return phi.select("customer_id", "feature", r6("phi").alias("phi"), r6("base").alias("base"))


# a stated tree, so that SQL can follow its attributions: id, feature, threshold, left, right, value, cover
TREE_FEATURES = ["contract", "tenure", "monthly_charges"]
STATED_TREE = [(0, 1, 0.35, 1, 2, 0.0, 1000), (1, 0, 0.5, 3, 4, 0.0, 400), (2, 2, 0.5, 5, 6, 0.0, 600), (3, -1, 0.0, -1, -1, 0.3, 150),
               (4, 2, 0.25, 7, 8, 0.0, 250), (5, -1, 0.0, -1, -1, 0.2, 350), (6, 1, 0.7, 9, 10, 0.0, 250), (7, -1, 0.0, -1, -1, 0.45, 100),
               (8, -1, 0.0, -1, -1, 0.8, 150), (9, -1, 0.0, -1, -1, 0.6, 120), (10, -1, 0.0, -1, -1, 0.1, 130)]


def stated_tree():
    import pandas as pd
    from churnlens.operators.trees import TreeModel, tree_from_nodes
    nodes = pd.DataFrame(STATED_TREE, columns=["id", "feature", "threshold", "left", "right", "value", "cover"])
    return TreeModel(tuple(TREE_FEATURES), (tree_from_nodes(nodes),))


# every coalition s of the three features (bits) is worth the tree's mean when only its features are known
EXPLAIN_TREE_SQL = """
nd(id, f, cut, l, r, val, cover) AS (VALUES """ + ", ".join(str(n) for n in STATED_TREE) + """),
tx AS (SELECT customer_id, [""" + ", ".join(f"{c}::DOUBLE" for c in TREE_FEATURES) + """] AS x FROM ft),
go AS (SELECT customer_id, x, s, 0 AS id, 1.0::DOUBLE AS w FROM tx, range(8) k(s)
  UNION ALL
  SELECT customer_id, x, s, ch.id, w * CASE WHEN (s >> nd.f) & 1 = 1 THEN 1.0 ELSE ch.cover / nd.cover END
  FROM go JOIN nd ON nd.id = go.id AND nd.f >= 0 JOIN nd ch ON ch.id IN (nd.l, nd.r)
  WHERE (s >> nd.f) & 1 = 0 OR ch.id = CASE WHEN x[nd.f + 1] <= nd.cut THEN nd.l ELSE nd.r END),
vs AS (SELECT customer_id, s, sum(w * val) AS v FROM go JOIN nd ON nd.id = go.id AND nd.f < 0 GROUP BY 1, 2),
ph AS (SELECT a.customer_id, i, sum((b.v - a.v) * CASE bit_count(a.s::INT) WHEN 1 THEN 1 / 6e0 ELSE 1 / 3e0 END) AS phi
       FROM vs a, range(3) k(i), vs b WHERE (a.s >> i) & 1 = 0 AND b.customer_id = a.customer_id AND b.s = a.s + (1 << i) GROUP BY 1, 2)"""


@register("explain_tree", scored_views(extra="").replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + "," + EXPLAIN_TREE_SQL + """
SELECT customer_id, [""" + ", ".join(f"'{c}'" for c in TREE_FEATURES) + """][i + 1] AS feature, round(phi, 6) AS phi,
       round((SELECT v FROM vs WHERE vs.customer_id = ph.customer_id AND s = 0), 6) AS base FROM ph""")
def q_explain_tree(spark, sf):
    """Exact attributions of a stated tree for every subscriber."""
    from churnlens.operators.trees import explain_trees
    feats, _ = _served(spark, sf)
    return explain_trees(feats, stated_tree(), "customer_id").select("customer_id", "feature", r6("phi").alias("phi"), r6("base").alias("base"))


@register("predict_explain_log", scored_views(extra="").replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + "," + EXPLAIN_TREE_SQL + """
SELECT customer_id, CASE WHEN any_value(v) >= 0.5 THEN 'Yes' ELSE 'No' END AS "Churn", round(any_value(v), 6) AS probability, """ + ", ".join(
    f"round(max(phi) FILTER (WHERE i = {i}), 6) AS phi_{c}" for i, c in enumerate(TREE_FEATURES)) + """,
       'Production' AS model_stage, 'v1' AS model_version FROM ph JOIN vs USING (customer_id) WHERE s = 7 GROUP BY customer_id""")
def q_predict_explain_log(spark, sf):
    """Raw rows to label, probability, attributions and log columns in one projection, with a tree model."""
    from churnlens.operators.ml import predict_log
    _, params = _served(spark, sf)
    out = predict_log(raw_subscribers(spark, sf), stated_tree(), params, ["customer_id"], None, "Production", "v1")
    return out.select("customer_id", "Churn", r6("probability").alias("probability"),
                      *[F.round(F.col("attributions")[c], DIGITS).alias(f"phi_{c}") for c in TREE_FEATURES], "model_stage", "model_version")


@register("explain_forest")
def q_explain_forest(spark, sf):
    """Exact attributions of the default forest (200 trees) for every subscriber."""
    from churnlens.operators.ml import train_forest
    from churnlens.operators.trees import explain_trees, forest_model
    train, test, _ = _train_test(spark, sf)
    model = forest_model(train_forest(train, ML_FEATURES, "churn"), ML_FEATURES)
    phi = explain_trees(train.unionByName(test), model, "customer_id")
    return phi.select("customer_id", "feature", r6("phi").alias("phi"), r6("base").alias("base"))


@register("explain_summary", scored_views(extra=f"ph AS ({LINEAR_PHI_SQL})") + """
SELECT feature, round(avg(abs(phi)), 6) AS mean_abs_phi, round(max(abs(phi)), 6) AS max_abs_phi FROM ph GROUP BY 1""")
def q_explain_summary(spark, sf):
    from churnlens.operators.explain import explain_summary
    out = explain_summary(_linear_phi(spark, sf))
    return out.select("feature", r6("mean_abs_phi").alias("mean_abs_phi"), r6("max_abs_phi").alias("max_abs_phi"))


@register("stratified_folds", subs_clean_views() + """
SELECT churn, CAST(floor(r * 3 / n) AS INT) AS fold, count(*) AS n FROM
  (SELECT churn, n, unnest(range(n)) AS r FROM (SELECT CASE churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS churn, count(*) AS n
                                                FROM subs_clean GROUP BY 1)) GROUP BY 1, 2""")
def q_stratified_folds(spark, sf):
    from churnlens.operators.fitted import prepare_training
    from churnlens.operators.ml import stratified_folds
    feats, _ = prepare_training(raw_subscribers(spark, sf), ML_SPEC)
    return stratified_folds(feats, "churn", 3, key="customer_id").groupBy("churn", "fold").agg(F.count(F.lit(1)).alias("n"))


def _train_validate(spark, sf):
    """(balanced training rows, validation rows, test rows): the validation part is a fifth of the training part."""
    from churnlens.operators.ml import oversample_minority, stratified_split
    from churnlens.session import materialize
    train, test, _ = _train_test(spark, sf)
    parts = materialize(stratified_split(train.drop("split"), "churn", 0.2, seed=3, key="customer_id"), "ml_validation")
    fit = parts.where(F.col("split") == "train")
    return materialize(oversample_minority(fit, "churn", ML_FEATURES, key="customer_id"), "ml_balanced"), parts.where(F.col("split") == "test"), test


@register("network_search")
def q_network_search(spark, sf):
    """All 27 points of the configured grid, 20 epochs each, by F1 on the validation part."""
    from churnlens.operators.network import network_search
    fit, held_out, _ = _train_validate(spark, sf)
    out, _ = network_search(fit, held_out, ML_FEATURES, "churn")
    return out.select("setting", "hidden", "lr", "batch", *[r6(c).alias(c) for c in ("accuracy", "precision", "recall", "f1", "roc_auc")], "rank")


@register("network_scores")
def q_network_scores(spark, sf):
    """The configured default network."""
    from churnlens.operators.network import train_network
    train, test, _ = _train_test(spark, sf)
    return _scores(train_network(train, ML_FEATURES, "churn"), test)


# rounds of the registered second-order model; the configured 200 take four times as long (README)
NEWTON_ROUNDS = 50


@register("newton_scores")
def q_newton_scores(spark, sf):
    """Second-order boosting with columns and rows sampled per tree."""
    from churnlens.operators.boosting import train_newton
    train, test, _ = _train_test(spark, sf)
    return _scores(train_newton(train, ML_FEATURES, "churn", {"trees": NEWTON_ROUNDS, "subsample": 0.8, "colsample": 0.8}), test)


@register("train_and_rank")
def q_train_and_rank(spark, sf):
    """Split, balance the training part, train every kind of model, rank by F1 on the test part."""
    from churnlens.operators.ml import (oversample_minority, train_and_rank, train_boosted, train_forest,
                                        train_logistic, train_mlp)
    from churnlens.session import materialize
    train, test, _ = _train_test(spark, sf)
    balanced = materialize(oversample_minority(train, "churn", ML_FEATURES, key="customer_id"), "ml_balanced")
    out = train_and_rank(balanced, test, ML_FEATURES, "churn", {
        "forest": train_forest, "boosted": train_boosted, "network": train_mlp, "logistic": train_logistic})
    return out.select("model", *[r6(c).alias(c) for c in ("accuracy", "precision", "recall", "f1", "roc_auc")],
                      "rank", "stage")


# ---------------------------------------------------------------------------
# J: metric aggregates, batch forms (oracle) and streaming runs
# ---------------------------------------------------------------------------

INTERNAL_SQL = "(" + ", ".join(f"'{e}'" for e in INTERNAL_ENDPOINTS) + ")"


@register("request_counts", with_views("prediction_log") + f"""
SELECT time_bucket(INTERVAL '10 seconds', event_time) AS window_start, endpoint, count(*) AS n
FROM prediction_log WHERE endpoint NOT IN {INTERNAL_SQL} GROUP BY 1, 2""")
def q_request_counts(spark, sf):
    from churnlens.streaming.streams import request_counts
    return request_counts(FX.prediction_log(spark, sf), "event_time", "endpoint")


@register("latency_histogram", with_views("prediction_log") + """
SELECT model_stage, model_version, le, count(*) FILTER (WHERE latency <= le) AS n FROM prediction_log,
  (SELECT unnest([""" + ", ".join(map(str, DEFAULT_LATENCY_EDGES)) + """, 'inf'::DOUBLE]) AS le) e
WHERE latency IS NOT NULL GROUP BY 1, 2, 3""")
def q_latency_histogram(spark, sf):
    from churnlens.streaming.streams import latency_histogram
    return latency_histogram(FX.prediction_log(spark, sf), STAGE_BY, "latency")


@register("latency_summary", with_views("prediction_log") + """
SELECT model_stage, model_version, round(sum(latency), 6) AS sum, count(latency) AS count
FROM prediction_log GROUP BY 1, 2""")
def q_latency_summary(spark, sf):
    from churnlens.streaming.streams import latency_summary
    out = latency_summary(FX.prediction_log(spark, sf), STAGE_BY, "latency")
    return out.select(*STAGE_BY, r6("sum").alias("sum"), "count")


@register("error_counts", with_views("prediction_log") + """
SELECT model_stage, model_version, count(*) FILTER (WHERE endpoint = 'error') AS n_errors, count(*) AS n
FROM prediction_log GROUP BY 1, 2""")
def q_error_counts(spark, sf):
    from churnlens.streaming.streams import error_counts
    return error_counts(FX.prediction_log(spark, sf), STAGE_BY, F.col("endpoint") == "error")


@register("prediction_counts", with_views("prediction_log") + """
SELECT model_stage, model_version, count(DISTINCT request_id) AS n_requests, count(*) AS n_rows
FROM prediction_log GROUP BY 1, 2""")
def q_prediction_counts(spark, sf):
    from churnlens.streaming.streams import prediction_counts
    return prediction_counts(FX.prediction_log(spark, sf), STAGE_BY, "request_id")


@register("stream_prediction_counts", ORACLE["prediction_counts"])
def q_stream_prediction_counts(spark, sf):
    from churnlens.streaming.streams import stream_prediction_counts
    return stream_prediction_counts(_log_stream(spark, sf), STAGE_BY, "request_id", ["request_id", "customer_id"], "event_time", "1 day")


@register("latest_gauges", with_views("prediction_log") + """
SELECT model_stage, model_version, latency AS value FROM (SELECT *, row_number() OVER (PARTITION BY model_stage,
  model_version ORDER BY event_time DESC, request_id DESC) AS rn FROM prediction_log) WHERE rn = 1""")
def q_latest_gauges(spark, sf):
    from churnlens.streaming.streams import latest_gauges
    return latest_gauges(FX.prediction_log(spark, sf), STAGE_BY, "latency", ["event_time", "request_id"])


WINDOW_DRIFT = "30 days"


def _window_drift_sql() -> str:
    cur = " UNION ALL ".join(
        f"SELECT time_bucket(INTERVAL '30 days', o_orderdate, TIMESTAMP '1970-01-01') AS window_start, "
        f"'{c}' AS col, {c} AS value, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' "
        f"GROUP BY 1, 2, 3" for c in DRIFT_CAT)
    ref = " UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS value, count(*) AS a FROM drift_ref GROUP BY 1, 2"
                             for c in DRIFT_CAT)
    return with_views("drift", extra=f"""
cur AS ({cur}),
rc AS ({ref}),
rs AS (SELECT col, value, a / sum(a) OVER (PARTITION BY col) AS p FROM rc),
cs AS (SELECT window_start, col, value, n / sum(n) OVER (PARTITION BY window_start, col) AS q FROM cur),
wins AS (SELECT DISTINCT window_start, col FROM cur),
grid AS (SELECT w.window_start, w.col, rs.value, rs.p FROM wins w JOIN rs ON rs.col = w.col),
fu AS (SELECT coalesce(g.window_start, cs.window_start) AS window_start, coalesce(g.col, cs.col) AS col,
              coalesce(g.p, 0.0) AS p, coalesce(cs.q, 0.0) AS q
       FROM grid g FULL OUTER JOIN cs ON g.window_start = cs.window_start AND g.col = cs.col
                                      AND g.value = cs.value)""") + """
SELECT window_start, col AS "column", round(sqrt(greatest(sum(
   CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END +
   CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2, 0.0)), 6) AS js
FROM fu GROUP BY 1, 2"""


def _after_split(orders, cols=None):
    """The orders of the drift binding's current side, from a table or a stream."""
    return orders.where(F.col("o_orderdate") >= F.lit(FX.DRIFT_SPLIT_DATE).cast("timestamp_ntz")) \
                 .select("o_orderdate", *(cols or DRIFT_CAT))


@register("windowed_drift", _window_drift_sql())
def q_windowed_drift(spark, sf):
    from churnlens.streaming.streams import window_category_counts, windowed_js
    ref, _ = FX.drift_sides(spark, sf)
    counts = window_category_counts(_after_split(FX.table(spark, sf, "orders")), "o_orderdate", DRIFT_CAT, WINDOW_DRIFT)
    return windowed_js(counts, ref, DRIFT_CAT).select("window_start", "column", r6("js").alias("js"))


# streaming runs: the same operators on file streams over the tables as they lie

def _table_stream(spark, sf, name):
    from churnlens.streaming.streams import file_stream
    # a table may be one file or a folder of files: as a pattern the stream source takes both
    return file_stream(spark, f"{sf}/{name}.parque[t]", FX.table(spark, sf, name).schema)


def _log_stream(spark, sf):
    return FX.log_of_events(_table_stream(spark, sf, "events"))


@register("stream_request_counts", ORACLE["request_counts"])
def q_stream_request_counts(spark, sf):
    from churnlens.streaming.streams import request_counts, run_update_stream
    agg = request_counts(_log_stream(spark, sf), "event_time", "endpoint", watermark="10 minutes")
    return run_update_stream(agg, ["window_start", "endpoint"], "request_counts")


@register("stream_windowed_drift", ORACLE["windowed_drift"])
def q_stream_windowed_drift(spark, sf):
    from churnlens.streaming.streams import run_update_stream, window_category_counts, windowed_js
    ref, _ = FX.drift_sides(spark, sf)
    current = _after_split(_table_stream(spark, sf, "orders"))
    counts = window_category_counts(current, "o_orderdate", DRIFT_CAT, WINDOW_DRIFT, watermark="1 day")
    final = run_update_stream(counts, ["window_start", "column", "value"], "windowed_drift")
    return windowed_js(final, ref, DRIFT_CAT).select("window_start", "column", r6("js").alias("js"))


DRIFT_BINS = 64


def _window_wasserstein_sql() -> str:
    return with_views("drift", extra=f"""
sp AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, stddev_pop(o_totalprice) AS sd FROM drift_ref),
bn AS (SELECT NULL::TIMESTAMP AS w, o_totalprice AS v FROM drift_ref
       UNION ALL SELECT time_bucket(INTERVAL '30 days', o_orderdate, TIMESTAMP '1970-01-01'), o_totalprice FROM orders
       WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
cells AS (SELECT w, CASE WHEN v < lo THEN 0 WHEN v >= hi THEN {DRIFT_BINS} + 1 ELSE floor((v - lo) * {DRIFT_BINS} / (hi - lo)) + 1 END AS bin,
                 count(*) AS n, sum(v) AS s FROM bn, sp WHERE v IS NOT NULL GROUP BY 1, 2),
ref AS (SELECT s / n AS v, n / sum(n) OVER () AS p FROM cells WHERE w IS NULL),
pts AS (SELECT w, s / n AS v, 0.0 AS p, n / sum(n) OVER (PARTITION BY w) AS q, n FROM cells WHERE w IS NOT NULL
        UNION ALL SELECT w, v, p, 0.0, 0 FROM (SELECT DISTINCT w FROM cells WHERE w IS NOT NULL), ref),
ar AS (SELECT w, n, abs(sum(p - q) OVER (PARTITION BY w ORDER BY v ROWS UNBOUNDED PRECEDING)) * (lead(v) OVER (PARTITION BY w ORDER BY v) - v) AS a FROM pts)""") + """
SELECT w AS window_start, 'o_totalprice' AS "column", CAST(sum(n) AS BIGINT) AS n,
       round(sum(a) / (SELECT sd FROM sp), 6) AS wasserstein FROM ar GROUP BY 1"""


def _window_distance(spark, sf, current, run):
    from churnlens.streaming.streams import fit_sketch, window_bin_sums, windowed_wasserstein
    ref, _ = FX.drift_sides(spark, sf)
    sketch = fit_sketch(ref, ["o_totalprice"], DRIFT_BINS)
    sums = run(window_bin_sums(current, "o_orderdate", sketch, WINDOW_DRIFT, watermark="1 day"))
    return windowed_wasserstein(sums, sketch).select("window_start", "column", "n", r6("wasserstein").alias("wasserstein"))


@register("windowed_numeric_drift", _window_wasserstein_sql())
def q_windowed_numeric_drift(spark, sf):
    """J8 of a numeric column: distance of every window's prices to the reference."""
    return _window_distance(spark, sf, _after_split(FX.table(spark, sf, "orders"), ["o_totalprice"]), lambda sums: sums)


@register("stream_windowed_numeric_drift", ORACLE["windowed_numeric_drift"])
def q_stream_windowed_numeric_drift(spark, sf):
    from churnlens.streaming.streams import run_update_stream
    current = _after_split(_table_stream(spark, sf, "orders"), ["o_totalprice"])
    return _window_distance(spark, sf, current,
                            lambda sums: run_update_stream(sums, ["window_start", "column", "bin"], "windowed_numeric_drift"))


@register("stream_upsert", ORACLE["upsert_log"])
def q_stream_upsert(spark, sf):
    from churnlens.operators.merge import upsert_log
    from churnlens.streaming.streams import merged, scratch_path, stream_upsert
    base = FX.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice",
                                                "o_orderdate", "o_orderpriority")
    # the log table as of before the feedback (one row per customer, G2 with no feedback)
    base = upsert_log(base, base.limit(0), "o_custkey", ["o_orderkey"]).select(*base.columns)
    s = feedback_of(_table_stream(spark, sf, "orders"), ["o_orderdate"])
    # every order once: what arrives again within the delay is not written again
    feedback = stream_upsert(s, scratch_path(spark, "tables", "feedback"), "o_custkey", ["o_orderkey"], "o_orderdate", "1 day")
    return merged(spark, base, feedback, "o_custkey", ["o_orderkey"])


@register("stream_score", scored_views(extra=f"pl AS ({SQL_VIEWS_PL})") + """
SELECT request_id, customer_id, round(p, 6) AS probability, CASE WHEN p >= 0.5 THEN 1 WHEN p < 0.5 THEN 0 END AS predicted
FROM pl LEFT JOIN sc USING (customer_id)""")
def q_stream_score(spark, sf):
    """Requests carry their raw columns as JSON; nothing is looked up when they are scored."""
    from churnlens.streaming.streams import file_stream, scratch_path, stream_score
    _, params = _served(spark, sf)
    raw = raw_subscribers(spark, sf).drop("churn")
    requests = FX.prediction_log(spark, sf).select("request_id", F.col("customer_id").alias("asked"), "event_time")
    records = requests.join(raw.select(F.col("customer_id").alias("asked"), F.to_json(F.struct("*")).alias("record")), "asked", "left")
    landing = scratch_path(spark, "landing", "requests")  # the requests as they would arrive
    records.write.parquet(landing)
    sink = stream_score(file_stream(spark, landing, records.schema), "record", raw.schema, params, _fixed_model(), "Production", "v1",
                        ["request_id", "asked"], "event_time", "10 minutes", scratch_path(spark, "sinks", "scored"))
    return spark.read.parquet(sink).select(
        "request_id", F.col("asked").alias("customer_id"), r6("probability").alias("probability"),
        F.when(F.col("Churn") == "Yes", 1).when(F.col("Churn") == "No", 0).alias("predicted"))


@register("stream_latency_histogram", ORACLE["latency_histogram"])
def q_stream_latency_histogram(spark, sf):
    from churnlens.streaming.streams import latency_histogram, run_update_stream
    agg = latency_histogram(_log_stream(spark, sf), STAGE_BY, "latency")
    return run_update_stream(agg, [*STAGE_BY, "le"], "latency_histogram")


@register("stream_error_counts", ORACLE["error_counts"])
def q_stream_error_counts(spark, sf):
    from churnlens.streaming.streams import error_counts, run_update_stream
    agg = error_counts(_log_stream(spark, sf), STAGE_BY, F.col("endpoint") == "error")
    return run_update_stream(agg, STAGE_BY, "error_counts")


@register("stream_latest_gauges", ORACLE["latest_gauges"])
def q_stream_latest_gauges(spark, sf):
    from churnlens.streaming.streams import latest_gauges, run_update_stream
    agg = latest_gauges(_log_stream(spark, sf), STAGE_BY, "latency", ["event_time", "request_id"])
    return run_update_stream(agg, STAGE_BY, "latest_gauges")
