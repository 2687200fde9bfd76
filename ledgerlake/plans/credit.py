"""Credit scoring case: star join, derived features, risk label, grades
(S4, J1, J2, M13, F11, F13, F15, F18, A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import bins_right_closed, bins_right_closed_sql, clip
from ..functions.ordered import materialize, quantile_params
from ..operators.relational import share_table
from .registry import register
from .views import (V_CREDIT_LOAN_SQL, V_CREDIT_SQL, V_CUSTOMER_SQL, v_credit, v_credit_loan,
                    v_customer, with_ctes)

# Fixed values of the credit case: ordinal education codes, the weights of
# the linear risk score, the label quantile and the grade bins.
EDUCATION_CODE = {"high_school": 1, "bachelor": 2, "master": 3, "doctor": 4}
RISK_WEIGHTS = {"debt_income_ratio": 0.3, "total_overdue": 0.25, "credit_card_utilization": 0.2,
                "payment_income_ratio": 0.15, "credit_history_length": -0.05, "education_code": -0.03}
LABEL_QUANTILE = 0.3
GRADE_EDGES = [0, 0.15, 0.30, 0.50, 0.70, 1.0]
GRADE_LABELS = ["A", "B", "C", "D", "E"]

CTES = dict(v_customer=V_CUSTOMER_SQL, v_credit=V_CREDIT_SQL, v_credit_loan=V_CREDIT_LOAN_SQL)


def ordinal_map(c, mapping: dict) -> F.Column:
    """fixed dictionary lookup; unknown values become null."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return m[F.col(c) if isinstance(c, str) else c]


def star_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + M13: customer LEFT credit LEFT loan, numeric gaps filled with 0.

    Both fact sides are aggregated by customer, so they arrive hash
    partitioned on the join key; only the customer side is shuffled."""
    c, cr, ln = v_customer(spark, sf_dir), v_credit(spark, sf_dir), v_credit_loan(spark, sf_dir)
    j = c.join(cr, "customer_id", "left").join(ln, "customer_id", "left")
    num = [f.name for f in j.schema.fields if f.name not in c.columns]
    return j.na.fill(0, subset=num)


def _features(df: DataFrame) -> DataFrame:
    total_overdue = F.col("num_overdue_30d") + F.col("num_overdue_60d") + F.col("num_overdue_90d")
    return df.select(
        "customer_id", "age", "annual_income", "num_overdue_90d", "credit_card_utilization",
        "has_mortgage", "num_credit_cards", "num_dependents", "num_loans", "credit_history_months",
        F.when(F.col("gender") == "M", 1).otherwise(0).alias("gender_code"),
        ordinal_map("education", EDUCATION_CODE).alias("education_code"),
        (F.col("credit_history_months") / 12).alias("credit_history_length"),
        total_overdue.alias("total_overdue"),
        clip(F.col("total_loan_amount") / F.col("annual_income"), 0, 10).alias("debt_income_ratio"),
        clip(F.col("monthly_payment") / (F.col("annual_income") / 12), 0, 1).alias("payment_income_ratio"),
        F.when(total_overdue > 0, 1).otherwise(0).alias("has_overdue"),
        F.when(F.col("num_overdue_90d") > 0, 1).otherwise(0).alias("severe_overdue"),
    )


def _risk(df: DataFrame) -> DataFrame:
    score = None
    for c, w in RISK_WEIGHTS.items():
        term = F.col(c) * abs(w)
        score = term if score is None else (score + term if w > 0 else score - term)
    return df.withColumn("risk_score", score)


def credit_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features plus the unrounded risk score (no label yet)."""
    return _risk(_features(star_left_join(spark, sf_dir)))


def with_risk_label(df: DataFrame, q: float | None = None) -> tuple[DataFrame, float]:
    """label = score above its 30% quantile (exact, distributed).  The
    joined frame (a row per customer) is stored before: the quantile's passes
    and the result would each join it anew."""
    if q is None:
        df = materialize(df)
        q = quantile_params(df, ["risk_score"], [LABEL_QUANTILE])["risk_score"][LABEL_QUANTILE]
    lab = F.when(F.col("risk_score") > F.lit(q), 1).otherwise(0)
    return df.withColumn("default_label", lab), q


def default_prob(q30) -> F.Column:
    """Scorecard probability: logistic of the score centred on the label cut."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * (F.col("risk_score") - q30)))


FEATURE_SQL = """
f AS (
  SELECT *, debt_income_ratio*0.3 + total_overdue*0.25 + credit_card_utilization*0.2
            + payment_income_ratio*0.15 - credit_history_length*0.05 - education_code*0.03 AS risk_score
  FROM (
    SELECT customer_id, age, annual_income, num_overdue_90d, credit_card_utilization, has_mortgage,
      num_credit_cards, num_dependents, num_loans, credit_history_months,
      CASE WHEN gender = 'M' THEN 1 ELSE 0 END AS gender_code,
      CASE education WHEN 'high_school' THEN 1 WHEN 'bachelor' THEN 2 WHEN 'master' THEN 3
                     WHEN 'doctor' THEN 4 END AS education_code,
      credit_history_months / 12 AS credit_history_length,
      num_overdue_30d + num_overdue_60d + num_overdue_90d AS total_overdue,
      least(greatest(total_loan_amount / annual_income, 0), 10) AS debt_income_ratio,
      least(greatest(monthly_payment / (annual_income / 12), 0), 1) AS payment_income_ratio,
      CASE WHEN num_overdue_30d + num_overdue_60d + num_overdue_90d > 0 THEN 1 ELSE 0 END AS has_overdue,
      CASE WHEN num_overdue_90d > 0 THEN 1 ELSE 0 END AS severe_overdue
    FROM (
      SELECT c.*,
        coalesce(cr.credit_history_months, 0) AS credit_history_months,
        coalesce(cr.num_overdue_30d, 0) AS num_overdue_30d, coalesce(cr.num_overdue_60d, 0) AS num_overdue_60d,
        coalesce(cr.num_overdue_90d, 0) AS num_overdue_90d, coalesce(cr.max_overdue_days, 0) AS max_overdue_days,
        coalesce(cr.num_credit_cards, 0) AS num_credit_cards,
        coalesce(cr.credit_card_utilization, 0) AS credit_card_utilization,
        coalesce(l.num_loans, 0) AS num_loans, coalesce(l.total_loan_amount, 0) AS total_loan_amount,
        coalesce(l.monthly_payment, 0) AS monthly_payment, coalesce(l.has_mortgage, 0) AS has_mortgage
      FROM v_customer c LEFT JOIN v_credit cr USING (customer_id) LEFT JOIN v_credit_loan l USING (customer_id)
    ) j
  ) x
),
q AS (SELECT quantile_cont(risk_score, 0.3) AS q30 FROM f)"""


def _sql(body: str) -> str:
    return with_ctes("", **CTES).rstrip() + ",\n" + FEATURE_SQL + "\n" + body


CREDIT_FEATURES_SQL = _sql("""
SELECT customer_id, age, annual_income, gender_code, education_code,
  round(credit_history_length, 6) AS credit_history_length, total_overdue, num_overdue_90d,
  round(debt_income_ratio, 6) AS debt_income_ratio, round(payment_income_ratio, 6) AS payment_income_ratio,
  credit_card_utilization, has_mortgage, num_credit_cards, num_dependents, num_loans,
  has_overdue, severe_overdue, round(risk_score, 6) AS risk_score,
  CASE WHEN risk_score > q30 THEN 1 ELSE 0 END AS default_label
FROM f, q""")


@register("credit_features", CREDIT_FEATURES_SQL)
def credit_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, _ = with_risk_label(credit_frame(spark, sf_dir))
    r = lambda c: F.round(c, 6).alias(c)
    return df.select("customer_id", "age", "annual_income", "gender_code", "education_code",
                     r("credit_history_length"), "total_overdue", "num_overdue_90d", r("debt_income_ratio"),
                     r("payment_income_ratio"), "credit_card_utilization", "has_mortgage", "num_credit_cards",
                     "num_dependents", "num_loans", "has_overdue", "severe_overdue", r("risk_score"),
                     "default_label")


GRADE_SQL = bins_right_closed_sql("(1.0 / (1.0 + exp(-2.0 * (risk_score - q30))))", GRADE_EDGES, GRADE_LABELS)


@register("grade_distribution", _sql(f"""
SELECT credit_grade, customers, round(customers * 100.0 / total, 2) AS pct
FROM (SELECT {GRADE_SQL} AS credit_grade, count(*) AS customers, max(total) AS total
      FROM f, q, (SELECT count(*) AS total FROM f) t GROUP BY 1) g
WHERE credit_grade IS NOT NULL"""))
def grade_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: count and percent per credit grade (F11 right-closed bins on the
    scorecard probability).  Percent is of all customers."""
    df, q = with_risk_label(credit_frame(spark, sf_dir))
    graded = df.select(bins_right_closed(default_prob(F.lit(q)), GRADE_EDGES, GRADE_LABELS).alias("credit_grade"))
    return share_table(graded, "credit_grade", count_col="customers", pct_col="pct", drop_null=True)


@register("star_inner_join", with_ctes("""
SELECT c.customer_id, c.age, c.annual_income, cr.credit_history_months,
  cr.num_overdue_30d + cr.num_overdue_60d + cr.num_overdue_90d AS total_overdue,
  round(l.total_loan_amount / c.annual_income, 6) AS debt_income_ratio,
  round(l.monthly_payment / (c.annual_income / 12), 6) AS payment_income_ratio,
  cr.credit_card_utilization
FROM v_customer c JOIN v_credit cr USING (customer_id) JOIN v_credit_loan l USING (customer_id)""", **CTES))
def star_inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inner star join as the case's SQL text documents it."""
    c, cr, ln = v_customer(spark, sf_dir), v_credit(spark, sf_dir), v_credit_loan(spark, sf_dir)
    j = c.join(cr, "customer_id").join(ln, "customer_id")
    return j.select("customer_id", "age", "annual_income", "credit_history_months",
                    (F.col("num_overdue_30d") + F.col("num_overdue_60d") + F.col("num_overdue_90d"))
                    .alias("total_overdue"),
                    F.round(F.col("total_loan_amount") / F.col("annual_income"), 6).alias("debt_income_ratio"),
                    F.round(F.col("monthly_payment") / (F.col("annual_income") / 12), 6)
                    .alias("payment_income_ratio"),
                    "credit_card_utilization")


@register("star_left_join", with_ctes("""
SELECT c.*, coalesce(cr.credit_history_months, 0) AS credit_history_months,
  coalesce(cr.num_overdue_30d, 0) AS num_overdue_30d, coalesce(cr.num_overdue_60d, 0) AS num_overdue_60d,
  coalesce(cr.num_overdue_90d, 0) AS num_overdue_90d, coalesce(cr.max_overdue_days, 0) AS max_overdue_days,
  coalesce(cr.num_credit_cards, 0) AS num_credit_cards,
  coalesce(cr.credit_card_utilization, 0) AS credit_card_utilization,
  coalesce(l.num_loans, 0) AS num_loans, coalesce(l.total_loan_amount, 0) AS total_loan_amount,
  coalesce(l.monthly_payment, 0) AS monthly_payment, coalesce(l.has_mortgage, 0) AS has_mortgage
FROM v_customer c LEFT JOIN v_credit cr USING (customer_id) LEFT JOIN v_credit_loan l USING (customer_id)""",
                                 **CTES))
def star_left_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_left_join(spark, sf_dir)


@register("ordinal_map", with_ctes("""
SELECT customer_id, education,
  CASE education WHEN 'high_school' THEN 1 WHEN 'bachelor' THEN 2 WHEN 'master' THEN 3
                 WHEN 'doctor' THEN 4 END AS education_code
FROM v_customer""", v_customer=V_CUSTOMER_SQL))
def ordinal_map_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = v_customer(spark, sf_dir)
    return c.select("customer_id", "education", ordinal_map("education", EDUCATION_CODE).alias("education_code"))


@register("risk_label", _sql("""
SELECT customer_id, round(risk_score, 6) AS risk_score, round(q30, 6) AS risk_q30,
  CASE WHEN risk_score > q30 THEN 1 ELSE 0 END AS default_label
FROM f, q"""))
def risk_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, q = with_risk_label(credit_frame(spark, sf_dir))
    return df.select("customer_id", F.round("risk_score", 6).alias("risk_score"),
                     F.round(F.lit(q), 6).alias("risk_q30"), "default_label")


@register("bin_fixed", _sql(f"""
SELECT customer_id, {bins_right_closed_sql('debt_income_ratio', [0, 0.5, 1, 2, 5], ['low', 'mid', 'high', 'very_high'])} AS debt_band
FROM f"""))
def bin_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F11 on the debt-to-income ratio: right-closed bins, values above the
    last edge (up to the clip at 10) fall outside and are null."""
    df = credit_frame(spark, sf_dir)
    return df.select("customer_id", bins_right_closed("debt_income_ratio", [0, 0.5, 1, 2, 5],
                                                      ["low", "mid", "high", "very_high"]).alias("debt_band"))
