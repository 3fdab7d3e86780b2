"""Aggregate specs of the loan feature table (fixed values of the reference).

Column names, aggregate lists and table prefixes are part of the feature
contract, so they are stated here as data, in the reference's order.
"""

from __future__ import annotations

# bureau_balance -> SK_ID_BUREAU (plus one STATUS_{v} mean per status value)
BUREAU_BALANCE_SPEC = {
    "MONTHS_BALANCE": ["min", "max", "size"],
}

# bureau -> SK_ID_CURR rules: first match wins, else mean
BUREAU_RATIO_COLS = ("DEBT_CREDIT_RATIO", "CREDIT_OVERDUE_DEBT_RATIO")
BUREAU_AMOUNT_COLS = ("AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_MAX_OVERDUE")
BUREAU_RECENT_COLS = ("DAYS_CREDIT", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT")

# previous_application -> SK_ID_CURR: these get min, mean, max, sum; the rest mean
PREV_WIDE_COLS = ("CREDIT_TO_ANNUITY_RATIO", "CREDIT_TO_GOODS_RATIO", "AMT_CREDIT", "AMT_ANNUITY")

POS_SPEC = {
    "MONTHS_BALANCE": ["min", "max", "mean", "size"],
    "CNT_INSTALMENT": ["min", "max", "mean"],
    "CNT_INSTALMENT_FUTURE": ["min", "max", "mean"],
    "SK_DPD": ["max", "mean"],
    "SK_DPD_DEF": ["max", "mean"],
    "INSTALMENT_FUTURE_RATIO": ["mean"],
}

INS_SPEC = {
    "NUM_INSTALMENT_VERSION": ["nunique"],
    "NUM_INSTALMENT_NUMBER": ["max", "mean"],
    "DAYS_INSTALMENT": ["min", "max", "mean"],
    "DAYS_ENTRY_PAYMENT": ["min", "max", "mean"],
    "AMT_INSTALMENT": ["min", "max", "mean", "sum"],
    "AMT_PAYMENT": ["min", "max", "mean", "sum"],
    "PAYMENT_RATIO": ["min", "max", "mean"],
    "PAYMENT_DIFF": ["min", "max", "mean", "sum"],
    "DAYS_LATE": ["max", "mean", "sum"],
    "IS_LATE": ["mean"],
}

CC_SPEC = {
    "MONTHS_BALANCE": ["min", "max", "size"],
    "AMT_BALANCE": ["max", "mean", "sum"],
    "AMT_CREDIT_LIMIT_ACTUAL": ["max", "mean"],
    "AMT_DRAWINGS_CURRENT": ["max", "mean", "sum"],
    "AMT_PAYMENT_CURRENT": ["max", "mean", "sum"],
    "SK_DPD": ["max", "mean"],
    "SK_DPD_DEF": ["max", "mean"],
    "BALANCE_TO_LIMIT_RATIO": ["max", "mean"],
    "DRAWING_LIMIT_RATIO": ["max", "mean"],
}

# application table
APP_MISSING_DROP = 0.75
APP_ABS_DAYS = ("DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH")
APP_YEARS = {
    "AGE_YEARS": "DAYS_BIRTH",
    "EMPLOYMENT_YEARS": "DAYS_EMPLOYED",
    "REGISTRATION_YEARS": "DAYS_REGISTRATION",
    "ID_PUBLISH_YEARS": "DAYS_ID_PUBLISH",
}
APP_RATIOS = {
    "INCOME_CREDIT_RATIO": ("AMT_INCOME_TOTAL", "AMT_CREDIT"),
    "INCOME_PER_PERSON": ("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
    "ANNUITY_INCOME_RATIO": ("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    "CREDIT_GOODS_RATIO": ("AMT_CREDIT", "AMT_GOODS_PRICE"),
}
