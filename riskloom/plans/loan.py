"""The loan table: which columns play which part, and how raw text becomes features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.clean import (
    log1p_floor0, ordinal_text, sentinel_to_null, target_flag, to_number,
)
from riskloom.roles import Roles

# Column names, statuses and sentinels of the loan table.
NUMBERS = ("loan_amnt", "int_rate", "dti", "fico_range_high", "open_acc", "revol_util",
           "total_acc", "pub_rec", "delinq_2yrs", "mort_acc", "inq_last_6mths")
LOGGED = ("annual_inc", "revol_bal")
TEXT = ("term", "sub_grade", "home_ownership", "verification_status", "purpose", "addr_state",
        "initial_list_status", "application_type")
RARE_COLUMNS = ("addr_state",)
RARE_THRESHOLD = 0.01
POSITIVE = ("Charged Off",)
RAW_COLUMNS = ("id", "loan_status", *NUMBERS, *LOGGED, "emp_length", *TEXT)
ROLES = Roles(
    id="id",
    target="default",
    numeric=(*NUMBERS, "emp_length_num", "annual_inc_log", "revol_bal_log"),
    categorical=tuple(c if c not in RARE_COLUMNS else f"{c}_grouped" for c in TEXT),
)


def clean(raw: DataFrame, excluded: tuple[str, ...] = ()) -> DataFrame:
    """Raw text columns to the target, the numbers and the categories, in one projection."""
    numbers = {c: to_number(c) for c in NUMBERS}
    numbers["dti"] = sentinel_to_null(to_number("dti"), equals=[-1.0], at_least=999.0)
    df = raw.select(
        "id",
        target_flag("loan_status", list(POSITIVE), list(excluded)).alias("default"),
        *[column.alias(name) for name, column in numbers.items()],
        ordinal_text("emp_length").alias("emp_length_num"),
        *[log1p_floor0(to_number(c)).alias(f"{c}_log") for c in LOGGED],
        *TEXT,
    )
    return df.where(F.col("default").isNotNull())
