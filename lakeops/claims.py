"""Car insurance claims: schema, cleaning, flags and summary, built from the general operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from lakeops.functions.flags import flag_in
from lakeops.functions.text import PREFIX, PREFIX_OR_LESS_THAN, clean_columns
from lakeops.operators.aggregates import summary_columns
from lakeops.sources.csv import build_schema, read_csv

# The columns of the claims file in their order, and those that are integers; all
# others are text.
COLUMNS = ["ID", "KIDSDRIV", "BIRTH", "AGE", "HOMEKIDS", "YOJ", "INCOME", "PARENT1", "HOME_VAL", "MSTATUS", "GENDER",
           "EDUCATION", "OCCUPATION", "TRAVTIME", "CAR_USE", "BLUEBOOK", "TIF", "CAR_TYPE", "RED_CAR", "OLDCLAIM",
           "CLM_FREQ", "REVOKED", "MVR_PTS", "CLM_AMT", "CAR_AGE", "CLAIM_FLAG", "URBANICITY"]
INTEGERS = ["ID", "KIDSDRIV", "AGE", "HOMEKIDS", "YOJ", "TRAVTIME", "TIF", "CLM_FREQ", "MVR_PTS", "CAR_AGE",
            "CLAIM_FLAG"]
# What is cleaned from which column.
STRIPPED = {"MSTATUS": PREFIX, "GENDER": PREFIX, "EDUCATION": PREFIX_OR_LESS_THAN, "OCCUPATION": PREFIX,
            "URBANICITY": PREFIX, "CAR_TYPE": PREFIX}
MONEY = ["HOME_VAL", "INCOME", "BLUEBOOK", "CLM_AMT", "OLDCLAIM"]
# The lists behind the two flags.
HIGHER_EDUCATION = ["PhD", "Master"]
PROFESSIONAL_OCCUPATIONS = ["Doctor", "Professional"]


def claims_schema() -> StructType:
    return build_schema(COLUMNS, {
        IntegerType(): INTEGERS, StringType(): [c for c in COLUMNS if c not in INTEGERS]})


def read_claims(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, claims_schema())


def clean_claims(claims: DataFrame) -> DataFrame:
    """All columns, the eleven cleaned ones last."""
    return clean_columns(claims, STRIPPED, MONEY)


def claim_flags() -> list[Column]:
    return [flag_in(F.col("EDUCATION"), HIGHER_EDUCATION).alias("high_ed"),
            flag_in(F.col("OCCUPATION"), PROFESSIONAL_OCCUPATIONS).alias("professional_occ")]


def claim_summary(cleaned: DataFrame, by: str, mean_age_above: float | None = None) -> DataFrame:
    """Total claims, mean age, largest claim frequency and members per group."""
    columns = summary_columns({"CLM_AMT": "TOTAL_CLM_AMT"}, {"AGE": "MEAN_AGE"}, {"CLM_FREQ": "MAX_CLM_FREQ"},
                              "MEMBERS")
    summary = cleaned.groupBy(by).agg(*columns)
    return summary if mean_age_above is None else summary.filter(F.col("MEAN_AGE") > mean_age_above)
