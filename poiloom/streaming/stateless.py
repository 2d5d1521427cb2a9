"""The steps that look at one row only, for unbounded inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiloom.functions import text as T
from poiloom.operators import steps as S


def clean_rows(df: DataFrame, chains: Sequence[str], keywords: Sequence[str], min_hours: float = 20, night_start: float = 19) -> DataFrame:
    """df, batch or streaming, with name_normalized and drop_reason of its chain, keyword, hours and blacklist filters."""
    named = S.normalize_names(df)
    chain = T.matches(T.filter_key(F.col("name_normalized")), T.any_pattern(chains))
    early = S.reasons((chain, "1_Regex_Chain"), (S.source_flag(named), "3_Flagged_As_Chain_In_Source"), (S.global_keyword(), "1_Global_Keywords"), (S.hours_failed(min_hours, night_start), "2_Hours_Filter"))
    last = S.final_keywords(named, keywords).rows.withColumnRenamed("drop_reason", "_last")
    return last.withColumn("drop_reason", F.coalesce(early, F.col("_last"))).drop("_last")
