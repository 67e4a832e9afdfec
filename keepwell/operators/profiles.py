"""Member profiles as they were known at the cutoff."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.functions.columns import as_text_or, compact_date

PROFILE_COLUMNS = ["city", "age_clean", "age_unknown_flag", "gender_clean", "registered_via", "registration_date"]


def validated(members: DataFrame) -> DataFrame:
    """Age kept inside [10, 100]; the flag is null, like the age, when no age was given."""
    plausible = F.col("bd").between(10, 100)
    return members.withColumns(
        {
            "registration_date": compact_date("registration_init_time"),
            "age_clean": F.when(plausible, F.col("bd")),
            "age_unknown_flag": (~plausible).cast("tinyint"),
            "gender_clean": as_text_or("gender", "unknown"),
        }
    )


def profile_as_of(members: DataFrame, cutoff: dt.date) -> DataFrame:
    """A profile registered after the cutoff did not exist yet: the row stays, its fields go null."""
    known = F.col("registration_date") <= F.lit(cutoff)
    return validated(members).select("msno", *[F.when(known, F.col(name)).alias(name) for name in PROFILE_COLUMNS])
