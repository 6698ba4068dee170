"""Row-level security and masking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import mask_local_part

# Which countries a regional manager may see.
COUNTRY_GRANTS = (
    ("emea.manager@example.com", "GB"),
    ("emea.manager@example.com", "DE"),
    ("emea.manager@example.com", "FR"),
    ("americas.manager@example.com", "US"),
    ("americas.manager@example.com", "CA"),
    ("apac.manager@example.com", "IN"),
    ("apac.manager@example.com", "AU"),
)
UNMASKED_ROLE = "transformer"


def country_grants(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(COUNTRY_GRANTS), "user_email string, country string")


def visible_customers(customers: DataFrame, grants: DataFrame, user: str, restricted: bool = True) -> DataFrame:
    """Customers of the countries granted to the user, whose address is compared in any case. Restricted without a
    grant: none."""
    if not restricted:
        return customers
    mine = grants.filter(F.lower("user_email") == user.lower()).select("country").distinct()
    return customers.join(mine, "country", "left_semi").select(*customers.columns)


def visible_facts(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Rows of a customer-keyed table whose customer is visible."""
    return facts.join(customers.select("customer_id"), "customer_id", "left_semi").select(*facts.columns)


def masked(customers: DataFrame, role: str) -> DataFrame:
    if role == UNMASKED_ROLE:
        return customers
    return customers.withColumn("email", mask_local_part(F.col("email")))
