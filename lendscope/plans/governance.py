"""Role-scoped views: masked columns and filtered rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.functions.banding import REGIONS
from lendscope.functions.masking import MASKED_IP, MASKED_LOCAL_PART, mask
from lendscope.schemas import class_of

# Roles that see clear values and every row.
PRIVILEGED_ROLES = ("RISK_ANALYST", "ADMIN")

# Which masking method each policy attaches to which column.
BORROWER_POLICY = {"age": "null_int", "credit_limit": "null_int"}
PAYMENT_POLICY = {"borrower_email": "email", "borrower_ip": "ip"}

DEFAULT_REGION = "west"


def apply_masking_policy(df: DataFrame, role: str, policy: Mapping[str, str]) -> DataFrame:
    """Hide the policy's columns from any role that is not privileged.

    The role is known when the plan is built, so no row pays for the test.
    """
    if role in PRIVILEGED_ROLES:
        return df
    return df.withColumns({c: mask(F.col(c), method) for c, method in policy.items()})


def gov_borrower_analyst(dim: DataFrame) -> DataFrame:
    """Borrowers with exact age and limit hidden; bands and labels stay."""
    return apply_masking_policy(dim, "ANALYST", BORROWER_POLICY).select(
        "client_id",
        "credit_limit",
        "credit_limit_band",
        "sex_code",
        "sex",
        "education_code",
        "education_level",
        "marriage_code",
        "marital_status",
        "age",
        "age_band",
        "region",
    )


def gov_borrower_risk_analyst(dim: DataFrame) -> DataFrame:
    """Borrowers in clear for the role entitled to it."""
    return apply_masking_policy(dim, "RISK_ANALYST", BORROWER_POLICY)


def gov_payments_analyst(payments: DataFrame) -> DataFrame:
    """Payments with e-mail and address hidden, without load columns."""
    return apply_masking_policy(payments, "ANALYST", PAYMENT_POLICY).drop("load_date", "loaded_at")


def gov_borrower_regional(analyst_view: DataFrame, access_region: str = DEFAULT_REGION) -> DataFrame:
    """The analyst view cut to one region."""
    return analyst_view.filter(F.col("region") == access_region)


def governed_views(
    dim: DataFrame, payments: DataFrame, access_region: str = DEFAULT_REGION
) -> dict[str, DataFrame]:
    """The role-scoped views over a dimension and the payments."""
    analyst = gov_borrower_analyst(dim)
    return {
        "gov_borrower_risk_analyst": gov_borrower_risk_analyst(dim),
        "gov_borrower_analyst": analyst,
        "gov_payments_analyst": gov_payments_analyst(payments),
        "gov_borrower_regional": gov_borrower_regional(analyst, access_region),
    }


def row_access_entitled(dim: DataFrame, role: str, entitlements: DataFrame) -> DataFrame:
    """Rows whose region the role may see; privileged roles see all.

    The entitlement side is reduced to distinct known regions, so at most four
    rows are broadcast whatever the size of the table.
    """
    if role in PRIVILEGED_ROLES:
        return dim
    allowed = (
        entitlements.filter((F.col("role_name") == role) & F.col("region").isin(*REGIONS))
        .select("region")
        .distinct()
    )
    return dim.join(F.broadcast(allowed), "region", "left_semi").select(*dim.columns)


def pii_leaks(analyst_view: DataFrame, payments_view: DataFrame) -> DataFrame:
    """Every value an analyst should not see: (violation, id); empty means pass.

    Each view is scanned once; a row may break several rules.
    """
    client = F.col("client_id").cast("string")
    borrower_rules = {
        "age_not_masked": F.col("age").isNotNull(),
        "credit_limit_not_masked": F.col("credit_limit").isNotNull(),
    }
    payment_rules = {
        "email_not_masked": ~F.col("borrower_email").like(MASKED_LOCAL_PART + "@%"),
        "ip_not_masked": F.col("borrower_ip") != MASKED_IP,
    }
    return _violations(analyst_view, client, borrower_rules).unionByName(
        _violations(payments_view, F.col("txn_id"), payment_rules)
    )


def _violations(view: DataFrame, key, rules: Mapping) -> DataFrame:
    broken = F.filter(
        F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]),
        lambda name: name.isNotNull(),
    )
    return view.select(F.explode(broken).alias("violation"), key.alias("id"))


def row_access_leaks(regional_view: DataFrame, access_region: str = DEFAULT_REGION) -> DataFrame:
    """Clients outside the region the view promises; empty means pass."""
    return regional_view.filter(F.col("region") != access_region).select("client_id")


def classification_report(df: DataFrame, table: str, policy: Mapping[str, str]) -> DataFrame:
    """Per column: its class, the masking method attached, and the values held."""
    counted = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(f.name).alias("column_name"),
            F.lit(class_of(f)).alias("classification"),
            F.lit(policy.get(f.name)).cast("string").alias("masking"),
            F.col(f.name).alias("n_values"),
        )
        for f in df.schema.fields
    ]
    return counted.select(F.inline(F.array(*rows)))
