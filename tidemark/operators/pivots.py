"""Long rows to wide ones, and shares by category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import round_half_up

# Labels of filings' holdings, their column names and how they count for the shares.
CATEGORIES = """
U.S. Treasury Debt | usTreasuryDebt | USGO
U.S. Government Agency Debt | usGovernmentAgencyDebt | USGO
U.S. Government Agency Debt (if categorized as coupon-paying notes) | usGovernmentAgencyCouponDebt | USGO
U.S. Government Agency Debt (if categorized as no-coupon discount notes) | usGovernmentAgencyZeroCouponDebt | USGO
Non-U.S. Sovereign, Sub-Sovereign and Supra-National debt | nonUSSovereignDebt | other
Certificate of Deposit | certificateofDeposit | other
Non-Negotiable Time Deposit | nonNegotiableTimeDeposit | other
Variable Rate Demand Note | variableRateDemandNote | exempt
Other Municipal Security | otherMunicipalSecurity | exempt
Asset Backed Commercial Paper | assetBackedCommercialPaper | other
Other Asset Backed Securities | otherAssetBackedSecurities | other
U.S. Treasury Repurchase Agreement, if collateralized only by U.S. Treasuries (including Strips) and cash | usTreasuryRepurchaseAgreement | other
U.S. Government Agency Repurchase Agreement, collateralized only by U.S. Government Agency securities, U.S. Treasuries, and cash | usGovernmentAgencyRepurchaseAgreement | other
Other Repurchase Agreement, if collateral falls outside Treasury, Government Agency and cash | otherRepurchaseAgreement | other
Other Repurchase Agreement, if any collateral falls outside Treasury, Government Agency and cash | otherRepurchaseAgreement | other
Insurance Company Funding Agreement | insuranceCompanyFundingAgreement | other
Financial Company Commercial Paper | financialCompanyCommercialPaper | other
Investment Company | financialCompanyCommercialPaper | other
Non-Financial Company Commercial Paper | nonFinancialCompanyCommercialPaper | other
Tender Option Bond | tenderOptionBond | exempt
Other Instrument | otherInstrument | other
"""
#: Commercial paper is exempt in municipal funds.
EXEMPT_IN_MUNI = ("financialCompanyCommercialPaper", "nonFinancialCompanyCommercialPaper")
MUNI = ("Muni", "SingleState")


def categories() -> list[tuple[str, str, str]]:
    return [tuple(x.strip() for x in line.split("|")) for line in CATEGORIES.strip().split("\n")]


def fund_category(label: Column) -> Column:
    return (
        F.when(label.isin("Exempt Government", "Government", "Government/Agency"), "Government")
        .when(label == "Other Tax Exempt", "Muni")
        .when(label == "Single State", "SingleState")
        .when(label.isin("Prime", "Treasury"), label)
        .otherwise(F.raise_error(F.concat(F.lit("category not found: "), label)))
    )


def latest_by_type(df: DataFrame, keys: list[str], kind: str, amount: str, order: str, names: dict[str, str]) -> DataFrame:
    """A column for each type with its last amount, and their total at six digits."""
    last = lambda k: F.max_by(F.when(F.col(kind) == k, F.col(amount)), F.when(F.col(kind) == k, F.col(order)))
    wide = df.groupBy(*keys).agg(*[last(k).alias(n) for k, n in names.items()])
    total = sum((F.coalesce(n, F.lit(0.0)) for n in names.values()), F.lit(0.0))
    return wide.withColumn("total", round_half_up(total, 6))


def category_shares(holdings: DataFrame, keys: list[str], category: str, value: str, names: list[str]) -> DataFrame:
    """A column for each category with its share of the key's total at five digits."""
    wide = holdings.groupBy(*keys).pivot(category, names).agg(F.sum(value))
    total = sum((F.coalesce(n, F.lit(0.0)) for n in names), F.lit(0.0))
    shares = [F.when(F.col("__total") > 0, round_half_up(F.coalesce(F.col(n), F.lit(0.0)) / F.col("__total"), 5)).otherwise(0.0).alias(n) for n in names]
    return wide.withColumn("__total", total).select(*keys, F.col("__total").alias("total"), *shares)


def holdings_report(holdings: DataFrame, fund: str, kind: str) -> DataFrame:
    """(fund, USGO, Muni, total): shares of government obligations and tax-exempt holdings. holdings:
    fund, category label, value, and the fund's kind."""
    spark = holdings.sparkSession
    known = spark.createDataFrame(categories(), "category string, name string, treatment string")
    rows = holdings.join(F.broadcast(known), "category", "left")
    rows = rows.filter(F.when(F.col("name").isNull(), F.raise_error(F.concat(F.lit("category not found: "), F.col("category"))).cast("boolean")).otherwise(True))
    exempt = (F.col("treatment") == "exempt") | (F.col("name").isin(*EXEMPT_IN_MUNI) & F.col(kind).isin(*MUNI))
    total = F.sum("value")
    return rows.groupBy(fund).agg(
        round_half_up(F.sum(F.when(F.col("treatment") == "USGO", F.col("value")).otherwise(0.0)) / total, 5).alias("USGO"),
        round_half_up(F.sum(F.when(exempt, F.col("value")).otherwise(0.0)) / total, 5).alias("Muni"),
        total.alias("total"),
    )


def yearly_weighted(df: DataFrame, keys: list[str], shares: list[str], weight: str) -> DataFrame:
    """Yearly means of monthly shares, weighted by assets, at five digits."""
    mean = lambda c: round_half_up(F.sum(F.col(c) * F.col(weight)) / F.sum(weight), 5).alias(c)
    return df.groupBy(*keys).agg(F.count("*").alias("months"), *map(mean, shares), F.avg(weight).alias("assets"))
