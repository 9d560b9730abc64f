"""Business rules as columns: first match wins in every chain."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .times import whole_days

# Sentinels and limits of the rules.
NEVER_DAYS = 999
CHURN_DAYS, RISK_DAYS = 90, 30
VIP_ORDERS, VIP_SPEND, RISK_ORDERS, NEW_ORDERS = 5, 500, 3, 2
VELOCITY_DAYS, LEAD_DAYS, DEAD_DAYS, LOW_STOCK = 7, 7, 30, 10
HEALTHY_DAYS, LOW_DAYS, SUPPLY_DAYS, MIN_RESTOCK = 60, 30, 30, 5


def recency_days(last_order: Column, as_of: Column) -> Column:
    return F.coalesce(whole_days(as_of, last_order), F.lit(NEVER_DAYS).cast("bigint"))


def segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    return (
        F.when(recency > CHURN_DAYS, "Churned")
        .when((frequency >= VIP_ORDERS) & (monetary >= VIP_SPEND), "VIP")
        .when((recency > RISK_DAYS) & (frequency >= RISK_ORDERS), "At-Risk")
        .when(frequency <= NEW_ORDERS, "New")
        .otherwise("Regular")
    )


def average(total: Column, count: Column) -> Column:
    """Mean as DOUBLE; 0 without rows."""
    return F.coalesce(F.try_divide(total.cast("double"), count.cast("double")), F.lit(0.0))


def velocity(units: Column) -> Column:
    """Units per day over the velocity window."""
    return F.coalesce(units, F.lit(0)).cast("double") / F.lit(float(VELOCITY_DAYS))


def days_left(stock: Column, units: Column) -> Column:
    """Days until stock-out from the units sold in the velocity window; the sentinel if none.

    One division of whole numbers: halves that decide a rounding stay exact.
    """
    whole = (stock * VELOCITY_DAYS).cast("double")
    return F.when(units > 0, whole / units.cast("double")).otherwise(F.lit(float(NEVER_DAYS)))


def days_left_output(days: Column) -> Column:
    """One decimal, null from the sentinel on."""
    return F.when(days < NEVER_DAYS, F.round(days, 1))


def stock_status(stock: Column, days: Column) -> Column:
    return (
        F.when(stock == 0, "out_of_stock")
        .when(days > HEALTHY_DAYS, "healthy")
        .when(days <= LEAD_DAYS, "critical")
        .when(stock < LOW_STOCK, "low")
        .when(days < LOW_DAYS, "low")
        .otherwise("healthy")
    )


def is_dead_stock(last_sale: Column, now: Column) -> Column:
    return last_sale.isNull() | (whole_days(now, last_sale) > DEAD_DAYS)


def restock_advice(stock: Column, speed: Column, days: Column) -> Column:
    """Restock struct, or null when none is due."""
    quantity = F.greatest(F.lit(0.0), speed * SUPPLY_DAYS - stock)
    due = (days <= LOW_DAYS) & (speed > 0) & (quantity >= MIN_RESTOCK)
    return F.when(
        due,
        F.struct(
            F.lit("restock").alias("action"),
            F.floor(quantity).cast("bigint").alias("recommended_quantity"),
            F.when(days <= LEAD_DAYS, "high").otherwise("medium").alias("urgency"),
            F.concat(
                F.lit("Current stock will last "),
                F.round(days, 1).cast("decimal(10,1)").cast("string"),
                F.lit(" days at current velocity"),
            ).alias("reason"),
        ),
    )
