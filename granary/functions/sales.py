"""Amount and order-number expressions of the sales fact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(19,4)"


def discount_amount(discount: Column, unit_price: Column) -> Column:
    """Discount for one unit; the quantity does not enter."""
    return discount * unit_price


def sales_amount(line_total: Column, discount: Column, unit_price: Column) -> Column:
    return (line_total - discount_amount(discount, unit_price)).cast(MONEY)


def product_cost(quantity: Column, unit_cost: Column) -> Column:
    return (quantity * unit_cost).cast(MONEY)


def order_id(order_number: Column) -> Column:
    """The number behind the two-letter prefix, NULL where it is not a number."""
    return F.substring(order_number, 3, F.length(order_number)).try_cast("bigint")


def account_number(customer_id: Column) -> Column:
    """The prefix and the last eight digits of the customer's number, padded with zeros."""
    return F.concat(F.lit("AW"), F.lpad(F.right(customer_id.cast("string"), F.lit(8)), 8, "0"))
