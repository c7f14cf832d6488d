"""Amounts that follow from quantity, prices, tax rate and coupon, in exact decimals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

STORED = "decimal(14,2)"

# The amounts that the partial form of an update refreshes; the others stay as they were.
PAID_AMOUNTS = ["ext_sales_price", "ext_tax", "net_paid", "net_paid_inc_tax"]


def _stored(amount: Column) -> Column:
    """Keep full scale while computing; round half up once, when the amount is stored."""
    return amount.cast(STORED)


def sale_amounts() -> dict[str, Column]:
    quantity = F.col("quantity").cast("decimal(9,0)")
    ext_sales = F.col("sales_price") * quantity
    ext_wholesale = F.col("wholesale_cost") * quantity
    tax = ext_sales * F.col("tax_rate")
    net_paid = ext_sales - F.col("coupon_amt")
    return {
        "ext_discount_amt": _stored((F.col("list_price") - F.col("sales_price")) * quantity),
        "ext_sales_price": _stored(ext_sales),
        "ext_wholesale_cost": _stored(ext_wholesale),
        "ext_list_price": _stored(F.col("list_price") * quantity),
        "ext_tax": _stored(tax),
        "net_paid": _stored(net_paid),
        "net_paid_inc_tax": _stored(net_paid + tax),
        "net_profit": _stored(net_paid - ext_wholesale),
    }


def with_sale_amounts(df: DataFrame) -> DataFrame:
    """Needs quantity, list_price, wholesale_cost, sales_price, tax_rate and coupon_amt."""
    return df.withColumns(sale_amounts())


def with_amounts_after_update(df: DataFrame, paid_only: bool = False) -> DataFrame:
    """Refresh the derived amounts of rows whose quantity or coupon changed.

    By default every dependent amount follows. ``paid_only`` refreshes the paid amounts alone
    and leaves discount, wholesale, list amount and profit stale, for users who rely on that.
    """
    fresh = sale_amounts()
    return df.withColumns({n: c for n, c in fresh.items() if not paid_only or n in PAID_AMOUNTS})


def with_return_amounts(df: DataFrame) -> DataFrame:
    """Needs return_amt, tax_rate, fee, ship_cost, cash_share and reversed_share.

    The refund splits into cash, reversed charge and store credit. The credit is what the
    two rounded parts leave over, so the three always add up to the refunded total.
    """
    tax = _stored(F.col("return_amt") * F.col("tax_rate"))
    total = F.col("return_amt") + tax
    cash = _stored(total * F.col("cash_share"))
    reversed_charge = _stored((total - cash) * F.col("reversed_share"))
    return df.withColumns({
        "return_tax": tax,
        "return_amt_inc_tax": _stored(total),
        "refunded_cash": cash,
        "reversed_charge": reversed_charge,
        "store_credit": _stored(total - cash - reversed_charge),
        "net_loss": _stored(F.col("return_amt") + F.col("fee") + F.col("ship_cost")),
    })


def capped_return_quantity(wanted: Column, sold: Column) -> Column:
    """No more can come back than was sold."""
    return F.least(wanted, sold)
