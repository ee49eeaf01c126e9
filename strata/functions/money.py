"""Exact money arithmetic, as SQL expressions.

Prices and discounts arrive as doubles holding cent values. Summing doubles
gives an answer that depends on the order of addition, which differs between
runs, partitionings and engines; a total rounded to cents can then flip in the
last digit. So amounts are cast to decimals first and summed exactly.

Input rule: a price is a whole number of cents below 10^10, a discount a whole
number of hundredths below 10; either may be null. Anything else (a third
decimal place, a larger amount, NaN) raises an error that names the value, with
ANSI mode on or off. Nothing is rounded before the sum but the noise of binary
arithmetic, a relative 1e-14: 1 + 14/100 is 1.1400000000000001 as a double.

decimal(12,2) times decimal(4,2) is decimal(17,4); a sum widens that by 10
digits, so a total of up to 10^23 fits.
"""

from __future__ import annotations

# Decimal types for input amounts: price up to 10^10 - 0.01, discount a
# fraction in [0, 9.99].
PRICE_TYPE = "DECIMAL(12,2)"
RATE_TYPE = "DECIMAL(3,2)"


def exact_sql(value: str, decimal_type: str, what: str) -> str:
    """``value`` (a double) as a decimal; an error if that is another number."""
    # try_cast gives null for NaN, infinities and overflow in either ANSI mode.
    return (
        f"CASE WHEN {value} IS NULL THEN CAST(NULL AS {decimal_type}) "
        f"WHEN abs(CAST(try_cast({value} AS {decimal_type}) AS DOUBLE) - {value}) <= 1e-14 * abs({value}) THEN try_cast({value} AS {decimal_type}) "
        f"ELSE CAST(raise_error(concat('{what} is not a {decimal_type}: ', CAST({value} AS STRING))) AS {decimal_type}) END"
    )


def net_revenue_sql(price: str, discount: str) -> str:
    """``price * (1 - discount)`` as an exact decimal(17,4)."""
    return f"{exact_sql(price, PRICE_TYPE, price)} * (1 - {exact_sql(discount, RATE_TYPE, discount)})"


def report_amount_sql(total: str) -> str:
    """An exact total rounded to cents (half up), as a double."""
    return f"CAST(round({total}, 2) AS DOUBLE)"
