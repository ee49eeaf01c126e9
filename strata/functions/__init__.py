from strata.functions.money import exact_sql, net_revenue_sql, report_amount_sql

__all__ = ["exact_sql", "net_revenue_sql", "report_amount_sql"]
