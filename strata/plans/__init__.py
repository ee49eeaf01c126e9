from strata.plans.revenue import revenue_by_region, revenue_by_region_from

__all__ = ["revenue_by_region", "revenue_by_region_from"]
