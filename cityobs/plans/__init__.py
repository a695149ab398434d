from cityobs.plans.stats import monthly_stats
from cityobs.plans.sunny import sunny_periods
from cityobs.plans.swing import seasonal_swing

__all__ = ["monthly_stats", "seasonal_swing", "sunny_periods"]
