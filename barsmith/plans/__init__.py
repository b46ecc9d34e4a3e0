from barsmith.plans.daily_fact import daily_performance, daily_performance_fused
from barsmith.plans.portfolio import portfolio_performance
from barsmith.plans.summary import stock_summary

__all__ = ["daily_performance", "daily_performance_fused", "portfolio_performance", "stock_summary"]
