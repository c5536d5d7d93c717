from tallybook.plans.mart import MartRules, build_mart, metric_union, write_mart
from tallybook.plans.quality import alerts, long_report, quality_report
from tallybook.plans.status import daily_status

__all__ = [
    "MartRules",
    "alerts",
    "build_mart",
    "daily_status",
    "long_report",
    "metric_union",
    "quality_report",
    "write_mart",
]
