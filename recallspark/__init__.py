"""Product-recall surveillance analytics as DataFrame -> DataFrame transformations."""

import sys

from pyspark import cloudpickle

from recallspark.operators.categorize import categorize, summary_by
from recallspark.operators.ranking import repeat_offenders, top_manufacturers, top_product_categories
from recallspark.operators.risk import score, tier_distribution
from recallspark.plans.report import build_report, report_lines
from recallspark.session import build_session

__all__ = ["build_report", "build_session", "categorize", "repeat_offenders", "report_lines", "score", "summary_by",
           "tier_distribution", "top_manufacturers", "top_product_categories"]

# Functions of this package travel to the Python workers by value, so the executors need not have
# it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
