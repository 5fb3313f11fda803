"""Supply-chain reporting on Spark DataFrames.

``plans.runs.report`` goes from date folders to written reports, ``run`` to lazy
results; the operators can be used one by one on any DataFrame of sheet rows or facts.
"""

from supplyview.plans.runs import (
    Options,
    Results,
    combine,
    finished_tables,
    publish,
    report,
    reports,
    route,
    run,
    tables,
    whole_tables,
)

__all__ = [
    "Options", "Results", "combine", "finished_tables", "publish", "report", "reports", "route", "run",
    "tables", "whole_tables",
]
