"""tableward: table quality assessment, cleaning and profiling as Spark jobs.

Every public operator is a function from DataFrame to DataFrame.  Decisions
that hold for a whole table (which column to drop, which value fills a gap,
where an outlier fence lies) are taken from one-row aggregates and put back
into the plan as literals, so the plans stay flat however large the table is.
"""

from tableward.config import QualityConfig

__all__ = ["QualityConfig"]
__version__ = "0.1.0"
