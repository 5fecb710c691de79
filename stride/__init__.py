"""stride — employee-benefit analytics as Spark DataFrame jobs.

People, practice and activity data go through raw, staging and mart layers;
eligibility and amounts are computed with DataFrame operators that Catalyst
and adaptive execution plan.  See README.md for the module map.
"""

__version__ = "0.1.0"
