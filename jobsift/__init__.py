"""jobsift: cleaning and reporting of job postings as Spark DataFrame jobs.

Every public function is either Column -> Column (``jobsift.functions``) or
DataFrame -> DataFrame (``operators``, ``plans``), so Catalyst sees the whole
plan and nothing runs row-at-a-time in Python.
"""

__version__ = "0.1.0"
