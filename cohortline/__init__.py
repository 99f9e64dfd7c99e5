"""cohortline: marketing attribution and policy-retention analytics on Spark.

Sub-packages: ``sources`` (inputs and schemas), ``functions`` (Column
builders), ``operators`` (DataFrame -> DataFrame steps), ``plans`` (the
reports, scheduled jobs and the query catalog). See README.md.
"""

__version__ = "0.1.0"
