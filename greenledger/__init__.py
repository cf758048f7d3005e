"""greenledger: auditable sustainability and safety reporting on Spark.

Dirty all-string submissions go in; declarative data-quality rules, typed
staging, a validity-dated star schema and gap-preserving KPIs come out.
Every operator is a ``DataFrame -> DataFrame`` function over the public
PySpark API, so Catalyst plans and AQE re-plans the whole chain.
"""

__version__ = "0.1.0"
