"""yearloom: harmonising statistical time series on Spark.

Entry points: ``plans.harmonize.harmonize`` (the whole job), the operators in
``operators``, unit conversion in ``operators.units``, readers and writers in
``sources``.
"""

__version__ = "0.1.0"
