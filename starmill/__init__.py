"""Star-schema warehouse loads for flight data, written as PySpark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; only :mod:`starmill.sources` and
:mod:`starmill.plans.warehouse` touch storage.
"""
