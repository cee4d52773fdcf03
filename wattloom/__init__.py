"""Spark-native disaggregation of coarse annual totals to fine places and hours.

The package is organised by what a caller needs:

* ``functions``  - Column expressions (number rules, calendar, text).
* ``sources``    - readers and writers around ``spark.read`` / ``df.write``.
* ``operators``  - DataFrame -> DataFrame building blocks.
* ``plans``      - the energy domain: multiplier catalogues and staged workflow.
* ``registry``   - the queries exposed by ``__spark_entry__``.

Nothing here collects data to the driver; every function returns a lazy
DataFrame or starts one write.
"""

__version__ = "0.1.0"
