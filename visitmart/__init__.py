"""visitmart: clinical-operations datamarts and patient lists on Spark.

* ``functions``: column rules for text and dates (collation, QUOTENAME,
  day and rolling windows, formats).
* ``operators``: the jobs, DataFrame in and DataFrame out.
* ``sources``: loader-style CSV reads, extract export, refresh and append.
* ``streaming``: the exactly-once append loader over a landing folder.
* ``plans``: the test-table bindings and the registered queries with
  their oracle SQL.
"""
