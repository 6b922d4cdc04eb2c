"""Shop event analytics as Spark DataFrame transformations.

Packages:

* ``functions``  column expressions
* ``operators``  DataFrame to DataFrame, shared by batch and streaming
* ``sources``    readers
* ``sinks``      writers
* ``plans``      the daily batch job
* ``streaming``  Structured Streaming queries
"""
