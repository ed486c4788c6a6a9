"""minutewise: serverless invocation-trace analytics and demand-forecast preparation on Spark.

Every operator is a pure function DataFrame -> DataFrame (or Column builder) expressed with
built-in Spark SQL functions, so Catalyst plans the whole lineage and nothing leaves the JVM.
"""

__version__ = "0.1.0"
