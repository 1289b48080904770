"""PySpark-native lakehouse engine for map-tile speed measurements.

Every operator is a ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function; only ``sinks``, ``plans`` and ``streaming`` run Spark jobs that write.
"""
