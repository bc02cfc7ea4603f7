"""Source schemas of the air-quality API documents and the limits cell table.

All fields are nullable and read schema-on-read: keys missing from a document
become NULL, extra keys are dropped, a value of the wrong type nulls that field
only (Spark's PERMISSIVE reader).
"""

from pyspark.sql import types as T

# Field names and types of the API documents.
PARAMETER = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("units", T.StringType()),
    T.StructField("displayName", T.StringType()),
    T.StructField("description", T.StringType()),
])

COUNTRY = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("code", T.StringType()),
    T.StructField("datetimeFirst", T.StringType()),
    T.StructField("datetimeLast", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("parameters", T.ArrayType(PARAMETER)),
])

PROVIDER = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("sourceName", T.StringType()),
    T.StructField("datetimeAdded", T.StringType()),
    T.StructField("datetimeFirst", T.StringType()),
    T.StructField("datetimeLast", T.StringType()),
    T.StructField("parameters", T.ArrayType(PARAMETER)),
])

DATETIME = T.StructType([
    T.StructField("utc", T.StringType()),
    T.StructField("local", T.StringType()),
])

SENSOR_PARAMETER = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("units", T.StringType()),
    T.StructField("displayName", T.StringType()),
])

SENSOR = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("parameter", SENSOR_PARAMETER),
])

LOCATION = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("isMobile", T.BooleanType()),
    T.StructField("isMonitor", T.BooleanType()),
    T.StructField("provider", T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
    ])),
    T.StructField("country", T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("code", T.StringType()),
        T.StructField("name", T.StringType()),
    ])),
    T.StructField("coordinates", T.StructType([
        T.StructField("latitude", T.FloatType()),
        T.StructField("longitude", T.FloatType()),
    ])),
    T.StructField("datetimeFirst", DATETIME),
    T.StructField("datetimeLast", DATETIME),
    T.StructField("sensors", T.ArrayType(SENSOR)),
])

PERIOD = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("interval", T.StringType()),
    T.StructField("datetimeFrom", DATETIME),
    T.StructField("datetimeTo", DATETIME),
])

COVERAGE = T.StructType([
    T.StructField("expectedCount", T.IntegerType()),
    T.StructField("observedCount", T.IntegerType()),
    T.StructField("percentComplete", T.FloatType()),
    T.StructField("percentCoverage", T.FloatType()),
])

MEASUREMENT = T.StructType([
    T.StructField("sensor_id", T.IntegerType()),
    T.StructField("value", T.FloatType()),
    T.StructField("parameter", PARAMETER),
    T.StructField("period", PERIOD),
    T.StructField("coverage", COVERAGE),
])

# Commune reference table for the spatial join (replaces the per-point HTTP
# lookup), x = longitude, y = latitude: one ``ring``, or in ``rings`` the rings
# of all parts and holes.
_RING = T.ArrayType(T.StructType([
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
]))
COMMUNE = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("nom", T.StringType()),
    T.StructField("codesPostaux", T.ArrayType(T.StringType())),
    T.StructField("population", T.IntegerType()),
    T.StructField("ring", _RING),
    T.StructField("rings", T.ArrayType(_RING)),
])

# Cells of the regulatory-limits document: row 0 of a table holds the title.
LIMIT_CELLS = T.StructType([
    T.StructField("table_no", T.IntegerType()),
    T.StructField("row_no", T.IntegerType()),
    T.StructField("c0", T.StringType()),
    T.StructField("c1", T.StringType()),
    T.StructField("c2", T.StringType()),
])


def envelope(entity: T.StructType) -> T.StructType:
    """The API page envelope ``{"results": [entity, ...]}``."""
    return T.StructType([T.StructField("results", T.ArrayType(entity))])
