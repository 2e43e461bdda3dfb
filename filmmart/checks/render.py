"""Output rendering shared by all checks: dates and timestamps as text, so both engines
print them alike (the values are unchanged)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def render(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
