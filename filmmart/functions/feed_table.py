"""H1: a SQL table function over bronze, ``SELECT ... FROM feed(TABLE(t), 'movie_slug', 'details.title')``.

One row per element of each document's array, one text column per named path (dots go into objects), after ``_source_file``. It is for
ad-hoc queries; silver reads its fields in the JVM.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

NAME = "feed"


def register(spark: SparkSession, name: str = NAME) -> None:
    """Registers the function for the session's SQL."""
    from pyspark.sql.functions import udtf
    spark.udtf.register(name, udtf(_handler()))


def _handler():
    """The function's class; defined here so that it goes to the workers by value."""
    class Feed:
        @staticmethod
        def analyze(table, *paths):
            from pyspark.sql.types import StringType, StructType
            from pyspark.sql.udtf import AnalyzeResult
            names = {f.name for f in table.dataType.fields} if table.isTable else set()
            if not {"_source_file", "data"} <= names:
                raise Exception("feed: the first argument must be TABLE(t) with the columns _source_file and data")
            if not paths or any(p.value is None for p in paths):
                raise Exception("feed: name at least one path, as a literal")
            schema = StructType().add("_source_file", StringType())
            for p in paths:
                schema = schema.add(str(p.value).replace(".", "_"), StringType())
            return AnalyzeResult(schema=schema)

        def eval(self, row, *paths):
            import json

            def text(value):
                if value is None or isinstance(value, str):
                    return value
                return json.dumps(value, ensure_ascii=False, separators=(",", ":"))

            elements = json.loads(row["data"]) if row["data"] else None
            for e in elements if isinstance(elements, list) else ():
                out = []
                for p in paths:
                    v = e
                    for part in p.split("."):
                        v = v.get(part) if isinstance(v, dict) else None
                    out.append(text(v))
                yield (row["_source_file"], *out)

    return Feed


__all__ = ["register", "NAME"]
