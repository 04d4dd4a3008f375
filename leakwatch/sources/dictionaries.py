"""One-column dictionary files (risky domains, keywords, roles, extensions).

Two ways in:

* ``load_dictionary`` reads the file with Spark and returns a cleaned one-column
  DataFrame (trimmed, optionally lower-cased, blanks and duplicates dropped).
  Use it for dictionaries of any size; the join-based matchers take it as is.
* ``dictionary_values`` turns such a DataFrame into a Python list for the
  in-plan pattern matchers, but only after checking it stays under a bound.
"""

from __future__ import annotations

import csv
import os
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leakwatch.functions.patterns import clean_entries

# Largest dictionary turned into an in-plan pattern; bigger ones go through joins.
MAX_PATTERN_ENTRIES = 5000


def load_dictionary(
    spark: SparkSession, path: str, column: str, lower: bool = True, out_col: str = "value"
) -> DataFrame:
    """Read a header CSV and return its cleaned column as ``out_col``."""
    schema = T.StructType([T.StructField(column, T.StringType())])
    raw = spark.read.option("header", True).schema(schema).csv(path)
    v = F.trim(F.col(column))
    if lower:
        v = F.lower(v)
    return raw.select(v.alias(out_col)).where(F.col(out_col).isNotNull() & (F.length(out_col) > 0)).distinct()


def dictionary_values(df: DataFrame, column: str = "value", max_entries: int = MAX_PATTERN_ENTRIES) -> list[str]:
    """Collect a dictionary DataFrame after proving it holds at most ``max_entries`` rows."""
    head = df.select(column).limit(max_entries + 1).collect()
    if len(head) > max_entries:
        raise ValueError(
            f"dictionary has more than {max_entries} entries; use the join-based matcher"
        )
    return sorted(clean_entries(r[0] for r in head))


def read_dictionary_file(path: str, column: str, lower: bool = True, max_bytes: int = 1 << 20) -> list[str]:
    """Driver-side read of a small dictionary file (size-checked first)."""
    size = os.path.getsize(path)
    if size > max_bytes:
        raise ValueError(f"{path} is {size} bytes; load it with load_dictionary instead")
    with open(path, newline="", encoding="utf-8") as fh:
        rows = list(csv.DictReader(fh))
    return clean_entries((r.get(column) for r in rows), lower=lower)


def packaged_path(name: str) -> str:
    """Path of a dictionary shipped inside the package (the test fixtures)."""
    return str(resources.files("leakwatch").joinpath("data", name))
