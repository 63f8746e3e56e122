"""Schema contract check and feature-table diff (schema only, no scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _types(schema: StructType) -> dict:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def contract_check(spark: SparkSession, df: DataFrame, expected) -> DataFrame:
    """``(column, status, expected, actual)``; status ``missing`` (fails
    the contract), ``extra`` (a note), ``type_mismatch`` or ``ok``.
    ``expected``: StructType or ``{name: type}`` / list of names."""
    if isinstance(expected, StructType):
        exp = _types(expected)
    elif isinstance(expected, dict):
        exp = dict(expected)
    else:
        exp = {c: None for c in expected}
    act = _types(df.schema)
    rows = []
    for c, t in exp.items():
        if c not in act:
            rows.append((c, "missing", t, None))
        elif t is not None and t != act[c]:
            rows.append((c, "type_mismatch", t, act[c]))
        else:
            rows.append((c, "ok", t, act[c]))
    rows += [(c, "extra", None, t) for c, t in act.items() if c not in exp]
    return spark.createDataFrame(rows, "column string, status string, expected string, actual string")


def contract_ok(check: DataFrame) -> bool:
    return check.where("status = 'missing'").limit(1).count() == 0


def feature_diff(spark: SparkSession, original: DataFrame, processed: DataFrame, selected=()) -> DataFrame:
    """``(column, status, original_type, processed_type, selected)`` with
    status ``kept`` / ``added`` / ``dropped`` (full outer on the name)."""
    o, p = _types(original.schema), _types(processed.schema)
    sel = set(selected)
    rows = []
    for c in list(o) + [c for c in p if c not in o]:
        status = "kept" if c in o and c in p else ("dropped" if c in o else "added")
        rows.append((c, status, o.get(c), p.get(c), c in sel))
    return spark.createDataFrame(rows, "column string, status string, original_type string, "
                                       "processed_type string, selected boolean")
