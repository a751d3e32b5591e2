"""CSV export sink for the marts.

One CSV file per mart: header row, null as an empty field, ``true/false``
booleans, explicit column order and sort. The mart is aggregated in parallel;
only its result rows go through the exchange that brings them into the order
and the one file of the export. Marts have a row per funnel step, transition,
check, category label, or (channel, device) pair that occurs.

``export_all`` writes several marts and a manifest beside them: columns in the
order of the file with their types, the number of rows and a checksum of their
values, observed while the file is written. ``read_exports`` reads the files
by the manifest alone and compares all of that, so a file that was cut, edited or
replaced is refused.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Export sort orders: (mart name, sort columns with direction).
EXPORT_ORDER = {
    "funnel_summary": [("funnel_type", "asc"), ("step_order", "asc")],
    "channel_device_performance": [("sessions_entered_funnel", "desc"), ("traffic_channel", "asc"), ("device_category", "asc")],
    "category_performance": [("category_view_sessions", "desc"), ("cleaned_item_category", "asc")],
    "revenue_leakage": [("overall_leakage_rank", "asc"), ("funnel_type", "asc")],
    "friction_score": [("overall_friction_rank", "asc"), ("funnel_type", "asc")],
    "data_quality_checks": [("check_area", "asc"), ("check_name", "asc")],
}
MART_NAMES = list(EXPORT_ORDER)
# The friction export puts the two rank columns first.
EXPORT_LEADING = {"friction_score": ["overall_friction_rank", "friction_rank_within_funnel"]}


def export_columns(name: str, columns: list[str]) -> list[str]:
    lead = EXPORT_LEADING.get(name, [])
    return lead + [c for c in columns if c not in lead]


def export_frame(name: str, df: DataFrame) -> DataFrame:
    if name not in EXPORT_ORDER:
        raise ValueError(f"no export order for {name!r}; marts are {MART_NAMES}")
    order = [F.col(c).desc() if d == "desc" else F.col(c).asc() for c, d in EXPORT_ORDER[name]]
    return df.select(*export_columns(name, df.columns)).repartition(1).sortWithinPartitions(*order)


MANIFEST = "manifest"
MANIFEST_SCHEMA = "mart string, columns string, n_rows long, checksum decimal(38,0)"


class ExportMismatch(ValueError):
    """An exported file is not what the manifest says."""


def _metrics(columns: list[str]) -> list[Column]:
    """Rows, and an order-free checksum of their values as the file has them
    (an empty text is written as a null)."""
    as_text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    checksum = F.sum(F.xxhash64(*as_text).cast("decimal(38,0)"))
    return [F.count(F.lit(1)).alias("n_rows"), F.coalesce(checksum, F.lit(0).cast("decimal(38,0)")).alias("checksum")]


def write_csv(name: str, df: DataFrame, out_dir: str, watch: Callable[[str, DataFrame], DataFrame] | None = None) -> str:
    """``watch``: may observe the frame that is written."""
    path = f"{out_dir.rstrip('/')}/{name}"
    frame = export_frame(name, df)
    _write(watch(name, frame) if watch else frame, path)
    return path


def _write(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def read_csv(name: str, schema: T.StructType, out_dir: str, spark: SparkSession) -> DataFrame:
    """An exported mart with the columns of ``schema``."""
    columns = export_columns(name, schema.names)
    declared = T.StructType([schema[c] for c in columns])
    path = f"{out_dir.rstrip('/')}/{name}"
    return spark.read.schema(declared).option("header", True).option("nullValue", "").csv(path).select(*schema.names)


def export_all(marts: dict[str, DataFrame], out_dir: str) -> str:
    """Write the marts (name -> rows) and their manifest, the manifest last: a
    folder without one is an export that did not end."""
    base, rows, spark = out_dir.rstrip("/"), [], None
    for name, df in marts.items():
        spark = df.sparkSession
        frame = export_frame(name, df)
        seen = Observation(f"export {name}")
        _write(frame.observe(seen, *_metrics(frame.columns)), f"{base}/{name}")
        got = seen.get
        rows.append((name, frame.schema.json(), got["n_rows"], got["checksum"]))
    if spark:
        # One row per mart.
        spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{base}/{MANIFEST}")
    return base


def read_exports(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The exported marts (name -> rows, columns in the order of the file), each
    compared with the manifest: header, types, number of rows, checksum."""
    base, out = out_dir.rstrip("/"), {}
    for row in spark.read.schema(MANIFEST_SCHEMA).parquet(f"{base}/{MANIFEST}").orderBy("mart").collect():  # a row per mart
        schema = T.StructType.fromJson(json.loads(row["columns"]))
        path = f"{base}/{row.mart}"
        header = spark.read.option("header", True).csv(path).columns
        if header != schema.names:
            raise ExportMismatch(f"{row.mart}: columns {header}, not {schema.names}")
        df = spark.read.schema(schema).option("header", True).option("nullValue", "").option("mode", "FAILFAST").csv(path)
        got = df.agg(*_metrics(schema.names)).first()
        if (got["n_rows"], got["checksum"]) != (row["n_rows"], row["checksum"]):
            raise ExportMismatch(f"{row.mart}: {got['n_rows']} rows, checksum {got['checksum']}; written were {row['n_rows']}, {row['checksum']}")
        out[row.mart] = df
    return out


def as_cells(name: str, df: DataFrame) -> DataFrame:
    """A mart as one row per value: ``mart, row_number`` (in the order of the
    export), ``position, column_name`` (from 1), and the value as
    ``text_value`` (texts and booleans) or ``number_value``."""
    order = [F.col(c).desc() if d == "desc" else F.col(c).asc() for c, d in EXPORT_ORDER[name]]
    cells = []
    for i, field in enumerate(df.schema, 1):
        textual = isinstance(field.dataType, (T.StringType, T.BooleanType))
        text = F.col(field.name).cast("string") if textual else F.lit(None).cast("string")
        number = F.lit(None).cast("double") if textual else F.col(field.name).cast("double")
        cells.append(F.struct(F.lit(i).alias("position"), F.lit(field.name).alias("column_name"), text.alias("text_value"), number.alias("number_value")))
    # A mart has a bounded number of rows (see above).
    numbered = df.select("*", F.row_number().over(Window.orderBy(*order)).alias("row_number"))
    return numbered.select(F.lit(name).alias("mart"), "row_number", F.inline(F.array(*cells)))
