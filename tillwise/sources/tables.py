"""Reading, conforming and writing tables."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read Parquet, or headed CSV when the path ends in ``.csv`` or ``.csv.gz``."""
    if path.endswith((".csv", ".csv.gz")):
        reader = spark.read.option("header", True)
        return (reader.schema(schema) if schema else reader).csv(path)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def first_table(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The first of several paths that exists."""
    for path in paths:
        try:
            return read_table(spark, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(", ".join(paths))


def conform(
    df: DataFrame,
    schema: Mapping[str, str],
    aliases: Mapping[str, str] | None = None,
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Shape any vintage of a table to ``schema`` (column -> Spark type) in one projection.

    ``aliases`` maps other column names to ours. Absent columns take their default, or
    null; a default given as a Column may refer to the columns present. Values that do
    not parse become null.
    """
    sources = {ours: other for other, ours in (aliases or {}).items() if other in df.columns}
    sources.update({name: name for name in schema if name in df.columns})
    out = []
    for name, kind in schema.items():
        if name in sources:
            out.append(F.col(f"`{sources[name]}`").try_cast(kind).alias(name))
        else:
            value = (defaults or {}).get(name)
            column = value if isinstance(value, Column) else F.lit(value)
            out.append(column.cast(kind).alias(name))
    return df.select(*out)


def drop_repeated_headers(df: DataFrame, column: str) -> DataFrame:
    """Remove header lines that ended up among the data of appended CSV files."""
    return df.where(~F.col(column).eqNullSafe(F.lit(column)))


def coerce(
    df: DataFrame, numeric: Sequence[str] = (), dates: Sequence[str] = (), required: Sequence[str] = ()
) -> DataFrame:
    """Parse text columns, unparseable values to null, and drop rows lacking a required one."""
    casts = {c: F.col(c).try_cast("double") for c in numeric}
    casts.update({c: F.col(c).try_cast("date") for c in dates})
    parsed = df.withColumns(casts) if casts else df
    return parsed.dropna(subset=list(required)) if required else parsed


def rejected_rows(df: DataFrame, numeric: Sequence[str] = (), dates: Sequence[str] = ()) -> DataFrame:
    """Per column, how many non-null texts do not parse."""
    kinds = [(c, "double") for c in numeric] + [(c, "date") for c in dates]
    counts = [
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()).alias(c)
        for c, kind in kinds
    ]
    return df.agg(*counts)


def stack_vintages(parts: Sequence[DataFrame], renames: Sequence[Mapping[str, str]]) -> DataFrame:
    """Rename each part's differing columns and append all rows, duplicates kept."""
    renamed = [df.withColumnsRenamed(dict(names)) for df, names in zip(parts, renames)]
    out = renamed[0]
    for other in renamed[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", fmt: str = "parquet"
) -> None:
    """Write a table; with ``mode="append"`` new rows join the earlier ones."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def save_params(spark: SparkSession, path: str, params: Mapping[str, object]) -> None:
    """Keep tuned parameters as a one-row JSON table."""
    spark.createDataFrame([(json.dumps(dict(params), sort_keys=True),)], "params string") \
        .write.mode("overwrite").text(path)


def load_params(spark: SparkSession, path: str, default: Mapping[str, object]) -> dict:
    """The kept parameters, or ``default`` where none were kept."""
    try:
        row = spark.read.text(path).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return dict(default)
    return json.loads(row[0]) if row else dict(default)


def save_models(spark: SparkSession, path: str, models: Mapping[str, object], metadata: Mapping[str, object]) -> None:
    """Write each model with its own writer and the metadata beside them."""
    for name, model in models.items():
        model.write().overwrite().save(f"{path}/{name}")
    save_params(spark, f"{path}/metadata", {**metadata, "models": sorted(models)})
