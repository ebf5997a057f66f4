"""Tables of a filing: optional reads, normalization to the canonical schema, typing errors."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerproof.functions.periods import canonical_period
from ledgerproof.schemas import ALIASES, RECORD_ID, RECORD_TYPE, TABLES


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet at ``path``, or an empty frame of the schema when there is nothing."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def first_available(df: DataFrame, names: list[str], default: str | None = None) -> Column:
    """First of the named columns the frame has, as a column; a literal default otherwise."""
    for name in names:
        if name in df.columns:
            return F.col(name)
    return F.lit(default).cast("string")


def _rename(df: DataFrame, table: str) -> DataFrame:
    """Alternative spellings to canonical names; a canonical column already there wins."""
    taken, renames = set(df.columns), {}
    for old, new in ALIASES[table].items():
        if old in df.columns and new not in taken:
            renames[old] = new
            taken.add(new)
    return df.withColumnsRenamed(renames)


def normalize(df: DataFrame, table: str, metadata: dict[str, str] | None = None) -> DataFrame:
    """Canonical columns and types. Values that do not fit their type become null, never an error;
    ``typing_errors`` reports them. Metadata fills columns the data lacks."""
    renamed, metadata = _rename(df, table), dict(metadata or {})
    if "year" in metadata and "quarter" in metadata:
        metadata.setdefault("period", f"{metadata['year']}Q{metadata['quarter']}")
    columns = []
    for field in TABLES[table].fields:
        if field.name in renamed.columns:
            value = F.col(field.name)
        elif field.name == "seller_cid" and ("cid" in renamed.columns or "cid" in metadata):
            value = F.col("cid") if "cid" in renamed.columns else F.lit(metadata["cid"])
        else:
            value = F.lit(metadata.get(field.name)).cast("string")
        if field.name == "period":
            value = canonical_period(value)
        columns.append(value.try_cast(field.dataType).alias(field.name))
    return renamed.select(*columns)


def typing_errors(df: DataFrame, table: str) -> DataFrame:
    """One row per value that is present but does not fit the type of its column."""
    renamed = _rename(df, table)
    checked = [f for f in TABLES[table].fields if f.name in renamed.columns and f.dataType != T.StringType()]
    entries = [
        F.when(
            F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(),
            F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).cast("string").alias("value")),
        )
        for f in checked
    ]
    if not entries:
        schema = "record_type string, record_id string, column_name string, value string"
        return df.sparkSession.createDataFrame([], schema)
    record = first_available(renamed, [RECORD_ID.get(table, "cid")])
    hits = renamed.select(record.cast("string").alias("record_id"), F.explode(F.array_compact(F.array(*entries))).alias("hit"))
    return hits.select(F.lit(RECORD_TYPE.get(table, table)).alias("record_type"), "record_id", "hit.column_name", "hit.value")


def overwrite_columns(df: DataFrame, updates: dict[str, str | None]) -> DataFrame:
    """Set columns to literal text values, or to null."""
    return df.withColumns({name: F.lit(value).cast("string") for name, value in updates.items()})


def with_metadata(df: DataFrame, **metadata: str) -> DataFrame:
    """Attach filing metadata (company, year, quarter) to the frame's schema; Parquet keeps it."""
    return df.select(*[F.col(c).alias(c, metadata=metadata) for c in df.columns])


def metadata_of(df: DataFrame) -> dict[str, str]:
    """Filing metadata carried by the schema."""
    return reduce(lambda a, b: {**a, **b}, [f.metadata for f in df.schema.fields], {})


def substitute(spark: SparkSession, query: str, **values) -> DataFrame:
    """Run SQL whose ``{{NAME}}`` placeholders become bound parameters, not pasted text."""
    for name in values:
        query = query.replace("{{" + name + "}}", f":{name}")
    return spark.sql(query, args=values)
