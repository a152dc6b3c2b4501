"""Record sources: CSV, JSON (four shapes), nested export documents, Parquet, JDBC.

Every reader uses an explicit schema (no inference pass over the data) and
lands values as text first; ``coerce_types`` then applies typed, null-on-error
casts, so one bad cell never fails a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upkeep import schema as S
from upkeep.operators.quality import coerce_types, ensure_required_columns
from upkeep.session import materialize

FORMATS = ("csv", "json", "document", "parquet", "jdbc")


def read_records(spark: SparkSession, fmt: str, path: str | None = None, **options) -> DataFrame:
    """Dispatch on the source format; unknown formats raise ValueError."""
    if fmt == "csv":
        return read_csv(spark, path, **options)
    if fmt == "json":
        return read_json(spark, path, **options)
    if fmt == "document":
        return read_export_document(spark, path, **options)
    if fmt == "parquet":
        return coerce_types(spark.read.parquet(path))
    if fmt == "jdbc":
        from upkeep.sources.extract import extract_records, read_operational_jdbc
        return extract_records(read_operational_jdbc(spark, **options))
    raise ValueError(f"Unknown data source: {fmt}")


def read_csv(spark: SparkSession, path: str, timestamp_format: str | None = None, **options) -> DataFrame:
    """CSV with a header, landed as text by column name, typed afterwards.

    The names come from the header (no type inference).  Files whose headers
    disagree fail.  Columns may stand in any order; others than the record's are left out,
    optional ones that are absent get their defaults, and an absent required
    one raises ValueError.
    """
    options = {"header": "true", "mode": "PERMISSIVE", **options}
    names = spark.read.options(**options).csv(path).columns
    landing = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.schema(landing).options(**options).option("enforceSchema", "false").csv(path)
    raw = ensure_required_columns(raw.select(*[c for c in S.RECORD_COLUMNS if c in names]))
    raw = raw.select(*S.RECORD_COLUMNS)
    if timestamp_format:
        raw = raw.withColumn("maintenance_date",
                             F.date_format(F.try_to_timestamp("maintenance_date", F.lit(timestamp_format)),
                                           "yyyy-MM-dd HH:mm:ss"))
    return coerce_types(raw)


def read_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per JSON document with ``doc`` as VARIANT (null if it does not parse): a file each, or with ``multi_line=False`` a line each."""
    text = spark.read.text(path, wholetext=multi_line)
    return text.where(F.length(F.trim("value")) > 0).select(F.try_parse_json("value").alias("doc"))


def document_records(docs: DataFrame) -> DataFrame:
    """``record`` (VARIANT) of every record of ``docs``, whichever of the four shapes its document has.

    A list, an object with the list ``data``, an export document with the list
    ``maintenance_records``, or else a single record.  The shape is looked up in the parsed document, so one scan does.
    """
    def listed(path: str):
        return F.try_variant_get("doc", path, "array<variant>")

    items = F.coalesce(listed("$"), listed("$.data"), listed("$.maintenance_records"), F.array("doc"))
    return docs.select(F.explode(items).alias("record"))


def _record_columns(records: DataFrame, names) -> DataFrame:
    """The named fields of ``record`` as text; a field that is absent or null is null."""
    return records.select(*[F.try_variant_get("record", f"$.{c}", "string").alias(c) for c in names])


def read_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """S3: list of records, {"data": [...]}, single object, or export document.

    One scan; each document contributes whichever shape it has.
    ``multi_line=False`` reads a document per line (splittable, for large
    feeds).  A document that does not parse gives one record of nulls, which cleaning removes and counts.
    """
    return coerce_types(_record_columns(document_records(read_documents(spark, path, multi_line)), S.RECORD_COLUMNS))


def read_export_document(spark: SparkSession, path: str, require_records: bool = True, multi_line: bool = True) -> DataFrame:
    """Maintenance records of nested export documents.

    Descriptive per-record fields are dropped, the rest coerced.  The
    document's own record count in its metadata is not trusted.
    """
    docs = read_documents(spark, path, multi_line)
    records = docs.select(F.explode(F.try_variant_get("doc", "$.maintenance_records", "array<variant>")).alias("record"))
    recs = _record_columns(records, ["record_id", *S.RECORD_COLUMNS])
    if require_records and recs.isEmpty():
        raise ValueError("No maintenance records found in the JSON data")
    return coerce_types(recs).withColumn("record_id", F.col("record_id").try_cast("long"))


def read_document_dimensions(spark: SparkSession, path: str, multi_line: bool = True) -> dict:
    """The documents' dimension arrays as side tables.

    The documents are scanned and parsed once; the arrays, typed, are stored and each side table reads its own column.
    """
    docs = read_documents(spark, path, multi_line)
    names = ["buildings", "technicians", "asset_categories", "metadata"]
    typed = materialize(docs.select(*[F.try_variant_get("doc", f"$.{n}", S.EXPORT_DOCUMENT_SCHEMA[n].dataType.simpleString()).alias(n) for n in names]))
    return {n: typed.select(F.inline(n)) for n in names[:3]} | {"metadata": typed.select("metadata.*")}


def normalize(df: DataFrame, mapping: dict) -> DataFrame:
    """Map a vendor export onto the canonical record.

    ``mapping`` gives, per canonical column, a SQL expression or Column over
    the vendor's columns; canonical columns left out become null.
    """
    exprs = []
    for name in S.RECORD_COLUMNS:
        e = mapping.get(name)
        if e is None:
            exprs.append(F.lit(None).cast(S.RECORD_SCHEMA[name].dataType).alias(name))
        else:
            exprs.append((F.expr(e) if isinstance(e, str) else e).alias(name))
    extra = [(F.expr(e) if isinstance(e, str) else e).alias(k) for k, e in mapping.items()
             if k not in S.RECORD_COLUMNS]
    return coerce_types(df.select(*exprs, *extra))


def write_records(df: DataFrame, path: str, buckets: int = 64) -> None:
    """K1: store records partitioned by a hash bucket of the building."""
    (df.withColumn("building_bucket", F.pmod(F.xxhash64("building_id"), F.lit(buckets)))
       .write.mode("overwrite").partitionBy("building_bucket").parquet(path))
