"""JSON snapshot documents."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapgrid.schema import LOCATION_RECORD, merged
from snapgrid.session import use_utc
from snapgrid.sources.tables import ORIGIN, in_file_order


#: What the scan knows of a document's file, and the names of ``ORIGIN`` for it.
SOURCE = [("file_path", ORIGIN[0]), ("file_block_start", ORIGIN[1])]
#: The files of a folder that are snapshot documents.
PATTERN = "*.json"
#: What ends a JSON text in a sequence of them (RFC 7464). No JSON text holds it, so a file read by it is one document.
#: A document is in memory then: the ``multiLine`` reader goes back to the file for every number that is read as text.
SEPARATOR = "\x1e"


def records_of(document: Column, envelope: str = "locations") -> Column:
    """The records of a parsed document: those in its envelope, those of a list, or the document itself."""
    return F.coalesce(
        F.try_variant_get(document, f"$['{envelope}']", "array<variant>"),
        F.try_variant_get(document, "$", "array<variant>"),
        F.array(document),
    )


def plain_type(kind: T.DataType) -> T.DataType:
    """The column type for what values of a field have in common: text where that is nothing, or nothing nested.

    Fields that are always null, objects without fields and values of several kinds are text.
    """
    if isinstance(kind, T.StructType) and kind.fields:
        return T.StructType([T.StructField(f.name, plain_type(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(plain_type(kind.elementType))
    if isinstance(kind, T.DecimalType):
        return kind if kind.scale == 0 else T.DoubleType()
    if isinstance(kind, (T.BooleanType, T.LongType, T.DoubleType)):
        return kind
    return T.StringType()


def infer_record(
    spark: SparkSession, folder: str, envelope: str = "locations", pattern: str = PATTERN
) -> T.StructType:
    """The record schema of a folder of documents: every field that any record has, whatever its document's shape.

    One pass: documents are parsed once, and the schemas of their records merged on the way up, so one line of
    text reaches the driver. A document that is no JSON fails the job.
    """
    documents = spark.read.option("wholetext", True).option("pathGlobFilter", pattern).text(folder)
    parsed = F.try_parse_json("value")
    message = F.concat(F.lit("no JSON document: "), F.col("_metadata.file_name"))
    sound = F.when(parsed.isNull(), F.raise_error(message).cast("variant")).otherwise(parsed)
    records = documents.select(sound.alias("_d")).select(F.explode(records_of(F.col("_d"), envelope)).alias("_r"))
    objects = records.filter(F.try_variant_get("_r", "$", "map<string,variant>").isNotNull())
    found = objects.agg(F.schema_of_variant_agg("_r")).first()[0]
    if not found.startswith("OBJECT<"):
        return T.StructType([])  # no record at all
    # Names that are no plain words stand in backticks.
    ddl = re.sub(r"`(?:[^`]|``)*`|\bOBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], found)
    return plain_type(T.StructType.fromDDL(f"record {ddl}")["record"].dataType)


def as_text(kind: T.DataType) -> T.DataType:
    """The same nesting with text leaves."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(as_text(kind.elementType))
    return T.StringType()


def read_snapshots(
    spark: SparkSession,
    folder: str,
    record: T.StructType | None = None,
    envelope: str = "locations",
    pattern: str = PATTERN,
    place: str | None = None,
) -> DataFrame:
    """All records of a folder of JSON documents, one row each, with the source file name.

    A document is an object that holds the records in ``envelope``, a list of records, or one record.
    A document in which none of these is found (broken text, an envelope that is no list) fails the
    job. Values are read as text and then cast, so a number in quotes is a number and a value that does
    not fit is null; a field declared as text keeps nested JSON as it is. Files are read in parallel; the
    only unit that has to fit a task is one document.

    Every field of every record is kept, whether its document is an envelope, a list or one record: one more pass
    finds the fields, those of the default record have its types. With a ``record`` schema that pass is saved, and only the fields it names are read.
    """
    record = record or merged(LOCATION_RECORD, infer_record(spark, folder, envelope, pattern))
    fields = [f for f in record.fields if f.name != envelope]
    wanted = T.StructType(fields)
    loose = as_text(wanted)
    rows = T.ArrayType(loose)
    raw = (
        use_utc(spark)
        .read.schema(T.StructType([T.StructField(envelope, rows), *loose.fields]))
        .option("lineSep", SEPARATOR)
        .option("mode", "PERMISSIVE")
        .option("pathGlobFilter", pattern)
        .json(folder)
    )
    own = F.struct(*[F.col(f"`{f.name}`") for f in fields])
    known = reduce(or_, [F.col(f"`{f.name}`").isNotNull() for f in fields])
    message = F.concat(F.lit("no records found in "), F.col("source_file"))
    records = (
        F.when(F.col(envelope).isNotNull(), F.col(envelope))
        .when(known, F.array(own))
        .otherwise(F.raise_error(message).cast(rows))
    )
    named = raw.select("*", F.col("_metadata.file_name").alias("source_file"), *[F.col(f"_metadata.{m}").alias(c) for m, c in SOURCE])
    found = named.select("source_file", *[c for _, c in SOURCE], F.explode(records).alias("_r"))
    typed = found.select("source_file", *[c for _, c in SOURCE], F.col("_r").try_cast(wanted).alias("_r"))
    if place is None:
        return typed.select("source_file", "_r.*")
    origin = typed.withColumn(ORIGIN[2], F.monotonically_increasing_id())
    return in_file_order(origin, place).select("source_file", place, "_r.*")
