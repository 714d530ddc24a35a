"""Landing documents: text framing, envelope, profile and metric arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.catalogue import CATALOGUE
from pulsegrid.functions import clock, text
from pulsegrid.schema import RECORD, document_schema

# Uploads follow each other with no newline. Splitting files at this sequence lets Spark cut a
# large file into many tasks. Sample strings hold no double quotes, so it never occurs in one.
_BOUNDARY = '}{"'


def split_documents(value: Column) -> Column:
    """Array of the documents in one text, with or without white space between them."""
    return F.split(value, r'(?<=\})\s*(?=\{")')


def unwrap(value: Column) -> Column:
    """``{"body": document}`` and a bare document both give the document.

    A text without the word, and without an escape that could spell it, has no such field and is not parsed for it.
    """
    maybe = value.contains("body") | value.contains("\\")
    return F.when(maybe, F.coalesce(F.get_json_object(value, "$.body"), value)).otherwise(value)


def _opened(piece: Column) -> Column:
    """Give back the start a piece lost when the file was cut at ``_BOUNDARY``."""
    return F.when(piece.startswith("{") | piece.rlike(r"^\s*\{"), piece).otherwise(F.concat(F.lit('{"'), piece))


def _closed(doc: Column) -> Column:
    """Give back the closing brace the last document of a piece lost in the same way.

    No value of a document is an object, so a whole document ends in one brace and a whole
    envelope in two.
    """
    enveloped = doc.contains('"body"') & doc.rlike(r'^\s*\{"body"\s*:')
    ends = lambda plainly, pattern: doc.endswith(plainly) | doc.rlike(pattern)  # noqa: E731 # a pattern looks at all of it
    whole = F.when(enveloped, ends("}}", r"\}\s*\}\s*$")).otherwise(ends("}", r"\}\s*$"))
    return F.when(whole, doc).otherwise(F.concat(doc, F.lit("}")))


def frame(rows: DataFrame, column: str = "value") -> DataFrame:
    """Text with any number of documents per row to one bare document per row."""
    docs = F.transform(split_documents(_opened(F.col(column))), _closed)
    return (
        rows.filter(F.trim(column) != "")
        .select(F.explode(docs).alias("doc"))
        .select(text.strip_type_prefixes(unwrap(F.col("doc"))).alias(RECORD))
    )


def read_documents(spark: SparkSession, path: str, streaming: bool = False, files_per_batch: int | None = None,
                   bytes_per_batch: str | None = None, archive: str | None = None) -> DataFrame:
    """Upload files as one document per row, in batch or as a file stream.

    A stream may be held to so many files or bytes a batch (``"512m"``), and may move files that it has taken in, and
    whose batch is done, into an archive folder, so that a trigger lists new files only.
    """
    reader = spark.readStream if streaming else spark.read
    limits = {"maxFilesPerTrigger": files_per_batch, "maxBytesPerTrigger": bytes_per_batch}
    if archive:
        limits |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    for name, value in limits.items():
        if streaming and value is not None:
            reader = reader.option(name, value)
    return frame(reader.option("lineSep", _BOUNDARY).text(path))


_CORRUPT = "_corrupt"


def _judged_document() -> Column:
    schema = T.StructType([*document_schema().fields, T.StructField(_CORRUPT, T.StringType())])
    return F.from_json(RECORD, schema, {"columnNameOfCorruptRecord": _CORRUPT})


def _reason(doc: str) -> Column:
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    return (
        F.when(blank(F.col(RECORD)), "empty")
        .when(F.col(doc).isNull() | F.col(f"{doc}.{_CORRUPT}").isNotNull(), "malformed")
        .when(blank(F.col(f"{doc}.identifier")), "no identifier")
    )


def judged(records: DataFrame) -> DataFrame:
    """Adds REASON, why a document can't be taken in; NULL where it can.

    'empty' holds no text, 'malformed' is no document or has a field of another type, 'no identifier' names no user.
    The reason is exploded, since a filter on it would parse each document several times more.
    """
    return records.withColumn("doc", _judged_document()).select(
        *records.columns, F.explode(F.array(_reason("doc"))).alias("REASON"))


def accepted(judged_records: DataFrame) -> DataFrame:
    return judged_records.filter(F.col("REASON").isNull()).drop("REASON")


def rejected(judged_records: DataFrame) -> DataFrame:
    """The quarantine: documents as they came and the reason. With ``accepted`` these are all documents."""
    return judged_records.filter(F.col("REASON").isNotNull()).select(RECORD, "REASON")


def parse_documents(records: DataFrame, metrics=CATALOGUE, strict: bool = False) -> DataFrame:
    """One parse per document: profile columns and a struct of metric arrays.

    ``strict`` leaves out what ``judged`` gives a reason for, in the same parse: an array of no or one document is
    exploded, since a filter would parse each document once more.
    """
    if strict:
        read = records.select(RECORD, _judged_document().alias("doc"))
        parsed = read.select(F.explode(F.when(_reason("doc").isNull(), F.array("doc"))).alias("doc"))
    else:
        parsed = records.select(
            F.from_json(RECORD, document_schema(tuple(m.key for m in metrics))).alias("doc")
        )
    return parsed.select(
        F.col("doc.identifier").alias("ID"),
        F.col("doc.age").try_cast("int").alias("AGE"),
        F.col("doc.gender").alias("GENDER"),
        F.col("doc.bloodstype").alias("BLOODTYPE"),
        clock.as_wall_clock(F.col("doc.loaddate")).alias("LOADTIME"),
        F.struct(*[F.col(f"doc.{m.key}") for m in metrics]).alias("ARRAYS"),
    )
