"""Scalar expressions on URIs, labels and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_NAMESPACE = "http://default.eu/"  # what this library uses where no ontology gives a namespace
#: XSD and RDFS datatypes and the types that stand for them.
DATATYPES = {
    "xsd:string": "string", "rdfs:Literal": "string", "xsd:integer": "long", "xsd:unsignedInt": "long", "xsd:float": "double",
    "xsd:double": "double", "xsd:boolean": "boolean", "xsd:dateTime": "timestamp", "xsd:date": "timestamp",
}


def local_name(uri: Column) -> Column:
    """What follows the last #, or else the last /."""
    return F.when(F.contains(uri, F.lit("#")), F.substring_index(uri, "#", -1)).otherwise(F.substring_index(uri, "/", -1))


def namespace(uri: Column) -> Column:
    """The URI without its local name; empty if that is empty."""
    name = local_name(uri)
    return F.when(F.length(name) == 0, F.lit("")).otherwise(F.left(uri, F.length(uri) - F.length(name)))


def class_and_property(short: Column) -> tuple[Column, Column]:
    """Class and property of `Class.property`; without a dot there is a class alone."""
    parts = F.split(short, r"\.")
    return F.element_at(parts, 1), F.when(F.size(parts) > 1, F.element_at(parts, -1))


def known_label(label: Column) -> Column:
    return F.coalesce(label, F.lit("unknown"))


def timestamp(text: Column) -> Column:
    """A server timestamp; null where the text isn't one."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS"))


def broken_timestamps(rows, column: str):
    """Rows whose text isn't a server timestamp."""
    return rows.filter(F.col(column).isNotNull() & timestamp(F.col(column)).isNull())


def datatype(uri: Column) -> Column:
    """The type that stands for an XSD range; string by default."""
    return F.coalesce(*[F.when(uri == k, F.lit(v)) for k, v in DATATYPES.items()], F.lit("string"))
