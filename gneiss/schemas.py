"""Schemas of every table, and of the one nested row that a parsed document becomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, LongType, StringType, StructField, StructType

# Column order of the delivered tables.
TABLES: dict[str, tuple[str, ...]] = {
    "publication": ("pub_id", "country", "pub_number", "kind_code", "publication_date", "pub_language", "source_id"),
    "application": ("appln_id", "appln_country", "appln_number", "appln_kind_code", "appln_filing_date", "gazette_date", "gazette_issue", "source_id"),
    "ipc": ("ipc_raw_code", "ipc_long_code", "ipc_short_code", "source_id"),
    "cpc": ("cpc_raw_code", "cpc_long_code", "cpc_short_code", "source_id"),
    "applicant": ("org_key", "applicant_name", "applicant_epo_id", "applicant_reference", "applicant_address", "applicant_city", "applicant_country", "source_id"),
    "inventor": ("person_key", "inventor_name", "inventor_address", "inventor_city", "inventor_country", "source_id"),
    "attorney": ("person_key", "attorney_name", "attorney_sfx", "attorney_epo_id", "attorney_address", "attorney_city", "attorney_country", "source_id"),
    "citation": ("from_pub_id", "to_pub_id", "cite_type", "source_id"),
    "edge": ("from_label", "from_key", "from_id", "rel_type", "to_label", "to_key", "to_id", "source_id"),
    "source_file": ("source_id",),
}

# File names of the exported tables.
CSV_NAMES: dict[str, str] = {
    "publication": "nodes_publication.csv",
    "application": "nodes_application.csv",
    "ipc": "nodes_ipc_classification.csv",
    "cpc": "nodes_cpc_classification.csv",
    "applicant": "nodes_applicant.csv",
    "inventor": "nodes_inventor.csv",
    "attorney": "nodes_attorney_representative.csv",
    "citation": "nodes_citations.csv",
    "edge": "relationships.csv",
    "source_file": "nodes_source_files.csv",
}

# Vertex label and unique key of each node table that is loaded into the graph.
VERTICES: dict[str, tuple[str, str]] = {
    "publication": ("Publication", "pub_id"),
    "application": ("Application", "appln_id"),
    "ipc": ("IpcClassification", "ipc_long_code"),
    "cpc": ("CpcClassification", "cpc_long_code"),
    "applicant": ("Applicant", "org_key"),
    "inventor": ("Inventor", "person_key"),
    "attorney": ("Attorney", "person_key"),
    "source_file": ("SourceFile", "source_id"),
}

#: Order of a document in its delivery: later runs, then archives and members by name.
SEQUENCE = ("batch_id", "member_path")


def record(*fields: str, **others: DataType) -> StructType:
    """A struct of string fields and then of the others."""
    return StructType([*(StructField(f, StringType()) for f in fields), *(StructField(n, t) for n, t in others.items())])


def many(of: DataType) -> ArrayType:
    return ArrayType(of)


PARSED = record(
    "source_id",
    batch_id=LongType(),
    member_path=many(StringType()),
    error=StringType(),
    root=record("country", "doc_number", "kind", "date_publ", "lang", "id"),
    appl=StructType([StructField("has_b220", BooleanType()), StructField("has_b405", BooleanType()), *record("filing_date", "gazette_date", "gazette_issue").fields]),
    ipc=many(StringType()),
    cpc=many(StringType()),
    applicants=many(record("name", "iid", "irf", "str", "city", "ctry")),
    inventors=many(record("name", "str", "city", "ctry")),
    attorneys=many(record("name", "sfx", "iid", "str", "city", "ctry")),
    abstracts=many(record("lang", "text")),
    description=StructType([StructField("paragraphs", many(StringType())), StructField("flat", StringType())]),
    claims=many(record("lang", claims=many(record("id", "num", "text")))),
)

FULLTEXT = record("source_id", "appln_id", "pub_id", "lang", "abstract_text", "description_text", "claims_text", "claims_json")
STATUS = record("source_id", "status", "error", "context")
MANIFEST = record("filename", "status", "timestamp", "raw_size", "filtered_size", "final_size", "message")
# States of an archive.
MANIFEST_STATES = ("downloaded", "cleaned", "moved", "empty", "failed", "skipped")


def schema_of(table: str) -> StructType:
    """All-string schema of a delivered table."""
    return record(*TABLES[table])


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schema_of(table))


def stringified(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in order as strings, null as ''; missing ones are '', others are left out."""
    return df.select(*[(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")).alias(c) for c in TABLES[table]])


def ddl(table: str, columns: StructType, key: tuple[str, ...], indexes: tuple[str, ...] = ()) -> list[str]:
    """CREATE statements for a SQL sink; running them again changes nothing."""
    body = ", ".join(f"{f.name} TEXT{' NOT NULL' if f.name in key else ''}" for f in columns)
    return [f"CREATE TABLE IF NOT EXISTS {table} ({body}, PRIMARY KEY ({', '.join(key)}))", *(f"CREATE INDEX IF NOT EXISTS {table}_{c}_idx ON {table} ({c})" for c in indexes)]
