"""Raw JSON documents to the parsed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapstar.functions.columns import Day, parse_json
from snapstar.schemas import DOCUMENT_DDL
from snapstar.sinks.write import DAILY_MODES, balanced
from snapstar.sources.raw import read_raw_files

LINEAGE = ["source_file", "snapshot_date", "raw_json"]


def some_fields(*paths: str) -> str:
    """The document's DDL with just these fields, one level of nesting at most: ``id``, ``credits.cast``."""
    document, found = StructType.fromDDL(DOCUMENT_DDL), StructType()
    for name in dict.fromkeys(p.partition(".")[0] for p in paths):
        inner = [p.partition(".")[2] for p in paths if p.startswith(f"{name}.")]
        kind = document[name].dataType
        found = found.add(name, StructType([kind[i] for i in inner]) if inner else kind)
    return found.toDDL()


def parse_documents(raw: DataFrame, ddl: str = DOCUMENT_DDL) -> DataFrame:
    """The document's fields beside the lineage columns; unreadable rows are all null.

    Unpacking the struct as a one-element array keeps later filters above the
    parse. As a plain projection Catalyst would copy ``from_json`` into each
    filter and read every document twice.
    """
    return raw.select(*LINEAGE, F.inline(F.array(parse_json(F.col("raw_json"), ddl))))


def readable(parsed: DataFrame) -> DataFrame:
    """Documents that have an id."""
    return parsed.filter(F.col("id").isNotNull())


def rejected(parsed: DataFrame) -> DataFrame:
    """The complement of ``readable``, for a look at what was dropped."""
    return parsed.filter(F.col("id").isNull()).select(*LINEAGE)


def parse_landed(landed: DataFrame, parsed_path: str, mode: str = "append", day: Day = None) -> None:
    """Parse a day's documents of the landed table, whose files have a good size: no shuffle at all."""
    DAILY_MODES[mode](readable(parse_documents(landed)), parsed_path, day)


def parse_raw(spark: SparkSession, raw_root: str, parsed_path: str, day: Day, mode: str = "append") -> None:
    """Parse one day's landed files, of one document each, into few large files."""
    documents = readable(parse_documents(read_raw_files(spark, raw_root, day)))
    DAILY_MODES[mode](balanced(documents), parsed_path, day)
