"""Fields of documents that the declared schema doesn't have, or has with another type."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    LongType,
    NullType,
    StringType,
    StructType,
    VariantType,
)

from snapstar.schemas import DOCUMENT_DDL

REPORT_DDL = "path string, kind string, declared string, found string, documents bigint"
#: The step from an array to its elements.
EACH = "[*]"
#: What ``schema_of_variant`` may say of a value that a field of a declared type takes.
FITS = {"long": r"^(BIGINT|DECIMAL\(\d+,0\)|VOID)$", "double": r"^(BIGINT|DECIMAL\(.*|DOUBLE|FLOAT|VOID)$", "boolean": "^(BOOLEAN|VOID)$"}
FITS |= {"integer": FITS["long"], "float": FITS["double"], "struct": "^(OBJECT<.*|VOID)$", "array": "^(ARRAY<.*|VOID)$"}


def observed(raw: DataFrame, text: str = "raw_json") -> DataType:
    """The type of all documents together, in one pass; those that are unreadable or no object count for nothing."""
    value = F.try_parse_json(text)
    documents = F.when(F.schema_of_variant(value).startswith("OBJECT<"), value)
    merged = raw.agg(F.schema_of_variant_agg(documents)).first()[0]
    return DataType.fromDDL(merged.replace("OBJECT<", "STRUCT<")) if merged.startswith("OBJECT<") else StructType()


def differences(declared: DataType, found: DataType, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], str, DataType | None, DataType]]:
    """(path, kind, declared, found): fields that are unknown, and those whose values the declared type may not take."""
    if isinstance(declared, StructType) and isinstance(found, StructType):
        for f in found:
            known = next((d.dataType for d in declared if d.name == f.name), None)
            if known is None:
                yield (*path, f.name), "unknown", None, f.dataType
            else:
                yield from differences(known, f.dataType, (*path, f.name))
    elif isinstance(declared, ArrayType) and isinstance(found, ArrayType):
        yield from differences(declared.elementType, found.elementType, (*path, EACH))
    elif not _takes(declared, found):
        yield path, "retyped", declared, found


def _takes(declared: DataType, found: DataType) -> bool:
    if isinstance(found, NullType) or isinstance(declared, (StringType, VariantType)):
        return True  # any value can be kept as text
    if isinstance(found, DecimalType):
        return isinstance(declared, (DoubleType, FloatType)) or isinstance(declared, LongType) and found.scale == 0
    if isinstance(found, LongType):
        return not isinstance(declared, (BooleanType, StructType, ArrayType))
    return type(found) is type(declared) or isinstance(found, (FloatType, DoubleType)) and isinstance(declared, (FloatType, DoubleType))


def _holds(value: Column, path: tuple[str, ...], fits: str | None) -> Column:
    """Whether a variant has the field, in any element on the way; with ``fits``, a value of another type there."""
    if not path:
        return value.isNotNull() if fits is None else F.coalesce(~F.schema_of_variant(value).rlike(fits), F.lit(False))
    if path[0] == EACH:
        elements = F.try_variant_get(value, "$", "array<variant>")
        return F.coalesce(F.exists(elements, lambda x: _holds(x, path[1:], fits)), F.lit(False))
    if "'" in path[0]:  # no path can name it
        field = F.try_variant_get(value, "$", "map<string,variant>")[path[0]]
    else:
        field = F.try_variant_get(value, f"$['{path[0]}']", "variant")
    return _holds(field, path[1:], fits)


def drift(raw: DataFrame, ddl: str = DOCUMENT_DDL, text: str = "raw_json") -> DataFrame:
    """(path, kind, declared, found, documents): what documents have beyond the schema ``ddl``.

    ``unknown`` fields would vanish in a parse, ``retyped`` ones become null where the
    declared type can't take them; in both cases the text itself stays in the raw
    table. ``documents`` counts the documents concerned. Two passes: one finds
    the type of all documents, one counts all differences at once.
    """
    spark = raw.sparkSession
    found = list(differences(StructType.fromDDL(ddl), observed(raw, text)))
    if not found:
        return spark.createDataFrame([], REPORT_DDL)
    value = F.try_parse_json(text)
    fits = [None if kind == "unknown" else FITS.get(declared.typeName(), "^$") for _, kind, declared, _ in found]
    counts = raw.select(value.alias("v")).agg(*[F.count_if(_holds(F.col("v"), f[0], fit)).alias(f"n{i}") for i, (f, fit) in enumerate(zip(found, fits, strict=True))])
    numbers = counts.first()
    rows = [
        (".".join(path).replace(f".{EACH}", EACH), kind, declared and declared.simpleString(), kept.simpleString(), numbers[i])
        for i, (path, kind, declared, kept) in enumerate(found)
    ]
    return spark.createDataFrame([r for r in rows if r[4]], REPORT_DDL)


def with_rest(raw: DataFrame, parsed: DataFrame, text: str = "raw_json") -> DataFrame:
    """Parsed documents, which carry their text, with it as a variant column ``document``: fields no schema has stay readable."""
    return parsed.withColumn("document", F.try_parse_json(text))
