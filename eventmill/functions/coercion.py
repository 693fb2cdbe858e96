"""Reading JSON fields from VARIANT columns, leniently or strictly.

A field is first read as two plain columns, its text and its kind (:func:`add_scalars`); the
coercions then work on those, so that a document is parsed and searched once per field.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -2147483648, 2147483647


def parse_lenient(value: Column) -> Column:
    """Parse JSON text to VARIANT; text that is not JSON gives NULL."""
    return F.try_parse_json(value.cast("string"))


def field(doc: Column, path: str) -> Column:
    """The sub-document at ``path`` as VARIANT; NULL if the path is missing."""
    return F.try_variant_get(doc, path, "variant")


def json_kind(node: Column) -> Column:
    """Type of a VARIANT: STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, OBJECT<..>, ARRAY<..>,
    VOID for JSON null, NULL for a missing node."""
    return F.schema_of_variant(node)


def is_nested(kind: Column) -> Column:
    return kind.startswith("OBJECT<") | kind.startswith("ARRAY<")


def once(df: DataFrame, *computed: Column) -> DataFrame:
    """Add columns that are computed once per row, whatever is filtered on them later.

    A filter on a plain computed column is moved below the projection and computes it a
    second time, which for parsed JSON doubles the work. The columns go through a one-row
    ``inline``, which filters are not moved across.
    """
    packed = df.select("*", F.struct(*computed).alias("_once"))
    return packed.select(*df.columns, F.inline(F.array("_once")))


def add_scalars(df: DataFrame, doc: str, paths: Mapping[str, str]) -> DataFrame:
    """Add ``<name>_text`` and ``<name>_kind`` for each path in the VARIANT column ``doc``."""
    added = []
    for name, path in paths.items():
        added.append(F.try_variant_get(F.col(doc), path, "string").alias(f"{name}_text"))
        added.append(json_kind(field(F.col(doc), path)).alias(f"{name}_kind"))
    return df.select("*", *added)


def _parts(name: str) -> tuple[Column, Column]:
    return F.col(f"{name}_text"), F.col(f"{name}_kind")


def lenient_text(name: str) -> Column:
    """Field as text: missing or nested gives '', JSON null gives 'null'."""
    text, kind = _parts(name)
    return (
        F.when(kind.isNull() | is_nested(kind), "")
        .when(kind == "VOID", "null")
        .otherwise(text)
    )


def _clamped_int(number: Column) -> Column:
    return (
        F.when(number >= INT_MAX, F.lit(INT_MAX))
        .when(number <= INT_MIN, F.lit(INT_MIN))
        .otherwise(number.try_cast("int"))
    )


def _low_32_bits(number: Column) -> Column:
    low = F.pmod(number, F.lit(4294967296).cast("decimal(38,0)")).cast("bigint")
    return F.when(low > INT_MAX, low - F.lit(4294967296).cast("bigint")).otherwise(low).cast("int")


def lenient_int(name: str) -> Column:
    """Field as INT: missing, null or not numeric gives 0; fractions are cut off.

    JSON integers too large for INT keep their low 32 bits (those of more than 38 digits saturate),
    digit strings too large give 0, and larger fractions saturate.
    """
    text, kind = _parts(name)
    whole = text.rlike(r"^\s*[+-]?[0-9]+\s*$")
    return F.coalesce(
        text.try_cast("int"),
        F.when(kind == "BOOLEAN", (text == "true").cast("int")),
        F.when((kind != "STRING") & whole, _low_32_bits(text.try_cast("decimal(38,0)"))),
        F.when(~((kind == "STRING") & whole), _clamped_int(text.try_cast("double"))),
        F.lit(0),
    )


def lenient_double(name: str) -> Column:
    """Field as DOUBLE: missing, null or not numeric gives 0.0."""
    text, kind = _parts(name)
    return F.coalesce(
        text.try_cast("double"),
        F.when(kind == "BOOLEAN", (text == "true").cast("int").cast("double")),
        F.lit(0.0),
    )


# --- strict reading ---------------------------------------------------------------------------

#: Options under which Spark's reader takes standard JSON only.
STANDARD_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
#: Fields of a JSON object in the order of the text, repeated names included.
FIELDS = "array<struct<name:string,kind:string,text:string>>"


def folded(name: Column) -> Column:
    """A field name without its letter case."""
    return F.upper(F.lower(name))


def _in_array(text: Column) -> Column:
    """The text as the only element of a JSON array, so that what follows a value is an error."""
    return F.concat(F.lit("["), text, F.lit("]"))


def read_objects(text: Column) -> Column:
    """The text as an array of JSON objects; what :func:`one_value` and :func:`object_fields` look at.

    To be computed once per row (see :func:`once`), since both need it.
    """
    return F.from_json(_in_array(text), "array<map<string,variant>>", STANDARD_JSON)


def one_value(text: Column, docs: Column) -> Column:
    """True where the text is one JSON object or null with nothing after it."""
    start = F.ltrim(text, F.lit(" \t\r\n"))
    # The array ends early only at a bracket of the text; as a member such a text is no JSON.
    member = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.coalesce(
        (F.size(docs) == 1)
        & (start.startswith("{") | start.startswith("null"))
        & (~text.contains("]") | member.isNotNull()),
        F.lit(False),
    )


def object_fields(doc: Column) -> Column:
    """Folded name, kind and text of every field of a JSON object (a map), in order."""
    return F.transform(
        F.map_entries(doc),
        lambda e: F.struct(
            folded(e["key"]).alias("name"),
            json_kind(e["value"]).alias("kind"),
            F.try_variant_get(e["value"], "$", "string").alias("text"),
        ),
    )


def last_field(doc: Column, name: str) -> Column:
    """The last field of this name of a JSON object (a map)."""
    found = F.filter(F.map_entries(doc), lambda e: folded(e["key"]) == name.upper())
    return F.try_element_at(found, F.lit(-1))["value"]


def ordered_fields(node: Column, text: Column, name: str) -> Column:
    """:func:`object_fields` of the VARIANT ``node``, the last field ``name`` of the object in ``text``.

    A VARIANT has its fields sorted. Only where two of them agree but for the letter case does their
    order in the text count, and the text is read once more.
    """
    fields = F.try_variant_get(node, "$", "map<string,variant>")
    names = F.transform(F.map_keys(fields), folded)
    raw = F.from_json(_in_array(text), "array<map<string,string>>", STANDARD_JSON)
    in_order = F.get(read_objects(last_field(F.get(raw, F.lit(0)), name)), F.lit(0))
    return object_fields(
        F.when(F.size(F.array_distinct(names)) < F.size(names), in_order).otherwise(fields)
    )


def strict_ok(fields: Column, name: str, target: str) -> Column:
    """True where every field of this name can be read strictly as ``target``.

    Absent fields and JSON null leave the zero value and are accepted.
    """

    def accepted(kind: Column) -> Column:
        return {
            "string": kind == "STRING",
            "int": kind == "BIGINT",
            "double": kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL"),
        }[target]

    fine = F.forall(
        fields,
        lambda f: (f["name"] != name.upper()) | (f["kind"] == "VOID") | accepted(f["kind"]),
    )
    return F.coalesce(fine, F.lit(True))


def strict_text(fields: Column, name: str) -> Column:
    """Text of the last field of this name that is not null; NULL if there is none."""
    set_ = F.filter(fields, lambda f: (f["name"] == name.upper()) & (f["kind"] != "VOID"))
    return F.try_element_at(set_, F.lit(-1))["text"]


def strict_value(fields: Column, name: str, target: str) -> Column:
    """Typed value of a field that passed :func:`strict_ok`; absent gives the zero value."""
    spark_type, zero = {
        "string": ("string", F.lit("")),
        "int": ("bigint", F.lit(0).cast("bigint")),
        "double": ("double", F.lit(0.0)),
    }[target]
    return F.coalesce(strict_text(fields, name).try_cast(spark_type), zero)
