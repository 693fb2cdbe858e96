"""Event ids: validity, canonical form, repeatable ids and draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: id forms accepted, any letter case: plain, braced, urn-prefixed, 32 digits.
_DASHED = r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
UUID_FORMS = rf"(?i)^({_DASHED}|\{{{_DASHED}\}}|urn:uuid:{_DASHED}|[0-9a-f]{{32}})$"


def is_uuid(text: Column) -> Column:
    return F.coalesce(text.rlike(UUID_FORMS), F.lit(False))


def is_urn(text: Column) -> Column:
    """The urn form is a valid id, but no id column takes it."""
    return F.lower(text).startswith("urn:")


def canonical_uuid(text: Column) -> Column:
    """Lower-case hex digits only, so that every form of one id compares equal."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "^urn:uuid:", ""), "[^0-9a-f]", "")


def derived_id(*parts: Column) -> Column:
    """Repeatable 36-character id from its parts; a retry gives the same id."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.regexp_replace(digest, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def draw(key: Column) -> Column:
    """Repeatable draw in [0, 1) from a key."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("double") / F.lit(
        4294967296.0
    )
