"""Decode and validate scoring requests given as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.schemas import NUMERIC_COLUMNS, REQUEST

INVALID_JSON, MISSING_FIELDS, INVALID_VALUES = "invalid_json", "missing_fields", "invalid_values"


def _number(text: Column, target) -> Column:
    """A number of the target type; whole-number columns also take '3.0'."""
    return F.coalesce(text.try_cast(target), text.try_cast("double").try_cast(target))


def decode(requests: DataFrame, body: str = "body") -> DataFrame:
    """Parse each body once; add the request columns, ``missing_fields`` and ``reason``.

    A field counts as present even when its value is null. Unknown fields are ignored.
    A body that is valid JSON but no object lacks every field. ``reason`` is null for
    requests that can be scored.
    """
    text = F.col(body)
    required = F.array(*[F.lit(c) for c in NUMERIC_COLUMNS])
    parsed = requests.withColumn("_fields", F.from_json(text, "map<string,string>"))
    fields = F.col("_fields")
    # Only bodies that are no object are looked at again.
    value = F.try_parse_json(text)
    other_json = fields.isNull() & value.isNotNull() & ~F.is_variant_null(value)
    absent = F.when(fields.isNotNull(), F.filter(required, lambda f: ~F.map_contains_key(fields, f))).when(
        other_json, required
    )
    values = {f.name: _number(fields[f.name], f.dataType) for f in REQUEST}
    unreadable = F.lit(False)
    for f in REQUEST:
        unreadable = unreadable | (fields[f.name].isNotNull() & F.col(f.name).isNull())
    return (
        parsed.withColumns({**values, "missing_fields": absent})
        .withColumn(
            "reason",
            F.when(F.col("missing_fields").isNull(), INVALID_JSON)
            .when(F.size("missing_fields") > 0, MISSING_FIELDS)
            .when(unreadable, INVALID_VALUES),
        )
        .drop("_fields")
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where("reason IS NULL").drop("reason", "missing_fields")


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.where("reason IS NOT NULL").drop(*NUMERIC_COLUMNS)
