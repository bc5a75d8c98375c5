"""Fields whose names the data brings along (P14): every key of a nested object in any row becomes a column.

The object is read as VARIANT, so nothing about it has to be known before. One pass lists the keys of all rows with the
type that holds all their values; the projection that follows is a plain select. The keys go through the driver: they
become columns, so there are as many as a table may have.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns left out after the source fields were taken, as they are held elsewhere or not wanted.
DROPPED = ["pdf_url", "license", "license_id", "source_issn_l", "source_issn", "source_host_organization",
           "source_host_organization_name", "source_is_oa", "source_id", "source_display_name", "source_is_in_doaj",
           "source_is_indexed_in_scopus", "source_is_core", "source_host_organization_lineage",
           "source_host_organization_lineage_names", "source_type"]

_NUMBER = re.compile(r"BIGINT|DOUBLE|FLOAT|INT|SMALLINT|TINYINT|DECIMAL\(.*\)")


def as_variant(column: Column | str, path: str = "$") -> Column:
    """The object at ``path`` of a JSON string; null for null or broken JSON, or without such an object."""
    return F.try_variant_get(F.try_parse_json(column), path, "variant")


def found_keys(df: DataFrame, variant: str) -> DataFrame:
    """(key, type) of all keys in any row; type number, boolean or string (anything else, nested ones as JSON)."""
    objects = df.select(F.col(variant).alias("v")).where(F.schema_of_variant("v").startswith("OBJECT"))
    keys = df.sparkSession.sql("select key, schema_of_variant_agg(value) as seen from {objects}, lateral variant_explode(v) group by key", objects=objects)
    kind = F.when(F.col("seen").rlike(f"^({_NUMBER.pattern})$"), "number").when(F.col("seen") == "BOOLEAN", "boolean").otherwise("string")
    return keys.select("key", kind.alias("type"))


def _at(key: str) -> str:
    return '$["' + key + '"]' if "'" in key else f"$['{key}']"


def extract_fields(df: DataFrame, column: str, path: str = "$.source", prefix: str = "source_", drop: Sequence[str] = DROPPED) -> DataFrame:
    """The fields of the object at ``path`` of the JSON string ``column`` as ``{prefix}{key}`` columns, in order of
    their names; ``column`` and the columns of ``drop`` go.

    Numbers and booleans (as 1 and 0) become doubles, others strings; a row without the key has null. Keys with both
    kinds of quotes cannot be addressed and raise, as do fields that would take the name of a column that stays.
    """
    held = "v"
    while held in df.columns:
        held += "_"
    read = df.withColumn(held, as_variant(column, path))
    keys = sorted((r["key"], r["type"]) for r in found_keys(read, held).collect())
    taken, fields = [c for c in df.columns if c != column and c not in drop], []
    for key, kind in keys:
        name = f"{prefix}{key}"
        if name in drop:
            continue
        if name in taken or ("'" in key and '"' in key):
            raise ValueError(f"the field {key!r} cannot become the column {name!r}")
        value = F.try_variant_get(held, _at(key), "boolean" if kind == "boolean" else "double" if kind == "number" else "string")
        fields.append((value.cast("double") if kind == "boolean" else value).alias(name))
    return read.select(*[F.col(f"`{c}`") for c in taken], *fields)
