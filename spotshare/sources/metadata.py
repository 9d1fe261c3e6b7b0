"""Dataset metadata from a schema."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import types as T

# Dataset type of each column type; other types are Text.
TYPES: dict[str, dict[str, object]] = {
    "byte": {"type": "Numeric", "precision": 18, "scale": 0},
    "short": {"type": "Numeric", "precision": 18, "scale": 0},
    "integer": {"type": "Numeric", "precision": 18, "scale": 0},
    "long": {"type": "Numeric", "precision": 18, "scale": 0},
    "float": {"type": "Numeric", "precision": 18, "scale": 2},
    "double": {"type": "Numeric", "precision": 18, "scale": 2},
    "decimal": {"type": "Numeric", "precision": 18, "scale": 2},
    "timestamp": {"type": "Date", "format": "yyyy-MM-dd HH:mm:ss"},
    "date": {"type": "Date", "format": "yyyy-MM-dd"},
    "string": {"type": "Text"},
    "boolean": {"type": "Text"},
}
MAX_SCALE = 6


def field_metadata(field: T.StructField, dataset: str, types: Mapping[str, Mapping[str, object]] | None = None) -> dict:
    """Description of one column; entries of ``types`` replace the built-in ones."""
    kind = {**TYPES, **(types or {})}.get(field.dataType.typeName(), {"type": "Text"})
    described = {
        "description": "",
        "fullyQualifiedName": f"{dataset}.{field.name}",
        "label": field.name,
        "name": field.name,
        "isSystemField": False,
        "isUniqueId": False,
        "isMultiValue": False,
        "type": kind["type"],
    }
    if "precision" in kind:
        scale = int(kind.get("scale", 0))
        if scale > MAX_SCALE:
            raise ValueError(f"scale of {field.name} is {scale}, at most {MAX_SCALE} is supported")
        described |= {"precision": int(kind["precision"]), "defaultValue": kind.get("defaultValue", 0), "scale": scale}
    for name in ("format", "canTruncateValue"):
        if name in kind:
            described[name] = kind[name]
    return described


def dataset_metadata(schema: T.StructType, dataset: str, types: Mapping[str, Mapping[str, object]] | None = None) -> str:
    return json.dumps({
        "fileFormat": {"charsetName": "UTF-8", "fieldsDelimitedBy": ",", "numberOfLinesToIgnore": 0},
        "objects": [{
            "connector": "CSV",
            "description": "",
            "fullyQualifiedName": dataset,
            "label": dataset,
            "name": dataset,
            "fields": [field_metadata(field, dataset, types) for field in schema.fields],
        }],
    })
