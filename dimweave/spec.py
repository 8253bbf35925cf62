"""What one load needs to know about its target table."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, fields

# Property names of a load metadata document, by LoadSpec field.
METADATA_PROPERTIES = {
    "logical_entity": "logicalEntity",
    "scd_type": "scdType",
    "sid_key": "sidKey",
    "dim_key": "dimKey",
    "primary_key": "primaryKey",
    "scd_type1_attributes": "scdType1Attributes",
    "scd_type2_attributes": "scdType2Attributes",
    "source_table": "sourceTable",
    "target_table": "targetTable",
}

TYPE1 = "type1"
TYPE2 = "type2"
FACT = "fact"


@dataclass(frozen=True)
class LoadSpec:
    """A load target: entity kind, keys and attribute lists.

    ``primary_key`` is declared here because Spark tables carry no enforced key.
    """

    logical_entity: str
    scd_type: str | None = None
    sid_key: str | None = None
    dim_key: str | None = None
    primary_key: tuple[str, ...] = ()
    scd_type1_attributes: tuple[str, ...] = ()
    scd_type2_attributes: tuple[str, ...] = ()
    source_table: str | None = None
    target_table: str | None = None

    @classmethod
    def from_metadata(cls, document: str | Mapping) -> LoadSpec:
        """Build a spec from a metadata document; properties it does not know are ignored."""
        data = json.loads(document) if isinstance(document, str) else document
        values = {}
        for field in fields(cls):
            value = data.get(METADATA_PROPERTIES[field.name])
            if value is not None:
                values[field.name] = tuple(value) if isinstance(value, list) else value
        return cls(**values)

    @property
    def kind(self) -> str:
        """Which feed and which apply this spec asks for."""
        if self.logical_entity == "FACT":
            return FACT
        if self.logical_entity == "DIM" and self.scd_type == "Type1":
            return TYPE1
        if self.logical_entity == "DIM" and self.scd_type == "Type2":
            return TYPE2
        raise ValueError(
            f"no load for logical entity {self.logical_entity!r} with SCD type {self.scd_type!r}"
        )
