"""Record schemas: JSON schema <-> :class:`Schema` <-> Spark types with metadata."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import types as T

from ..errors import DataError

#: Names of logical types, fixed by the record format.
DECIMAL = "org.apache.kafka.connect.data.Decimal"
DATE = "org.apache.kafka.connect.data.Date"
TIME = "org.apache.kafka.connect.data.Time"
TIMESTAMP = "org.apache.kafka.connect.data.Timestamp"

#: Type names of JSON schemas, fixed by the record format, and their Spark types.
PRIMITIVES = {
    "boolean": T.BooleanType(),
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}
#: Metadata keys of Spark fields.
NAME, SCHEMA = "connect.name", "connect.schema"


@dataclass(frozen=True)
class Schema:
    """One schema node. ``items``: arrays; ``keys`` and ``values``: maps; ``fields``: structs, in order."""

    type: str
    optional: bool = False
    name: str | None = None
    version: int | None = None
    doc: str | None = None
    parameters: dict[str, str] | None = None
    default: Any = None
    items: Schema | None = None
    keys: Schema | None = None
    values: Schema | None = None
    fields: tuple[tuple[str, Schema], ...] = field(default=())

    @property
    def scale(self) -> int:
        try:
            return int((self.parameters or {})["scale"])
        except KeyError:
            raise DataError("A decimal schema needs the parameter scale") from None

    # JSON schema

    def to_json_schema(self) -> dict:
        """The JSON schema; every node says whether it is optional."""
        out: dict[str, Any] = {"type": self.type}
        if self.type == "array":
            out["items"] = self.items.to_json_schema()
        elif self.type == "map":
            out |= {"keys": self.keys.to_json_schema(), "values": self.values.to_json_schema()}
        elif self.type == "struct":
            out["fields"] = [{**s.to_json_schema(), "field": n} for n, s in self.fields]
        elif self.type not in PRIMITIVES:
            raise DataError(f"No JSON schema for the type {self.type}")
        out["optional"] = self.optional
        for key in ("name", "version", "doc", "parameters", "default"):
            if (value := getattr(self, key)) is not None:
                out[key] = dict(value) if key == "parameters" else value
        return out

    @classmethod
    def from_json_schema(cls, node: dict | str | None) -> Schema | None:
        """The schema of a JSON schema (parsed or as text); null is no schema."""
        node = json.loads(node) if isinstance(node, str) else node
        if node is None:
            return None
        kind = node.get("type") if isinstance(node, dict) else None
        if not isinstance(kind, str):
            raise DataError("A schema needs a text under 'type'")
        inner: dict[str, Any] = {}
        if kind == "array":
            if node.get("items") is None:
                raise DataError("An array schema needs its element type")
            inner["items"] = cls.from_json_schema(node["items"])
        elif kind == "map":
            for key, what in (("keys", "key"), ("values", "value")):
                if key not in node:
                    raise DataError(f"A map schema needs its {what} type")
                inner[key] = cls.from_json_schema(node[key])
        elif kind == "struct":
            if not isinstance(node.get("fields"), list):
                raise DataError("The fields of a struct schema are not an array")
            if not all(isinstance(f, dict) and isinstance(f.get("field"), str) for f in node["fields"]):
                raise DataError("A struct schema has a field without a text as field name")
            inner["fields"] = tuple((f["field"], cls.from_json_schema(f)) for f in node["fields"])
        elif kind not in PRIMITIVES:
            raise DataError(f"Unknown schema type: {kind}")
        parameters = node.get("parameters")
        if isinstance(parameters, dict) and not all(isinstance(v, str) for v in parameters.values()):
            raise DataError("Schema parameters have string values only")
        version = node.get("version")
        return cls(
            kind,
            optional=node.get("optional") is True,
            name=node["name"] if isinstance(node.get("name"), str) else None,
            version=version if isinstance(version, int) and not isinstance(version, bool) else None,
            doc=node["doc"] if isinstance(node.get("doc"), str) else None,
            parameters=dict(parameters) if isinstance(parameters, dict) else None,
            default=node.get("default"),
            **inner,
        )

    # Spark

    def data_type(self) -> T.DataType:
        if self.name == DECIMAL:
            return T.DecimalType(38, self.scale)
        if self.name == DATE:
            return T.DateType()
        if self.name == TIMESTAMP:
            return T.TimestampType()
        if self.type == "array":
            return T.ArrayType(self.items.data_type(), self.items.optional)
        if self.type == "map":
            return T.MapType(self.keys.data_type(), self.values.data_type(), self.values.optional)
        if self.type == "struct":
            return T.StructType([T.StructField(n, s.data_type(), s.optional, s.metadata()) for n, s in self.fields])
        return PRIMITIVES[self.type]

    def metadata(self) -> dict:
        """Field metadata: the logical name, and the whole schema, because types alone do not hold defaults and docs."""
        return {**({NAME: self.name} if self.name else {}), SCHEMA: json.dumps(self.to_json_schema(), sort_keys=True)}

    @classmethod
    def from_data_type(cls, kind: T.DataType, optional: bool = True, metadata: dict | None = None) -> Schema:
        """The schema of a Spark type; field metadata, where there is any, has the last word."""
        metadata = metadata or {}
        if SCHEMA in metadata:
            return replace(cls.from_json_schema(metadata[SCHEMA]), optional=optional)
        if isinstance(kind, T.DecimalType):
            return cls("bytes", optional, DECIMAL, 1, parameters={"scale": str(kind.scale)})
        if isinstance(kind, T.DateType):
            return cls("int32", optional, DATE, 1)
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return cls("int64", optional, TIMESTAMP, 1)
        if isinstance(kind, T.ArrayType):
            return cls("array", optional, items=cls.from_data_type(kind.elementType, kind.containsNull))
        if isinstance(kind, T.MapType):
            return cls("map", optional, keys=cls.from_data_type(kind.keyType, False), values=cls.from_data_type(kind.valueType, kind.valueContainsNull))
        if isinstance(kind, T.StructType):
            return cls("struct", optional, fields=tuple((f.name, cls.from_data_type(f.dataType, f.nullable, f.metadata)) for f in kind.fields))
        for name, own in PRIMITIVES.items():
            if isinstance(kind, type(own)):
                return cls(name, optional, metadata.get(NAME))
        raise DataError(f"No record schema for the type {kind.simpleString()}")
