"""Settings of the sink and of the JSON codec."""

from __future__ import annotations

from dataclasses import dataclass, field

from ..errors import ConfigError
from ..functions.delimiter import parse_delimiter
from .routing import topic_map

SINK_PREFIX = "sink.properties."
#: Keys that stand under a vendor's prefix ("<any>.http.url"); ours is "store.".
STORE_KEYS = ("http.url", "database.name", "username", "password", "topic2table.map")
REQUIRED = ("store.http.url", "store.database.name", "store.username", "store.password")
#: Numeric keys: default, least and greatest value.
RANGES = {
    "bufferflush.maxbytes": (67108864, 67108864, 10737418240),
    "connect.timeoutms": (100, 100, 60000),
    "bufferflush.intervalms": (1000, 1000, 3600000),
    "sink.maxretries": (3, -1, 2**63 - 1),
}
NOT_EMPTY = ("store.http.url", "store.database.name", "store.username", "store.topic2table.map", "sink.properties.format")


def canonical(settings: dict[str, str]) -> dict[str, str]:
    """The same settings with store keys under our prefix, whatever vendor prefix they came with."""
    out = {}
    for key, value in settings.items():
        _, _, tail = key.partition(".")
        out["store." + tail if tail in STORE_KEYS else key] = value
    return out


def with_defaults(settings: dict[str, str]) -> dict[str, str]:
    """Numeric keys that are absent get their defaults."""
    return {**{k: str(v[0]) for k, v in RANGES.items()}, **canonical(settings)}


def validate(settings: dict[str, str]) -> dict[str, list[str]]:
    """Error messages by key; every key of the definition is listed. Keys that are not defined are accepted."""
    filled = with_defaults(settings)
    errors: dict[str, list[str]] = {k: [] for k in dict.fromkeys([*REQUIRED, *RANGES, *NOT_EMPTY])}
    for key in REQUIRED:
        if key not in filled:
            errors[key].append(f"You must specify {key}")
    for key in NOT_EMPTY:
        if filled.get(key) == "":
            errors[key].append(f"{key} must not be empty")
    for key, (_, least, most) in RANGES.items():
        try:
            value = int(filled[key])
        except ValueError:
            errors[key].append(f"{key} must be a whole number, not {filled[key]!r}")
            continue
        if not least <= value <= most:
            errors[key].append(f"{key} must be from {least} to {most}, not {value}")
    return errors


@dataclass(frozen=True)
class CodecConfig:
    """Settings of the JSON codec on its own."""

    schemas_enable: bool = True
    schemas_cache_size: int = 1000
    decimal_format: str = "BASE64"
    replace_null_with_default: bool = True

    def __post_init__(self):
        object.__setattr__(self, "decimal_format", self.decimal_format.upper())
        if self.decimal_format not in ("BASE64", "NUMERIC"):
            raise ConfigError(f"decimal.format must be BASE64 or NUMERIC, not {self.decimal_format}")
        if self.schemas_cache_size < 0:
            raise ConfigError("schemas.cache.size must not be negative")

    @classmethod
    def from_dict(cls, settings: dict) -> CodecConfig:
        def flag(key, default):
            value = settings.get(key, default)
            if isinstance(value, bool):
                return value
            if str(value).strip().lower() not in ("true", "false"):
                raise ConfigError(f"{key} must be true or false, not {value!r}")
            return str(value).strip().lower() == "true"

        return cls(flag("schemas.enable", True), int(settings.get("schemas.cache.size", 1000)), str(settings.get("decimal.format", "BASE64")), flag("replace.null.with.default", True))


#: What the sink encodes rows with.
SINK_CODEC = CodecConfig(decimal_format="NUMERIC", replace_null_with_default=False)


@dataclass(frozen=True)
class SinkConfig:
    """Checked settings of a sink."""

    endpoints: tuple[str, ...]
    database: str
    username: str
    password: str
    format: str = "json"
    row_delimiter: str = "\n"
    tables: dict[str, str] = field(default_factory=dict)
    max_bytes: int = 67108864
    interval_ms: int = 1000
    connect_timeout_ms: int = 100
    max_retries: int = 3
    load_properties: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, settings: dict[str, str]) -> SinkConfig:
        wrong = [m for messages in validate(settings).values() for m in messages]
        if wrong:
            raise ConfigError("; ".join(wrong))
        s = with_defaults(settings)
        kind = s.setdefault("sink.properties.format", "json").lower()
        if kind not in ("csv", "json"):
            raise ConfigError("data format are not support")
        return cls(
            endpoints=tuple(s["store.http.url"].split(",")),
            database=s["store.database.name"],
            username=s["store.username"],
            password=s["store.password"],
            format=kind,
            row_delimiter=parse_delimiter(s.get("sink.properties.row_delimiter"), "\n") if kind == "csv" else "\n",
            tables=topic_map(s.get("store.topic2table.map")),
            max_bytes=int(s["bufferflush.maxbytes"]),
            interval_ms=int(s["bufferflush.intervalms"]),
            connect_timeout_ms=int(s["connect.timeoutms"]),
            max_retries=int(s["sink.maxretries"]),
            load_properties={k[len(SINK_PREFIX) :].lower(): v for k, v in s.items() if k.startswith(SINK_PREFIX)},
        )
