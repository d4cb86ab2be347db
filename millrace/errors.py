"""Errors of configuration and data."""


class ConfigError(ValueError):
    """A setting is missing, malformed or out of range."""


class DataError(ValueError):
    """A value or schema cannot be converted."""
