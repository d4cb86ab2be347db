"""Row delimiters written as text or as hex bytes (``\\x0A``)."""

from __future__ import annotations

import string

from ..errors import ConfigError


def parse_delimiter(text: str | None, default: str = "\n") -> str:
    """``default`` for no text; the text itself unless it starts with ``\\x`` or ``\\X``; else one character a byte.

    Bytes from 0x80 on are signed where they come from, so ``\\xE4`` is U+FFE4: kept, because loads written with such a
    delimiter are read back with the same one.
    """
    if not text:
        return default
    if text[:2].upper() != "\\X":
        return text
    digits = text[2:]
    if not digits:
        raise ConfigError("Failed to parse delimiter: `Hex str is empty`")
    if len(digits) % 2:
        raise ConfigError("Failed to parse delimiter: `Hex str length error`")
    if not set(digits) <= set(string.hexdigits):
        raise ConfigError("Failed to parse delimiter: `Hex str format error`")
    return "".join(chr(b if b < 0x80 else 0xFF00 | b) for b in bytes.fromhex(digits))
