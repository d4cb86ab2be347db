"""From topics to tables."""

from __future__ import annotations

import logging
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import ConfigError

log = logging.getLogger(__name__)

#: Up to three dotted parts of at least two characters each.
TABLE_NAME = r"([_a-zA-Z][_$a-zA-Z0-9]+\.){0,2}[_a-zA-Z][_$a-zA-Z0-9]+"


def valid_table_name(name: str) -> bool:
    return re.fullmatch(TABLE_NAME, name) is not None


def valid_table_name_column(name: Column) -> Column:
    return name.rlike(f"^(?:{TABLE_NAME})$")


def _split(text: str, mark: str) -> list[str]:
    """Split without the empty pieces at the end (a text without the mark is one piece, even if empty)."""
    pieces = text.split(mark)
    while len(pieces) > 1 and not pieces[-1]:
        pieces.pop()
    return pieces


def parse_topic_map(text: str) -> dict[str, str] | None:
    """``topic1:table1,topic2:table2``. A malformed pair disables the whole map (None); otherwise a bad table name or a
    topic given twice is an error, raised after all pairs have been looked at."""
    found: dict[str, str] = {}
    wrong = []
    for pair in _split(text, ","):
        pieces = [p.strip(_JAVA_BLANKS) for p in _split(pair, ":")]
        if len(pieces) != 2 or not all(pieces):
            log.error("malformed topic map, topics are used as table names: %s", text)
            return None
        topic, table = pieces
        if not valid_table_name(table):
            wrong.append(f"table name {table} is not valid")
        if topic in found:
            wrong.append(f"topic {topic} is given twice")
        found[topic] = table
    if wrong:
        raise ConfigError(f"Invalid topic map {text!r}: " + "; ".join(wrong))
    return found


#: What trimming takes off: every character up to the blank.
_JAVA_BLANKS = "".join(map(chr, range(0x21)))


def topic_map(text: str | None) -> dict[str, str]:
    """The map to use: empty where none is given or it is malformed."""
    return (parse_topic_map(text) or {}) if text is not None else {}


def table_for(topic: Column, mapping: dict[str, str]) -> Column:
    """The mapped table, else the topic as it is: a projection over a literal map, no join."""
    if not mapping:
        return topic
    literal = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.element_at(literal, topic), topic)
