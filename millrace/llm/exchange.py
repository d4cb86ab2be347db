"""Corpus-wide questions about packed keys, in a number of rows that grows with the data and no faster.

Members (chunks of texts) hold sorted, distinct 64-bit keys, many to a row, each key with a value. Owners of key ranges
combine the values of all members and answer each member in the order it asked, so answers carry no keys.

    A row for each pair of member and owner would grow with the square of the data, as there are more of both. So keys
    go through a tree: up to ``FAN`` owners are asked directly; where there are more, a member sends ``FAN`` pieces at
    most, pieces of the same range from ``FAN`` members are combined into one new member, and that one asks on, of a
    range that is ``FAN`` times as narrow. Each level moves rows in proportion to the members, and there are as many
    levels as the logarithm of the owners. Answers come back down the same way.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from math import ceil
from typing import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

#: Pieces that a member sends at most, and members that are combined into one.
FAN = 256
ASKED = "member long, kind int, keys binary, rest binary"
PIECES = "nest long, part long, member long, kind int, keys binary, rest binary"
ANSWERED = "part long, member long, kind int, answer binary, distinct long"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def table_of(schema: str, columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[n], _KINDS[k]) for n, k in (c.split() for c in schema.split(", "))], names=[c.split()[0] for c in schema.split(", ")])


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted unsigned longs: the first one, then steps in as many bytes as the widest one needs, without low bytes that
    are zero in all of them."""
    steps = np.diff(keys).astype("<u8")
    every = int(np.bitwise_or.reduce(steps)) if len(steps) else 1
    width, low = max(1, -(-every.bit_length() // 8)), ((every & -every).bit_length() - 1) // 8 if every else 0
    return bytes([width << 4 | low]) + keys[:1].astype("<u8").tobytes() + steps.view(np.uint8).reshape(-1, 8)[:, low:width].tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    if len(data) == 1:
        return np.zeros(0, dtype=np.uint64)
    width, low = data[0] >> 4, data[0] & 15
    body = np.frombuffer(data, np.uint8, -1, 9).reshape(-1, width - low)
    steps = np.zeros((len(body) + 1, 8), dtype=np.uint8)
    steps[0] = np.frombuffer(data, np.uint8, 8, 1)
    steps[1:, low:width] = body
    return np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    most = int(counts.max()) if len(counts) else 0
    kind = "<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u8"
    return kind[-1].encode() + zlib.compress(counts.astype(kind).tobytes(), 1)


def unpack_counts(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), f"<u{data[:1].decode()}").astype(np.int64)


def owner_of(keys: np.ndarray, owners: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


@dataclass(frozen=True)
class Rule:
    """How owners combine. ``read`` and ``write``: values of keys from and to bytes, ``cut``: those of some keys.

    ``combine``: from the members' keys and values, members in ascending order, to (keys, values, answers of each member,
    places of each member's keys among the combined ones, distinct), where the last is a number that is added up over all
    owners. ``settle``: a member's answers from those of ``combine`` and those that came back for the combined keys.
    """

    read: Callable
    write: Callable
    cut: Callable
    combine: Callable
    settle: Callable
    pack_answers: Callable
    read_answers: Callable


def _added(keys: list, values: list) -> tuple:
    """(distinct keys, place of each key among them, ends of members)."""
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    ends = np.cumsum([0, *map(len, keys)])
    return found, place, np.concatenate(values), list(zip(ends, ends[1:]))


def _sums(keys: list, values: list):
    found, place, given, spans = _added(keys, values)
    count = np.bincount(place, weights=given >> 1, minlength=len(found)).astype(np.int64)
    shared = (np.bincount(place, minlength=len(found)) > 1) | (np.bincount(place, weights=given & 1, minlength=len(found)) > 0)
    total, places = 2 * count + shared, [place[a:b] for a, b in spans]
    return found, total, [total[p] for p in places], places, int((count > 0).sum())


def _several(keys: list, values: list):
    found, place, given, spans = _added(keys, values)
    count, places = np.bincount(place, weights=given, minlength=len(found)).astype(np.int64), [place[a:b] for a, b in spans]
    return found, np.minimum(count, 2), [(count > 1)[p] for p in places], places, len(found)


def pack_bits(bits: np.ndarray) -> bytes:
    return np.packbits(bits).tobytes() + bytes([len(bits) & 7])


def unpack_bits(data: bytes) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, np.uint8, len(data) - 1)).astype(bool)
    return bits[: len(bits) - (-data[-1] & 7)]


def _cut(values: np.ndarray, a: int, b: int) -> np.ndarray:
    return values[a:b]


def _theirs(own: np.ndarray, back: np.ndarray) -> np.ndarray:
    return back


#: Counts are added up. A value is twice a count, plus one where several members hold the key.
SUMS = Rule(unpack_counts, pack_counts, _cut, _sums, _theirs, pack_counts, unpack_counts)
#: Do the counts of all members add up to over one?
SEVERAL = Rule(unpack_counts, pack_counts, _cut, _several, _theirs, pack_bits, unpack_bits)


def _split(asked: DataFrame, owners: int, step: int, nests: int, rule: Rule) -> DataFrame:
    """The pieces of members' keys by ``step`` owners; ``nest`` tells which members are combined."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                member, kind, keys, rest = (batch.column(c)[i].as_py() for c in range(4))
                keys, values = unpack_keys(keys), rule.read(rest)
                part = owner_of(keys, owners) // step
                edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else np.zeros(1, dtype=np.int64)
                spans = list(zip(edges.tolist(), edges[1:].tolist()))
                if spans:
                    n, nest = len(spans), zlib.crc32(str(member).encode()) % nests  # the same for all of a member's keys
                    yield table_of(PIECES, {"nest": [nest] * n, "part": part[edges[:-1]].tolist(), "member": [member] * n, "kind": [kind] * n, "keys": [pack_keys(keys[a:b]) for a, b in spans], "rest": [rule.write(rule.cut(values, a, b)) for a, b in spans]})

    return asked.mapInArrow(run, PIECES)


def _opened(table: pa.Table, rule: Rule):
    """For each kind of key: its rows, sorted by member, their keys and values."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["kind"], r["member"]))
    for kind in sorted({r["kind"] for r in rows}):
        own = [r for r in rows if r["kind"] == kind]
        yield kind, own, [unpack_keys(r["keys"]) for r in own], [rule.read(r["rest"]) for r in own]


def _answer(rule: Rule):
    def run(table: pa.Table) -> pa.Table:
        out = {n: [] for n in ("part", "member", "kind", "answer", "distinct")}
        for kind, rows, keys, values in _opened(table, rule):
            _, _, answers, _, distinct = rule.combine(keys, values)
            for i, (r, a) in enumerate(zip(rows, answers)):
                for name, x in zip(out, (r["part"], r["member"], kind, rule.pack_answers(a), 0 if i else distinct)):
                    out[name].append(x)
        return pa.Table.from_batches([table_of(ANSWERED, out)])

    return run


def _combined(rule: Rule):
    def run(table: pa.Table) -> pa.Table:
        out = {n: [] for n in ("member", "kind", "keys", "rest")}
        for kind, rows, keys, values in _opened(table, rule):
            found, value, _, _, _ = rule.combine(keys, values)
            for name, x in zip(out, (rows[0]["nest"], kind, pack_keys(found), rule.write(value))):
                out[name].append(x)
        return pa.Table.from_batches([table_of(ASKED, out)])

    return run


def _returned(rule: Rule):
    """Answers to a combined member go to the pieces that it was made of."""

    def run(pieces: pa.Table, answers: pa.Table) -> pa.Table:
        out = {n: [] for n in ("part", "member", "kind", "answer", "distinct")}
        back = sorted(answers.to_pylist(), key=lambda r: (r["kind"], r["part"]))
        for kind, rows, keys, values in _opened(pieces, rule):
            _, _, own, places, _ = rule.combine(keys, values)
            got = np.concatenate([rule.read_answers(r["answer"]) for r in back if r["kind"] == kind])
            distinct = sum(r["distinct"] for r in back if r["kind"] == kind)
            for i, (r, a, p) in enumerate(zip(rows, own, places)):
                for name, x in zip(out, (r["part"], r["member"], kind, rule.pack_answers(rule.settle(a, got[p])), 0 if i else distinct)):
                    out[name].append(x)
        return pa.Table.from_batches([table_of(ANSWERED, out)])

    return run


def shape(owners: int, fan: int = FAN) -> tuple[int, int]:
    """(owners of each node, levels): the least tree with at least so many owners."""
    levels = 1
    while fan**levels < owners:
        levels += 1
    width = max(1, round(owners ** (1 / levels)))
    while width**levels < owners:
        width += 1
    return width, levels


def resolve(asked: DataFrame, members: int, owners: int, rule: Rule = SUMS, fan: int = FAN) -> DataFrame:
    """Stored answers (part, member, kind, answer, distinct) to ``asked`` (member, kind, keys, rest).

    A member's answers, sorted by kind and part, follow the order of its keys.
    """
    width, levels = shape(owners, fan)
    return _level(asked, members, width**levels, width ** (levels - 1), width, rule)


def _level(asked: DataFrame, members: int, owners: int, step: int, width: int, rule: Rule) -> DataFrame:
    if step == 1:
        return materialize(_split(asked, owners, 1, 1, rule).groupBy("part").applyInArrow(_answer(rule), ANSWERED), "answers")
    nests = ceil(members / width)
    pieces = materialize(_split(asked, owners, step, nests, rule), "pieces")
    combined = materialize(pieces.groupBy("nest", "part").applyInArrow(_combined(rule), ASKED), "combined")
    answers = _level(combined, nests, owners, step // width, width, rule)
    below = answers.withColumn("up", F.floor(F.col("part") / width)).groupBy("member", "up")
    out = materialize(pieces.groupBy("nest", "part").cogroup(below).applyInArrow(_returned(rule), ANSWERED), "answers")
    discard(pieces, combined, answers)
    return out


def gathered(answers: DataFrame, key: str, name: str) -> DataFrame:
    """One row a member: ``key`` and, in the order of its keys, its answers as array ``name``."""
    rows = answers.select(F.col("member").alias(key), F.struct("kind", "part", "answer").alias("x"))
    return rows.groupBy(key).agg(F.sort_array(F.collect_list("x")).alias(name))


def answers_of(got: list | None, kind: int, rule: Rule = SUMS) -> np.ndarray:
    """The answers of one kind that a member got, in the order of its keys."""
    parts = [rule.read_answers(g["answer"]) for g in got or [] if g["kind"] == kind]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=bool if rule.read_answers is unpack_bits else np.int64)
