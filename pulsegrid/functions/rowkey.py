"""Binary row key of the keyed time-series table.

Layout, big endian: salt (1 byte, last decimal digit of the device id),
device id (4 bytes), connector id (4 bytes), reverse time (8 bytes,
``Long.MAX - epoch millis``), then, unless ``compat`` is set, the UTF-8 bytes
of the variable id so that variables of one message do not overwrite each
other. Built from hex strings, so it stays a codegen'd column expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrid.config import MAX_LONG


SALT_DIGITS = 10


def key_prefix(deviceid: int, connectorid: int) -> bytes:
    """The key's bytes before the time: salt, device, connector."""
    wrapped = [(x & 0xFFFFFFFF).to_bytes(4, "big") for x in (deviceid, connectorid)]
    return bytes([abs(deviceid) % SALT_DIGITS]) + b"".join(wrapped)


def prefix_end(prefix: bytes) -> bytes:
    """The least key that is greater than every key with the prefix."""
    return (int.from_bytes(prefix, "big") + 1).to_bytes(len(prefix), "big")


def time_bound(millis: int) -> bytes:
    """The key's time bytes for epoch milliseconds."""
    return (MAX_LONG - millis).to_bytes(8, "big")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def salt_byte(deviceid: str | Column = "deviceid") -> Column:
    """Last decimal digit of the device id (sign ignored)."""
    return F.abs(_col(deviceid).cast("bigint")) % SALT_DIGITS


def reverse_millis(eventtime: str | Column = "eventtime") -> Column:
    """``Long.MAX - epoch millis``; null where 64-bit arithmetic would wrap
    (times before 1970)."""
    return F.try_subtract(F.lit(MAX_LONG), F.unix_millis(_col(eventtime)))


def _hex32(c: Column) -> Column:
    return F.lpad(F.hex(c.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")


def row_key_hex(
    deviceid: str | Column = "deviceid",
    connectorid: str | Column = "connectorid",
    eventtime: str | Column = "eventtime",
    variableid: str | Column | None = "variableid",
    compat: bool = False,
) -> Column:
    """Upper-case hex text of :func:`row_key`."""
    parts = [
        F.lpad(F.hex(salt_byte(deviceid)), 2, "0"),
        _hex32(_col(deviceid)),
        _hex32(_col(connectorid)),
        F.lpad(F.hex(reverse_millis(eventtime)), 16, "0"),
    ]
    if not compat and variableid is not None:
        parts.append(F.hex(F.encode(_col(variableid), "UTF-8")))
    # concat yields null as soon as one part is null: a null connector or a
    # pre-1970 time gives a null key.
    return F.concat(*parts)


def row_key(
    deviceid: str | Column = "deviceid",
    connectorid: str | Column = "connectorid",
    eventtime: str | Column = "eventtime",
    variableid: str | Column | None = "variableid",
    compat: bool = False,
) -> Column:
    """The binary row key (17 bytes in compat mode, 17 + variable id bytes otherwise)."""
    return F.unhex(row_key_hex(deviceid, connectorid, eventtime, variableid, compat))
