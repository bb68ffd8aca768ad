"""Framed messages to typed columns.

A message is one zero byte, a four-byte big-endian schema id and the payload.
All functions work on batch and streaming frames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.columns import all_null, any_null
from tillstream.sources.schemas import REQUIRED, TIME, avro_schema_json, wire_schema

HEADER_BYTES = 5

# How far a row's time may be ahead of its arrival, and behind it.
AHEAD, BEHIND = "1 day", "3650 days"

NOT_FRAMED, UNKNOWN_SCHEMA, UNDECODABLE = "not_framed", "unknown_schema", "undecodable"
MISSING_REQUIRED, IMPLAUSIBLE_TIME = "missing_required", "implausible_time"
REASONS = (NOT_FRAMED, UNKNOWN_SCHEMA, UNDECODABLE, MISSING_REQUIRED, IMPLAUSIBLE_TIME)


def payload(value: str = "value") -> Column:
    """The bytes after the header; empty when the message is too short."""
    return F.substr(F.col(value), F.lit(HEADER_BYTES + 1))


def is_framed(value: str = "value") -> Column:
    first_byte = F.substring(F.col(value), 1, 1)
    return (F.length(value) >= HEADER_BYTES) & (first_byte == F.unhex(F.lit("00")))


def schema_id(value: str = "value") -> Column:
    """The schema id in the header, NULL when the message is too short."""
    digits = F.hex(F.substring(F.col(value), 2, 4))
    return F.when(F.length(value) >= HEADER_BYTES, F.conv(digits, 16, 10).try_cast("int"))


def decoded(fmt: str = "json", value: str = "value", schema: T.StructType | str | None = None) -> Column:
    """The payload as a struct; damaged payloads never raise.

    `avro` needs the spark-avro package; `json` is built in. Another event
    schema is a struct type for JSON, an Avro schema text for Avro.
    """
    options = {"mode": "PERMISSIVE"}
    if fmt == "avro":
        from pyspark.sql.avro.functions import from_avro

        return from_avro(payload(value), schema or avro_schema_json(), options)
    if fmt == "json":
        return F.from_json(payload(value).cast("string"), schema or wire_schema(), options)
    raise ValueError(f"unknown payload format {fmt!r}")


@dataclass(frozen=True)
class Writer:
    """What one schema id stands for: the writer's own schema and how its fields become ours.

    `names` maps our field names to the writer's where they differ; a field that the writer
    lacks gets its value from `defaults`, else NULL. A present NULL stays NULL. For Avro
    `schema` is the writer's schema text and `reader` the text to resolve it to, which
    holds aliases and defaults itself.
    """

    schema: T.StructType | str
    names: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, object] = field(default_factory=dict)
    reader: str | None = None

    def rows(self, fmt: str, value: str) -> Column:
        """The payload in our fields, as an array of one struct; the lambda binds it, so that it is decoded once."""
        if fmt == "avro":
            from pyspark.sql.avro.functions import from_avro

            resolve = {"mode": "PERMISSIVE", "avroSchema": self.reader or avro_schema_json()}
            return F.array(from_avro(payload(value), self.schema, resolve))
        written = [f.name for f in self.schema.fields]

        def ours(theirs: Column) -> Column:
            # Damaged payloads are structs of NULLs; they get no defaults, so that they are still known as damaged.
            whole = reduce(or_, [theirs[name].isNotNull() for name in written])
            fields = []
            for f in wire_schema().fields:
                name = self.names.get(f.name, f.name)
                found = theirs[name] if name in written else F.when(whole, F.lit(self.defaults.get(f.name)))
                fields.append(found.try_cast(f.dataType).alias(f.name))
            return F.struct(*fields)

        return F.transform(F.array(decoded(fmt, value, self.schema)), ours)


Versions = Mapping[int, Writer]


def decoded_rows(fmt: str, value: str, schema: T.StructType | str | None, versions: Versions | None) -> Column:
    """Array of one struct: the payload by the one schema, or by that of the id in the header; of another id NULL."""
    if versions is None:
        return F.array(decoded(fmt, value, schema))
    known = F.array(F.lit(None).cast(wire_schema()))
    for number, writer in versions.items():
        known = F.when(schema_id(value) == number, writer.rows(fmt, value)).otherwise(known)
    return known


def unpack(
    frame: DataFrame,
    fmt: str = "json",
    keep: Sequence[str] = (),
    value: str = "value",
    schema: T.StructType | str | None = None,
    versions: Versions | None = None,
) -> DataFrame:
    """Messages to columns, the time still as text.

    `versions` names the writer schema behind each id in the header; without it all
    messages have `schema`. A generator turns the struct into columns. Unlike a projection
    it stops later filters from being moved ahead of it, which would decode each message
    once per filtered field.
    """
    return frame.select(*keep, F.inline(decoded_rows(fmt, value, schema, versions)))


def is_undecodable() -> Column:
    """No required field could be read.

    Permissive decoding turns damage into a struct of NULLs about as often as
    into a NULL struct, so the fields are tested, not the struct.
    """
    return all_null(REQUIRED)


def drop_undecodable(unpacked: DataFrame) -> DataFrame:
    return unpacked.where(~is_undecodable())


def parse_time(unpacked: DataFrame) -> DataFrame:
    """The ISO time text to a timestamp, NULL when it cannot be read."""
    return unpacked.withColumn("transaction_ts", F.try_to_timestamp("transaction_ts"))


def parse_and_cast(frame: DataFrame, fmt: str = "json", keep: Sequence[str] = ()) -> DataFrame:
    """Raw messages to sale rows."""
    return frame.transform(unpack, fmt, keep).transform(drop_undecodable).transform(parse_time)


def is_implausible(arrival: Column, ahead: str = AHEAD, behind: str = BEHIND, time: str = TIME) -> Column:
    """Whether a row's time is too far from its arrival. One such row ahead of all others would
    move a watermark, or the bound of an incremental run, past every later row. Without one of the
    two times nothing can be told, and the row passes.
    """
    at = F.col(time)
    far = (at > arrival + F.expr(f"interval {ahead}")) | (at < arrival - F.expr(f"interval {behind}"))
    return F.coalesce(far, F.lit(False))


def with_reject_reason(
    frame: DataFrame,
    fmt: str = "json",
    keep: Sequence[str] = (),
    value: str = "value",
    arrival: Column | None = None,
    ahead: str = AHEAD,
    behind: str = BEHIND,
    versions: Versions | None = None,
) -> DataFrame:
    """Every message, decoded, with why it may not be stored (NULL when it may).

    `arrival` is when the message came (the broker's time, say); with it, times too far
    from it are rejected, ahead of any watermark. `versions` names the writer schemas by
    the id in the header; other ids are rejected. `transaction_ts_text` is the time as it
    was sent, for times that cannot be read.
    """
    framed = frame.withColumn("_framed", F.coalesce(is_framed(value), F.lit(False)))
    known = F.coalesce(schema_id(value).isin(list(versions)), F.lit(False)) if versions is not None else F.lit(True)
    framed = framed.withColumn("_known", known).withColumn("_arrival", F.lit(None).cast("timestamp") if arrival is None else arrival)
    unpacked = framed.transform(unpack, fmt, ["_framed", "_known", "_arrival", *keep], value, None, versions)
    unpacked = unpacked.withColumn("transaction_ts_text", F.col("transaction_ts"))
    damage = F.when(~F.col("_framed"), NOT_FRAMED).when(~F.col("_known"), UNKNOWN_SCHEMA).when(is_undecodable(), UNDECODABLE)
    parsed = parse_time(unpacked.withColumn("reject_reason", damage))
    unfit = F.when(any_null(REQUIRED), MISSING_REQUIRED).when(is_implausible(F.col("_arrival"), ahead, behind), IMPLAUSIBLE_TIME)
    return parsed.withColumn("reject_reason", F.coalesce("reject_reason", unfit)).drop("_framed", "_known", "_arrival")


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reject_reason").isNull()).drop("reject_reason", "transaction_ts_text")


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reject_reason").isNotNull())
