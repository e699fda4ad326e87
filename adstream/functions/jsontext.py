"""JSON decode of events and notices, JSON encode of rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from adstream.schemas import EVENT_SCHEMAS, NOTICE

_END, MALFORMED = "_end", "malformed"

# Notice fields without which a folder cannot be found.
NOTICE_FIELDS = ("bucket", "folder_path", "client_events_file", "server_events_file")

# Event fields that are JSON numbers in well-formed events.
NUMBER_FIELDS = ("ad_id", "publisher_id", "latency", "ctimestamp", "campaign_id")


def _marked(schema: StructType) -> Column:
    """The ``value`` column as an array of one struct, empty unless it is one JSON object.

    The parser stops at the end of the first value of a text, whatever follows.
    So the text is decoded as the first element of an array whose second and
    last element repeats a hash of the text: were anything to close the array
    or add elements before, that could not be the second of two. The parse is
    the argument of a lambda, so that the tests on it do not repeat it.
    """
    text = F.col("value").cast("string")
    seal = F.xxhash64(text).cast("string")
    wrapped = F.concat(F.lit("["), text, F.lit(',{"_end":"'), seal, F.lit('"}]'))
    element = StructType([*schema.fields]).add(_END, StringType())
    found = F.from_json(wrapped, ArrayType(element), {"allowSingleQuotes": "false"})
    # Most texts have nothing around the braces, and trimming is slow.
    opens = F.startswith(text, F.lit("{")) | F.startswith(
        F.trim(text, F.lit(" \t\r\n")), F.lit("{")
    )

    def checked(parsed: Column) -> Column:
        first, last = F.get(parsed, F.lit(0)), F.get(parsed, F.lit(1))
        whole = opens & (F.size(parsed) == 2) & (last.getField(_END) == seal) & first.isNotNull()
        fields = [first.getField(f.name).alias(f.name) for f in schema]
        return F.when(whole, F.struct(*fields, F.lit(False).alias(MALFORMED)))

    return F.filter(F.transform(F.array(found), checked), lambda row: row.isNotNull())


def decode(df: DataFrame, schema: StructType) -> DataFrame:
    """All rows: the fields of ``schema``, ``value`` and whether it is ``malformed``.

    The parse is expanded by a generator, which is a node of its own: in a plain
    projection Catalyst would push a filter on the fields below it and so parse
    every row twice.
    """
    texts = df.withColumn("value", F.col("value").cast("string"))
    rows = texts.select("*", F.inline_outer(_marked(schema)))
    return rows.withColumn(MALFORMED, F.col(MALFORMED).isNull())


def well_formed(decoded: DataFrame) -> DataFrame:
    return decoded.where(~F.col(MALFORMED)).drop("value", MALFORMED)


def rejected(decoded: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
    """The malformed rows as they arrived, with the ``side`` they came from."""
    return decoded.where(MALFORMED).select(*columns, F.lit(side).alias("side"))


def parse_events(df: DataFrame, side: str) -> DataFrame:
    """Decode ``value`` into the text fields of one side, malformed rows left out."""
    return well_formed(decode(df, EVENT_SCHEMAS[side]))


def quarantined_events(df: DataFrame, side: str) -> DataFrame:
    """The rows :func:`parse_events` leaves out, as they arrived."""
    return rejected(decode(df, EVENT_SCHEMAS[side]), df.columns, side)


def _usable(notice: Callable[[str], Column]) -> Column:
    """Whether a notice names all it needs."""
    return reduce(and_, [notice(name).isNotNull() for name in NOTICE_FIELDS])


def parse_notices(df: DataFrame) -> DataFrame:
    """Decode folder notices; malformed ones and those that name no files are left out."""
    return well_formed(decode(df, NOTICE)).where(_usable(F.col))


def quarantined_notices(df: DataFrame) -> DataFrame:
    """The rows :func:`parse_notices` leaves out, as they arrived."""
    decoded = decode(df, NOTICE)
    unusable = decoded.withColumn(MALFORMED, F.col(MALFORMED) | ~_usable(F.col))
    return rejected(unusable, df.columns, "notice")


def _variant(name: str) -> Column:
    """The JSON number a text spells, or else the text as a JSON string."""
    text, number = F.col(name).cast("string"), F.col(name).try_cast("bigint")
    spelt = number.cast("string") == text
    return F.when(spelt, number.cast("variant")).otherwise(text.cast("variant")).alias(name)


def encode_rows(df: DataFrame, *keep: str) -> DataFrame:
    """One JSON object per row in ``value``; NULL fields are written as null.

    Columns named in ``keep`` are carried along instead of encoded. Number
    fields whose text spells no number are written as strings. As most rows
    have none, the others take the plain BIGINT encoding, at half the cost.
    """
    options = {"ignoreNullFields": "false"}
    fields = [name for name in df.columns if name not in keep]
    numbers = [name for name in fields if name in NUMBER_FIELDS]
    spelt = [
        F.col(n).try_cast("bigint").cast("string").eqNullSafe(F.col(n).cast("string"))
        for n in numbers
    ]
    typed = [
        F.col(n).try_cast("bigint").alias(n) if n in numbers else F.col(n) for n in fields
    ]
    mixed = [_variant(n) if n in numbers else F.col(n) for n in fields]
    value = F.when(
        reduce(and_, spelt, F.lit(True)), F.to_json(F.struct(*typed), options)
    ).otherwise(F.to_json(F.struct(*mixed), options))
    return df.select(*keep, value.alias("value"))
