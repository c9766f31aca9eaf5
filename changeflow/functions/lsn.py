"""Log sequence numbers and the server's timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Microseconds from 1970-01-01 to 2000-01-01.
EPOCH_OFFSET = 946_684_800_000_000
#: The last microsecond of the year 9999, which a timestamp can hold.
LAST = 253_402_300_799_999_999


def parse_lsn(text: Column) -> Column:
    """``X/Y`` in hexadecimal as a long; null unless it is two numbers of up to 32 bits."""
    ok = text.rlike(r"^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$")
    half = lambda k: F.conv(F.split_part(text, F.lit("/"), F.lit(k)), 16, 10).cast("decimal(20,0)").cast("long")
    return F.when(ok, F.shiftleft(half(1), 32).bitwiseOR(half(2)))


def format_lsn(lsn: Column) -> Column:
    """A long as ``X/Y``, upper case, without leading zeros."""
    return F.concat_ws("/", F.hex(F.shiftrightunsigned(lsn.cast("long"), 32)), F.hex(lsn.cast("long").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))))


def server_timestamp(micros: Column) -> Column:
    """Microseconds since 2000-01-01 as ISO text with six decimals.

    A negative value with a part of a second, or one beyond the year 9999, has
    the form ``{n}us``.
    """
    micros = micros.cast("long")
    plain = ((micros >= 0) & (micros <= LAST - EPOCH_OFFSET)) | ((micros < 0) & (micros % 1_000_000 == 0) & (micros > -EPOCH_OFFSET - 62_135_596_800_000_000))
    shown = F.date_format(F.timestamp_micros(F.when(plain, micros + EPOCH_OFFSET)), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.when(plain, shown).otherwise(F.concat(micros.cast("string"), F.lit("us")))
