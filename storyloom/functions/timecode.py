"""Time codes: hh:mm:ss:ff at 30 frames a second, or hh:mm:ss.ff in hundredths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FRAMES = 30
NTSC = 29.97


def parse(code: Column) -> Column:
    """Seconds; parts beyond their range count as the greatest in it; -1 for what is no time code. A part may be missing at
    the front."""
    dotted = F.contains(code, F.lit("."))
    parts = F.split(F.when(dotted, F.regexp_replace(code, "\\.", ":")).otherwise(code), ":")
    ok = code.rlike("^[0-9]{1,3}(:[0-9]{1,2}){1,3}(\\.[0-9]{1,2})?$") & F.when(dotted, F.size(parts).between(3, 4)).otherwise(F.size(parts) == 4)
    back = lambda k: F.coalesce(F.get(F.reverse(parts), F.lit(k)).try_cast("int"), F.lit(0))
    fraction = F.when(dotted, back(0) / 100.0).otherwise(F.least(back(0), F.lit(FRAMES - 1)) / float(FRAMES))
    return F.when(ok, back(3) * 3600 + F.least(back(2), F.lit(59)) * 60 + F.least(back(1), F.lit(59)) + fraction).otherwise(F.lit(-1.0))


def format_seconds(seconds: Column) -> Column:
    """HH:MM:SS.ff, hundredths cut off."""
    c = F.floor(seconds * 100 + F.lit(1e-6)).cast("bigint")
    part = lambda d, m: F.pmod(F.floor(c / d).cast("bigint"), F.lit(m))
    return F.format_string("%02d:%02d:%02d.%02d", F.floor(c / 360000).cast("bigint"), part(6000, 60), part(100, 60), F.pmod(c, F.lit(100)))


def padded(code: Column) -> Column:
    """A code with parts missing at the front, with two digits each."""
    parts = F.split(code, ":")
    pad = F.transform(F.concat(F.array_repeat(F.lit("0"), F.greatest(4 - F.size(parts), F.lit(0))), parts), lambda p: F.lpad(p, F.greatest(F.length(p), F.lit(2)), "0"))
    return F.array_join(pad, ":")


def to_real_time(seconds: Column, offset: float = 0.0) -> Column:
    """Non-drop codes run slow against the clock: an hour of them at 29.97 is an hour and 3.6 seconds."""
    return seconds * (FRAMES / NTSC) - offset


def to_code_time(seconds: Column, offset: float = 0.0) -> Column:
    return seconds * (NTSC / FRAMES) - offset


def frame_before(seconds: Column) -> Column:
    return seconds - 1.0 / FRAMES


def hundredths_before(seconds: Column) -> Column:
    """The end before a start in hundredths: three of them, about a frame."""
    return F.round(seconds - 0.03, 2)
