"""Scalar functions of the archive as column expressions; all stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PHASES = ("D", "R", "P")
#: File type to MIME type; fixed values.
MIME_TYPES = {
    "jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "gif": "image/gif",
    "mp4": "video/mp4", "vtt": "text/vtt", "json": "application/json", "xml": "text/xml", "txt": "text/plain",
}


def time_to_ms(h: Column, m: Column, s: Column, ms: Column) -> Column:
    return (((h * 60 + m) * 60 + s) * 1000 + ms).cast("bigint")


def ms_of_day(ts: Column) -> Column:
    return time_to_ms(F.hour(ts), F.minute(ts), F.second(ts), F.lit(0))


def ms_to_hms(ms: Column) -> Column:
    """000:00:00, with seconds rounded to whole ones for display."""
    ms = ms.cast("bigint")
    h, rest = F.floor(ms / 3600000), F.pmod(ms, F.lit(3600000))
    return F.format_string("%03d:%02d:%02d", h.cast("bigint"), F.floor(rest / 60000).cast("bigint"), F.bround(F.pmod(rest, F.lit(60000)) / 1000, 0).cast("bigint"))


def vtt_time(ms: Column) -> Column:
    """MM:SS.mmm; minutes go on past 59."""
    ms = ms.cast("bigint")
    return F.format_string("%02d:%02d.%03d", F.floor(ms / 60000).cast("bigint"), F.floor(F.pmod(ms, F.lit(60000)) / 1000).cast("bigint"), F.pmod(ms, F.lit(1000)))


def shortened(s: Column, n: int) -> Column:
    """Cut at the first space at or after place n - 3 and marked by dots; unchanged if short, or without such a space. May be
    longer than n."""
    at = F.locate(" ", s, max(1, n - 2))
    return F.when((F.length(s) > n) & (at > 0), F.concat(F.substr(s, F.lit(1), at - 1), F.lit("..."))).otherwise(s)


def file_extension(path: Column) -> Column:
    return F.regexp_extract(path, r"\.([^./\\]+)$", 1)


def safe_file_name(s: Column) -> Column:
    return F.regexp_replace(s, "[^a-zA-Z0-9_]", "_")


def straight_quotes(s: Column) -> Column:
    return F.translate(s, "‘’“”", "''\"\"")


def transcript(paragraphs: Column) -> Column:
    """Paragraphs joined by a blank line, with straight quotes."""
    return straight_quotes(F.array_join(paragraphs, "\n\n"))


def paragraphs(text: Column) -> Column:
    return F.split(text, "\n\n")


def initial(s: Column) -> Column:
    return F.upper(F.substring(s, 1, 1))


def tag_code(s: Column) -> Column:
    return F.substring(s, 1, 8)


def aspect_ratio(w: Column, h: Column, mapped: dict[tuple[int, int], str] | None = None) -> Column:
    """4:3 or 16:9 by the first three digits of width / height; else what the resolution is mapped to, if anything."""
    r = F.when(h != 0, F.floor(w * 100 / h))
    out = F.lit(None).cast("string")
    for (mw, mh), name in (mapped or {}).items():
        out = F.when((w == mw) & (h == mh), name).otherwise(out)
    return F.when(r == 133, "4:3").when(r == 177, "16:9").otherwise(out)


def first_last(name: Column) -> Column:
    """'Last, First' to 'First Last'."""
    return F.when(F.contains(name, F.lit(",")), F.concat_ws(" ", F.trim(F.split_part(name, F.lit(","), F.lit(2))), F.trim(F.split_part(name, F.lit(","), F.lit(1))))).otherwise(name)


def joined_nonempty(sep: str, *parts: Column) -> Column:
    return F.concat_ws(sep, *(F.nullif(F.trim(p), F.lit("")) for p in parts))


def gender_strict(s: Column) -> Column:
    """M or F; anything else is an error."""
    u = F.upper(F.substring(F.trim(s), 1, 1))
    return F.when(u.isin("M", "F"), u).otherwise(F.raise_error(F.concat(F.lit("not a gender: "), F.coalesce(s, F.lit("NULL")))))


def gender_lenient(s: Column) -> Column:
    """M for what begins with M, else F."""
    return F.when(F.upper(F.substring(F.trim(s), 1, 1)) == "M", "M").otherwise("F")


def lenient_date(s: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """NULL where the text is empty or no date."""
    return F.try_to_timestamp(F.nullif(F.trim(s), F.lit("")), F.lit(fmt)).cast("date")


def bad_date(s: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Whether a text that isn't empty is no date."""
    return (F.coalesce(F.trim(s), F.lit("")) != "") & lenient_date(s, fmt).isNull()


def category_tokens(s: Column) -> Column:
    """Values between bars, trimmed, without the plural's s, each once."""
    clean = F.transform(F.split(s, "\\|"), lambda x: F.rtrim(F.trim(x), F.lit("s")))
    return F.array_distinct(F.filter(clean, lambda x: x != ""))


def without_brackets(s: Column) -> Column:
    """Bracketed parts removed, the first opener deciding the closer; an unclosed one runs to the end."""
    return F.regexp_replace(s, r"\[[^\]]*\]?|\([^)]*\)?", "")


def clean_text(s: Column) -> Column:
    """without_brackets(), with single spaces and none before punctuation."""
    return F.trim(F.regexp_replace(F.regexp_replace(without_brackets(s), r"\s+", " "), r" ([.,;:!?])", "$1"))


def redacted(s: Column) -> Column:
    """Characters but spaces within square brackets (which may nest), and the brackets, become hyphens; NULL if they don't
    balance. One fold over the characters."""
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("bad"), F.lit("").alias("out"))

    def step(a: Column, c: Column) -> Column:
        depth = a["depth"] + F.when(c == "[", 1).when(c == "]", -1).otherwise(0)
        hidden = ((a["depth"] > 0) | (c == "[")) & ~c.rlike("\\s")
        return F.struct(depth.alias("depth"), (a["bad"] | (depth < 0)).alias("bad"), F.concat(a["out"], F.when(hidden, "-").otherwise(c)).alias("out"))

    return F.aggregate(F.split(s, ""), start, step, lambda a: F.when(~a["bad"] & (a["depth"] == 0), a["out"]))


def vtt_escaped(s: Column) -> Column:
    for c, to in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        s = F.replace(s, F.lit(c), F.lit(to))
    return s


def md5_base64(s: Column) -> Column:
    return F.base64(F.unhex(F.md5(s.cast("binary"))))


def blob_parts(path: Column) -> Column:
    """container/scope/type/id, as a struct."""
    p = F.split(path, "/")
    return F.struct(*(F.get(p, F.lit(i)).alias(n) for i, n in enumerate(("container", "scope", "type", "id"))))


def phase_rank(phase: Column) -> Column:
    """Draft, review, published; a blank is a draft."""
    p = F.when(F.trim(F.coalesce(phase, F.lit(""))) == "", "D").otherwise(phase)
    return F.array_position(F.array(*map(F.lit, PHASES)), p)


def caption_path(media_path: Column) -> Column:
    return F.replace(media_path, F.lit("mp4"), F.lit("vtt"))


def mime_type(extension: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in MIME_TYPES.items() for x in kv)), F.lower(extension)), F.lit("application/octet-stream"))


def data_path(root: str, collection: Column, segment: Column) -> Column:
    return F.concat_ws("/", F.lit(root), F.lit("Data"), collection, segment)


def first_prefix(line: Column, tags: list[str]) -> Column:
    """The longest of the tags that the line begins with."""
    out = F.lit(None).cast("string")
    for t in sorted(tags, key=len):
        out = F.when(F.startswith(line, F.lit(t)), t).otherwise(out)
    return out


def vocabulary_match(value: Column, words: list[str]) -> Column:
    """A controlled word that the value begins, without regard to case; 'and' counts as '&', and on a second try commas don't
    count. The first listed wins."""
    v = F.regexp_replace(F.lower(F.trim(value)), r"\band\b", "&")
    loose = F.replace(v, F.lit(","), F.lit(""))
    out = F.lit(None).cast("string")
    for w in reversed(words):
        out = F.when(F.startswith(F.lit(w.lower().replace(",", "")), loose), w).otherwise(out)
    for w in reversed(words):
        out = F.when(F.startswith(F.lit(w.lower()), v), w).otherwise(out)
    return F.when(v != "", out)


def year_and_decade(value: Column) -> Column:
    """(year, decade) of a resolved date text: a year if it is four digits, the decade of either form; NULL where it is no such
    text."""
    ok = value.rlike("^[12][0-9]{3}s?$")
    return F.struct(F.when(ok & (F.length(value) == 4), value).alias("year"), F.when(ok, F.concat(F.substring(value, 1, 3), F.lit("0"))).alias("decade"))


def elapsed_text(seconds: int) -> str:
    """Hours, minutes and seconds in words, the units that are zero left out."""
    parts = [(seconds // 3600, "hour"), (seconds // 60 % 60, "minute"), (seconds % 60, "second")]
    return ", ".join(f"{n} {u}{'' if n == 1 else 's'}" for n, u in parts if n) or "0 seconds"


def wrapped(text: str, width: int) -> list[str]:
    """Report text in lines of at most `width` characters; a longer word has a line of its own."""
    lines: list[str] = []
    for word in text.split():
        if lines and len(lines[-1]) + 1 + len(word) <= width:
            lines[-1] += f" {word}"
        else:
            lines.append(word)
    return lines
