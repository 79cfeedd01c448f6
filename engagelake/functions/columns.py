"""Reusable expressions: predicates, normalisation, hashing, bins, ladders, formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- predicates ---


def has_access(deactivated: Column, closed: Column, can_access: Column) -> Column:
    """Not deactivated, and open or accessible; unknown flags count as open."""
    return deactivated.isNull() & (~F.coalesce(closed, F.lit(False)) | F.coalesce(can_access, F.lit(False)))


def stale(seen: Column, as_of: Column, seconds: int) -> Column:
    """Never seen, or strictly before the moment ``seconds`` ago."""
    return seen.isNull() | (seen < as_of - F.expr(f"INTERVAL {seconds} SECOND"))


def untouched(run: Column, this_run: Column, nulls: bool) -> Column:
    """Rows of another run; rows without a run only if ``nulls``."""
    out = run != this_run
    return out | run.isNull() if nulls else F.coalesce(out, F.lit(False))


# --- text ---

# What is struck out of messages, and what stands instead.
SECRETS = (r"(?i)(access_token|token|password)=([^&\s]+)", r"postgresql(?:\+asyncpg)?://[^\s]+")
STRUCK = "[СКРЫТО]"


def strip(text: Column) -> Column:
    """Without white space at both ends, any white space of Unicode."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def keyword_identity(text: Column) -> Column:
    """Equal for keywords that differ in case, white space or e with dots only."""
    return F.regexp_replace(F.translate(F.lower(strip(text)), "ё", "е"), r"(?U)\s+", " ")


def masked(text: Column, limit: int = 2000) -> Column:
    """Keys with their values, and whole database addresses, are struck out, then the text is cut."""
    for pattern in SECRETS:
        text = F.regexp_replace(text, pattern, STRUCK)
    return F.left(text, F.lit(limit))


def content_hash(text: Column, published: Column, edited: Column) -> Column:
    """SHA-256 of text, date and edit date with NUL between; a missing one prints as None."""
    none = F.lit("None")
    return F.sha2(F.concat_ws("\0", F.coalesce(text, F.lit("")), F.coalesce(published.cast("string"), none), F.coalesce(edited.cast("string"), none)),
        256)


def html_escape(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def bytes_text(n: Column) -> Column:
    """Bytes in the largest unit that gives at least 1; a decimal only beyond MiB."""
    k = 1024.0
    out = F.format_string("%.1f TiB", n / k**4)
    for power, unit in ((4, "GiB"), (3, "MiB"), (2, "KiB"), (1, "B")):
        value = n / k ** (power - 1)
        text = F.format_string(f"%.{1 if unit == 'GiB' else 0}f {unit}", value)
        out = F.when(n < k**power, text).otherwise(out)
    return out


def uptime_text(seconds: Column) -> Column:
    s = seconds.cast("long")
    return F.concat(F.floor(s / 86400).cast("string"), F.lit(" d "), F.floor(s % 86400 / 3600).cast("string"), F.lit(" h"))


def page_address(screen_name: Column, number: Column) -> Column:
    return F.concat(F.lit("https://example.org/"), F.coalesce(F.nullif(strip(screen_name), F.lit("")),
        F.concat(F.lit("club"), number.cast("string"))))


# --- numbers ---


def hash_rank(text: Column, modulus: int = 1_000_000_000) -> Column:
    """SHA-256 of the text as one 256-bit number, modulo ``modulus``: folded 32 bits at a time."""
    h = F.sha2(text, 256)
    words = F.array(*(F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long") for i in range(8)))
    shift = (1 << 32) % modulus
    return F.aggregate(words, F.lit(0).cast("long"), lambda acc, w: (acc * shift + w) % modulus)


def three_bins(x: Column, low: Column | float, high: Column | float) -> Column:
    return F.when(x <= low, "low").when(x <= high, "mid").otherwise("high")


def percent(part: Column, whole: Column) -> Column:
    """Share of 100; nothing of nothing is all of it."""
    return F.when(whole == 0, 100.0).otherwise(F.try_divide(part * 100.0, whole))


def percent_bucket(part: Column, whole: Column) -> Column:
    """Tens of whole percent, 100 at most, 0 of nothing."""
    return F.when(whole == 0, 0).otherwise(F.floor(F.least(F.lit(100), F.floor(part * 100 / F.greatest(whole, F.lit(1)))) / 10) * 10).cast("long")


def pages_needed(rows: Column, size: int) -> Column:
    return F.expr("0") + F.ceil(rows / F.lit(float(size))).cast("long")


#: Seconds to wait after the first to fifth failed attempt.
RETRY_SECONDS = (60, 300, 900, 3600, 21600)


def retry_delay(attempt: Column, durable: Column) -> Column:
    """The ladder, then doubling up to a day for durable work; others get none."""
    ladder = F.element_at(F.array(*map(F.lit, RETRY_SECONDS)), F.greatest(F.least(attempt, F.lit(5)), F.lit(1)).cast("int"))
    doubled = F.least(F.lit(86400), F.lit(21600) * F.pow(F.lit(2), F.least(F.lit(2), attempt - 5)).cast("int"))
    return F.when(attempt <= 5, ladder).when(durable, doubled)


def cooldown(hits: Column, first: int = 30, most: int = 3600) -> Column:
    """Doubles with each hit since the last success."""
    return F.least(F.lit(most), (F.lit(first) * F.pow(F.lit(2.0), F.least(hits, F.lit(20)) - 1)).cast("long"))


def modality(text: Column, photo: Column, video: Column) -> Column:
    """What a post shows; photo with video counts as all three even without text."""
    return (
        F.when(photo & video, "trimodal").when(text & video, "text_video").when(text & photo, "text_image")
        .when(video, "video_only").when(photo, "image_only").when(text, "text_only").otherwise("empty")
    )


def epoch_moment(seconds: Column) -> Column:
    return F.when(seconds > 0, F.timestamp_seconds(seconds).cast("timestamp_ntz"))


# --- vectors ---


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column, least: float = 1e-12) -> Column:
    n = F.greatest(norm(v), F.lit(least))
    return F.transform(v, lambda x: x.cast("double") / n)


def counter(raw: Column, name: str) -> Column:
    """The count of a counter {name: {count: n}} of a JSON text; 0 where it is missing, no object or no whole number."""
    text = F.get_json_object(raw, f"$.{name}.count")
    return F.when(text.rlike(r"^-?\d{1,18}$"), text.try_cast("bigint")).otherwise(0)
