"""Column expressions. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NOT_PROVIDED = "Not provided"
RETRY_CODES = (429, 500, 501, 502, 503, 504)

_NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def server_name(url: Column) -> Column:
    """Network location of a URL: user, host and port as written. Empty without one; null for null. Leading control characters and blanks are skipped, TAB, CR and LF ignored."""
    clean = F.translate(F.regexp_replace(url, r"^[\x00-\x20]+", ""), "\t\r\n", "")
    return F.regexp_extract(clean, _NETLOC, 1)


def stable_id(*parts: Column) -> Column:
    """An id in UUID form that is a function of the parts alone, so it survives retries and later runs."""
    h = F.sha2(F.concat_ws("\x01", *[F.coalesce(F.concat(F.lit("v"), p.cast("string")), F.lit("n")) for p in parts]), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))


def is_given(text: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(text, F.lit("")) != ""


def or_placeholder(text: Column) -> Column:
    return F.when(is_given(text), text).otherwise(F.lit(NOT_PROVIDED))


def is_license_full(license: Column, source: Column, title: Column) -> Column:
    return is_given(license) & is_given(source) & is_given(title)


def eol_source_id(content_id: Column, page_id: Column) -> Column:
    return F.concat_ws("_", content_id, page_id)


def first_threshold(amount: Column, rules: dict[int, int]) -> Column:
    """Value of the largest threshold that ``amount`` reaches; null below all of them."""
    out = F.lit(None).cast("int")
    for threshold in sorted(rules):
        out = F.when(amount >= threshold, F.lit(rules[threshold])).otherwise(out)
    return out


def modulo_or_zero(value: Column, by: Column) -> Column:
    return F.coalesce(value % F.nullif(by, F.lit(0)), F.lit(0))


def target_size(height: Column, width: Column, limit: int) -> Column:
    """``[height, width]`` within the limit, aspect kept and truncated; sizes within it stay."""
    h, w = height.cast("double"), width.cast("double")
    scaled = F.when(h > w, F.array(F.lit(limit).cast("long"), F.floor(w * (limit / h)))).otherwise(F.array(F.floor(h * (limit / w)), F.lit(limit).cast("long")))
    return F.when((height > limit) | (width > limit), scaled).otherwise(F.array(height.cast("long"), width.cast("long")))


def min_side_below(size: Column, threshold: float) -> Column:
    """Null for a null or empty size: such a row isn't too small."""
    return F.array_min(size) < threshold


def pixels_intact(image: Column, size: Column, md5: Column) -> Column:
    """Hash and length of raw 3-channel pixels agree with what is stored. False where anything is null."""
    h, w = F.get(size, 0), F.get(size, 1)
    return F.coalesce((F.md5(image) == md5) & (F.octet_length(image) == h * w * 3) & (h > 0) & (w > 0), F.lit(False))


def error_class(code: Column) -> Column:
    """What an error code stands for: an HTTP status, or -1 request failure, -2 undecodable content."""
    named = F.when(code == -1, "request").when(code == -2, "content").when(code == 429, "rate limit")
    return named.when(code.between(500, 599), "server").when(code.between(400, 499), "client").otherwise("other")


def is_retried(code: Column) -> Column:
    return F.coalesce(code.isin(*RETRY_CODES) | (code == -1), F.lit(False))


def padded(number: Column, width: int = 4) -> Column:
    return F.when(F.length(number.cast("string")) >= width, number.cast("string")).otherwise(F.lpad(number.cast("string"), width, "0"))
