"""Line deduplication by site-relative frequency.

For each host the share of its pages that hold a line is the number of pages
with the line over the number of the host's pages. A line with a share over
``ratio`` on at least ``min_pages`` pages is boilerplate there and goes from all
pages of that host; the same line on another host is judged by that host alone.

Lines are counted by the MD5 of the trimmed line, once for a page, and summed
before the shuffle. The boilerplate of a host fits one array: no more lines can
have a share over ``ratio`` than the host's mean number of lines on a page over
``ratio``. So pages are joined to arrays by host, with no shuffle of lines, and
a hot host's pages may be split or the arrays broadcast as Spark sees fit.

DataFrame functions only.

Defined cases: blank lines are neither counted nor dropped; a page with a null
host or null text is returned as it is (a null text has no lines); repeated rows
count as pages of their own; a page may be left with an empty text, never
dropped; an empty table gives an empty result; other columns pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize


def _key(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(line).cast("binary")))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(pages: DataFrame, host: Column, text_col: str = "text", ratio: float = 0.2, min_pages: int = 5) -> DataFrame:
    """(host, keys): the boilerplate line keys of every host that has any."""
    rows = pages.select(host.alias("host"), F.col(f"`{text_col}`").alias("text")).where("host is not null")
    filled = F.filter(_lines(F.col("text")), lambda x: F.trim(x) != "")
    held = rows.where("text is not null").select("host", F.explode(F.array_distinct(F.transform(filled, _key))).alias("key"))
    often = held.groupBy("host", "key").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    total = rows.groupBy("host").agg(F.count("*").alias("total"))
    return (
        materialize(often, "lines")
        .join(materialize(total, "hosts"), "host")
        .where(F.col("pages") > ratio * F.col("total"))
        .groupBy("host")
        .agg(F.collect_set("key").alias("keys"))
    )


def drop_boilerplate(
    pages: DataFrame, host: Column, text_col: str = "text", ratio: float = 0.2, min_pages: int = 5, counts: bool = False
) -> DataFrame:
    """``pages`` without boilerplate lines in ``text_col``; ``counts`` adds n_lines and n_dropped."""
    found = materialize(boilerplate(pages, host, text_col, ratio, min_pages), "boilerplate")
    h, k, site = fresh(pages, "host", "keys", "site")
    found = found.select(F.col("host").alias(h), F.col("keys").alias(k))
    rows = pages.withColumn(site, host)
    lines = _lines(F.col(f"`{text_col}`"))
    kept = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(k, _key(x)))
    joined = rows.join(found, F.col(site) == F.col(h), "left")
    text = F.when(F.col(k).isNull(), F.col(f"`{text_col}`")).otherwise(F.array_join(kept, "\n"))
    columns = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in pages.columns]
    if counts:
        n = F.when(F.col(f"`{text_col}`").isNull(), 0).otherwise(F.size(lines))
        left = F.when(F.col(k).isNull() | F.col(f"`{text_col}`").isNull(), n).otherwise(F.size(kept))
        columns += [n.cast("long").alias("n_lines"), (n - left).cast("long").alias("n_dropped")]
    return joined.select(*columns)


def host_of(url: Column) -> Column:
    """Host of a URL, lower case; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1)), F.lit(""))


def page_lines(html: Column) -> Column:
    """Visible text of a page with a line for each block element."""
    text = F.regexp_replace(html, r"(?is)<(?:script\b.*?</script>|style\b.*?</style>|!--.*?-->)", "")
    text = F.regexp_replace(text, r"(?i)</?(?:p|br|div|li|ul|ol|tr|table|h[1-6]|nav|article|section|header|footer|title|body|head|html|blockquote|pre)\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    return F.trim(F.regexp_replace(text, r"[ \t]*\n[ \t\n]*", "\n"))
