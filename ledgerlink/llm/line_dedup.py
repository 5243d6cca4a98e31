"""Boilerplate lines by their frequency within a site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.support import Scratch, first_of

#: The hashes of the frequent lines of all hosts are broadcast up to this size, which
#: is measured; beyond it they are joined by host.
BROADCAST_BYTES = 8_000_000

#: Tags that end a line of a page, and parts of a page that are not text.
_BLOCK = (
    "address|article|aside|blockquote|br|dd|div|dl|dt|figcaption|footer|form|h[1-6]|"
    "header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul|head|body|html"
)


def page_lines(html: Column | str) -> Column:
    """The text of a page with one line for each block element; null stays null.

    Scripts, styles and comments go, other tags become blanks, and line ends of the
    source are blanks.  Everything is a built-in expression.
    """
    text = F.translate(html, "\n\r\t\f", "    ")
    text = F.regexp_replace(
        text, r"(?i)<script\b.*?</script\s*+>|<style\b.*?</style\s*+>|<!--.*?-->|<!doctype[^>]*+>", ""
    )
    text = F.regexp_replace(text, rf"(?i) *+</?+(?:{_BLOCK})\b[^>]*+>", "\n")
    text = F.regexp_replace(text, r"<[^>]*+>", " ")
    for entity, sign in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"),
                         ("nbsp", " "), ("amp", "&")):
        text = F.replace(text, F.lit(f"&{entity};"), F.lit(sign))
    return F.regexp_replace(text, r"\n[ \n]*+", "\n")


def host_of(url: Column | str) -> Column:
    """The host of an address in lower case, without user and port; else null."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*+://(?:[^/?#@]*+@)?([^/?#:@]++)", 1)
    return F.nullif(F.lower(found), F.lit(""))


def _lines(text: Column | str) -> Column:
    return F.split(text, "\n")


def _line_hash(line: Column) -> Column:
    """What makes lines equal: blanks at their ends do not count."""
    return F.xxhash64(F.trim(line))


def frequent_lines(
    scratch: Scratch, pages: DataFrame, ratio: float, host_col: str, text_col: str
) -> DataFrame:
    """``_site`` and ``_frequent``, the hashes of its boilerplate lines, if it has any.

    The hashes of the lines of each page are written once.  What is shuffled is one row
    of host and two numbers per page and line; counts are summed per task first.
    """
    listed = scratch.store(
        pages.where(F.col(host_col).isNotNull() & F.col(text_col).isNotNull()).select(
            F.col(host_col).alias("_site"),
            F.xxhash64(text_col).alias("_page"),
            F.array_distinct(F.transform(_lines(text_col), _line_hash)).alias("_lines"),
        )
    )
    lines = listed.select("_site", "_page", F.explode("_lines").alias("_line")).where(
        F.col("_line") != F.xxhash64(F.lit(""))
    )
    once = lines.distinct()
    totals = once.select("_site", "_page").distinct().groupBy("_site").agg(
        F.count(F.lit(1)).alias("_total")
    )
    counts = once.groupBy("_site", "_line").agg(F.count(F.lit(1)).alias("_n"))
    return (
        counts.where(F.col("_n") > 1)
        .join(totals, "_site")
        .where(F.col("_n") > F.col("_total") * F.lit(ratio))
        .groupBy("_site").agg(F.collect_list("_line").alias("_frequent"))
    )


def drop_site_lines(
    pages: DataFrame,
    ratio: float = 0.05,
    host_col: str = "host",
    text_col: str = "text",
) -> DataFrame:
    """``pages`` with its texts freed of boilerplate lines, ``n_lines``, ``n_dropped`` and
    ``emptied``.

    A line goes if more than ``ratio`` of its host's pages contain it.  A line of a single
    page repeats nowhere and is no boilerplate, however few pages its host has.  Pages of
    one host with equal text are one page, and a line that a page repeats counts once, so
    copies make no line boilerplate; texts without any line are no pages.  Lines are equal
    if they are without the blanks at their ends; they are told apart by 64-bit hashes.

    A text of nothing but such lines is left without any: ``emptied`` is true and the text
    is what blank lines are left of it, so that the caller may take it out, or keep it as
    it was.  Blank lines and lines of a null host are never dropped.  Null text stays null
    with 0 lines, the empty text has one.  Kept lines stay as they are.  Repeated rows are
    treated alike, no rows give no rows, and all columns of ``pages`` are handed on,
    whatever their names; the three others get underscores if their names are taken.
    """
    n_lines, n_dropped, emptied = (
        first_of(pages, c) for c in ("n_lines", "n_dropped", "emptied")
    )
    scratch = Scratch(pages.sparkSession, "lines")
    frequent = scratch.store(frequent_lines(scratch, pages, ratio, host_col, text_col))
    held = frequent.agg(F.sum(F.size("_frequent") * 8 + F.length("_site") + 16)).first()[0] or 0
    if held <= BROADCAST_BYTES:
        frequent = F.broadcast(frequent)
    rows = pages.select(
        F.struct("*").alias("_row"), F.col(host_col).alias("_site"),
        F.col(text_col).alias("_text"),
    )
    joined = rows.join(frequent, "_site", "left").withColumn(
        "_lines", F.when(F.col("_text").isNotNull(), _lines("_text"))
    )
    kept = joined.withColumn(
        "_kept",
        F.when(F.col("_frequent").isNull(), F.col("_lines")).otherwise(
            F.filter("_lines", lambda x: ~F.array_contains("_frequent", _line_hash(x)))
        ),
    )
    dropped = F.coalesce(F.size("_lines") - F.size("_kept"), F.lit(0))
    content = F.exists("_kept", lambda x: F.trim(x) != "")
    return kept.select(
        *(
            F.array_join("_kept", "\n").alias(c) if c == text_col
            else F.col("_row").getField(c).alias(c)
            for c in pages.columns
        ),
        F.coalesce(F.size("_lines"), F.lit(0)).alias(n_lines),
        dropped.alias(n_dropped),
        F.coalesce((dropped > 0) & ~content, F.lit(False)).alias(emptied),
    )
