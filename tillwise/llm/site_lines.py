"""Line dedup by site-relative frequency: lines on too many pages of their host are dropped.

All of it is DataFrame functions. Page counts per (host, line digest) are combined before the
shuffle. A line above the ratio takes more than that share of its host's pages, so a host has
at most (mean distinct lines per page) / ratio of them: the list each page is held against is
small whatever the size of the host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.staging import stage

#: A line on more than this share of its host's pages is boilerplate ...
RATIO = 0.2
#: ... if the host has this many pages at least and the line is on this many.
LEAST_PAGES = 5
#: A source of documents is far wider than a host: there a line on this smaller share goes as
#: well, if it is on as many documents as SOURCE_LEAST.
SOURCE_RATIO, SOURCE_LEAST = 0.07, 20

#: Script, style and comments go; any other tag ends a line. Also used in the SQL.
HIDDEN = r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->"
TAG = r"(?s)<[^>]*>"
BLANK = r"[ \t\x0B\f\r]+"


def page_lines(html: Column) -> Column:
    """Text lines of a page: runs of text between tags, blanks collapsed, empty ones left out."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "\n"), TAG, "\n")
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, BLANK, " "))), lambda x: x != "")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def digest(line: Column) -> Column:
    return F.unhex(F.md5(F.encode(line, "UTF-8")))


def boilerplate(lined: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES, wide: tuple[float, int] | None = None) -> DataFrame:
    """Per ``host`` the digests of its boilerplate lines, from rows of ``host, lines``.

    ``wide`` has a second ratio and a least count of pages; a line above either ratio is listed.
    """
    totals = lined.groupBy(F.col("host").alias("of")).agg(F.count("*").alias("pages"))
    seen = lined.select("host", F.explode(F.array_distinct(F.transform("lines", digest))).alias("line"))
    counts = seen.groupBy("host", "line").agg(F.count("*").alias("on"))
    # Few lines are common; the rare ones need not meet the totals.
    often = counts.filter(F.col("on") >= least_pages).join(totals, F.col("host").eqNullSafe(F.col("of")))
    above = (F.col("pages") >= least_pages) & (F.col("on") > F.lit(ratio) * F.col("pages"))
    if wide:
        above |= (F.col("on") >= wide[1]) & (F.col("on") > F.lit(wide[0]) * F.col("pages"))
    often = often.filter(above)
    # Written, so that the join behind it knows its size and can split a host with very many pages.
    return stage(often.groupBy("host").agg(F.collect_set("line").alias("dropped")), "site-lines")


def drop_lines(lined: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Rows with ``host, lines``: adds ``kept`` (lines that stay) and ``n_dropped``.

    Every copy of a boilerplate line goes. Null lines count as none; a null host is a host of
    its own; repeated rows are pages of their own; further columns stay.
    """
    lined = lined.withColumn("lines", F.coalesce("lines", F.array().cast("array<string>")))
    found = boilerplate(lined.select("host", "lines"), ratio, least_pages).withColumnRenamed("host", "__host").withColumnRenamed("dropped", "__dropped")
    both = lined.join(found, F.col("host").eqNullSafe(F.col("__host")), "left")
    kept = F.when(F.col("__dropped").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains("__dropped", digest(x)))
    )
    return both.withColumn("kept", kept).withColumn("n_dropped", (F.size("lines") - F.size("kept")).cast("long")).drop("__host", "__dropped")


def clean_pages(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Pages (page_id, url, html) to page_id, host, n_lines, n_dropped and the text that stays."""
    lined = pages.select("page_id", host_of(F.col("url")).alias("host"), page_lines(F.col("html")).alias("lines"))
    out = drop_lines(lined, ratio, least_pages)
    return out.select(
        "page_id", "host", F.size("lines").cast("long").alias("n_lines"), "n_dropped", F.array_join("kept", "\n").alias("text")
    )


def clean_documents(docs: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Documents with their source as host: columns stay, text and n_chars are of what is kept.

    A line goes by the rule of pages, or if it is on SOURCE_LEAST documents of its source and
    on more than SOURCE_RATIO of them; copies of a document count as documents.
    Lines are split at line feeds and compared as they are; empty lines are kept. A document
    that had text and keeps none but white space goes; null and empty texts stay as they are.
    """
    names = docs.columns
    lined = docs.select(
        F.struct(*names).alias("__row"), F.col("source").alias("host"), F.filter(F.split("text", "\n", -1), lambda x: F.trim(x) != "").alias("lines")
    )
    found = boilerplate(lined.select("host", F.coalesce("lines", F.array().cast("array<string>")).alias("lines")), ratio, least_pages, (SOURCE_RATIO, SOURCE_LEAST))
    found = found.select(F.col("host").alias("__host"), F.col("dropped").alias("__dropped"))
    both = lined.join(found, F.col("host").eqNullSafe(F.col("__host")), "left")
    stay = F.filter(F.split("__row.text", "\n", -1), lambda x: ~F.array_contains("__dropped", digest(x)))
    text = F.when(F.col("__dropped").isNull(), F.col("__row.text")).otherwise(F.array_join(stay, "\n"))
    both = both.withColumn("__text", text).filter(F.col("lines").isNull() | (F.size("lines") == 0) | (F.trim(F.translate("__text", "\n\t\r", "   ")) != ""))
    changed = {"text": F.col("__text"), "n_chars": F.when(F.col("__text").isNull(), F.col("__row.n_chars")).otherwise(F.length("__text").cast("long")) if "n_chars" in names else None}
    return both.select(*[changed[c].alias(c) if changed.get(c) is not None else F.col(f"__row.{c}").alias(c) for c in names])


ORACLE = rf"""
WITH lined AS (
  SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)) AS host,
    list_filter(list_transform(string_split(regexp_replace(regexp_replace(coalesce(html, ''), '{HIDDEN}', chr(10), 'g'), '{TAG}', chr(10), 'g'), chr(10)),
      lambda x: trim(regexp_replace(x, '{BLANK}', ' ', 'g'))), lambda x: x <> '') AS lines,
    row_number() OVER () AS r
  FROM pages),
totals AS (SELECT host, count(*) AS pages FROM lined GROUP BY host),
seen AS (SELECT host, unnest(list_distinct(lines)) AS line FROM lined),
often AS (
  SELECT host, line FROM (SELECT host, line, count(*) AS n FROM seen GROUP BY ALL) JOIN totals USING (host)
  WHERE n >= {LEAST_PAGES} AND pages >= {LEAST_PAGES} AND n > {RATIO} * pages),
numbered AS (SELECT r, page_id, host, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM lined),
kept AS (
  SELECT r, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n
  FROM numbered ANTI JOIN often USING (host, line) GROUP BY r)
SELECT page_id, host, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - coalesce(n, 0) AS BIGINT) AS n_dropped, coalesce(text, '') AS text
FROM lined LEFT JOIN kept USING (r)
"""
