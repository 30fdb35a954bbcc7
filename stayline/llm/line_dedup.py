"""Line dedup by site-relative frequency.

A line's frequency is the number of a host's pages that hold it, divided by all pages of the host. Lines above the
boilerplate ratio are taken out of that host's pages; the same line stays on hosts where it is rare.

Defined results: a null text stays null and has no lines; an empty text has none either. Blank lines are never
boilerplate and stay where they are. A line counts once per row however often it is repeated in it; repeated rows count
as pages of their own. A null host is a host like any other. Columns of the input keep their names and order, whatever
they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import documents, settle_small, sha_hex
from stayline.llm.registry import query

RATIO = 0.1  # lines on more than this share of a host's pages go
MIN_PAGES = 3  # and on at least so many pages, or every line of a small host would


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _is_text(line: Column) -> Column:
    return F.trim(line) != ""


def boilerplate_lines(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO,
                      min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line_md5, pages, host_pages) of the lines above the ratio.

    A host has at most (mean distinct lines per page) / ratio of them, however many pages it has. Counting combines in
    the map tasks, so a line on every page of a large host is one row per task.
    """
    pages = docs.select(F.col(f"`{host}`").alias("host"), F.col(f"`{text}`").alias("text"))
    lines = pages.select("host", F.explode(F.array_distinct(F.filter(_lines(F.col("text")), _is_text))).alias("line"))
    counted = lines.groupBy("host", F.md5(F.col("line").cast("binary")).alias("line_md5")).agg(F.count("*").alias("pages"))
    totals = pages.groupBy(F.col("host").alias("of")).agg(F.count("*").alias("host_pages"))
    return (counted.where(F.col("pages") >= min_pages)
            .join(settle_small(totals), F.col("host").eqNullSafe(F.col("of")))
            .where(F.col("pages") > F.lit(ratio) * F.col("host_pages"))
            .select("host", "line_md5", "pages", "host_pages"))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES) -> DataFrame:
    """(row, kept, n_lines, n_removed): the input row as a struct, its text without boilerplate, and line counts.

    The lines to drop are gathered per host; texts are shuffled only when there are too many hosts to broadcast.
    """
    found = boilerplate_lines(docs, host, text, ratio, min_pages).groupBy(F.col("host").alias("of")).agg(
        F.collect_list("line_md5").alias("bad"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    body = F.col("row").getField(text)
    joined = rows.join(settle_small(found, 10_000), F.col("row").getField(host).eqNullSafe(F.col("of")), "left")
    lines = F.coalesce(_lines(body), F.array().cast("array<string>"))
    kept = F.filter(lines, lambda x: ~(_is_text(x) & F.array_contains("bad", F.md5(x.cast("binary")))))
    texts = joined.select(
        "row", F.size(F.filter(lines, _is_text)).alias("n_lines"),
        F.when(F.col("bad").isNotNull() & body.isNotNull(), F.array_join(kept, "\n")).otherwise(body).alias("kept"))
    after = F.size(F.filter(F.coalesce(_lines(F.col("kept")), F.array().cast("array<string>")), _is_text))
    return texts.select("row", "kept", "n_lines", (F.col("n_lines") - after).alias("n_removed"))


# DuckDB's trim(x, ' ') and Spark's trim both take spaces only
OP1_SQL = f"""
with l as (select source, doc_id, unnest(list_distinct(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> ''))) line
           from documents),
n as (select source, count(*) host_pages from documents group by source),
bad as (select source, list(line) bad from (
          select l.source, line, count(*) pages, any_value(host_pages) host_pages
          from l join n on l.source is not distinct from n.source group by l.source, line)
        where pages >= {MIN_PAGES} and pages > {RATIO} * host_pages group by source),
s as (select doc_id, coalesce(string_split(text, chr(10)), []) lines, text, bad
      from documents d left join bad b on d.source is not distinct from b.source),
k as (select doc_id, text, bad, list_filter(lines, lambda x: trim(x, ' ') <> '') filled,
             list_filter(lines, lambda x: trim(x, ' ') = '' or not coalesce(list_contains(bad, x), false)) kept from s)
select doc_id, cast(len(filled) as int) n_lines,
       cast(len(filled) - len(list_filter(kept, lambda x: trim(x, ' ') <> '')) as int) n_removed,
       case when text is not null then sha256(array_to_string(kept, chr(10))) end kept_sha256
from k
"""


@query("op1_line_dedup", OP1_SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its host's boilerplate lines: counts and digest of the kept text."""
    return drop_boilerplate(documents(spark, sf_dir).select("doc_id", "source", "text")).select(
        "row.doc_id", "n_lines", "n_removed", sha_hex("kept").alias("kept_sha256"))
