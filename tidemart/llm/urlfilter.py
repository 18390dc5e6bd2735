"""URL filters as of the fetch date: a log of dated list changes decides each capture.

The log says on which day an entry (a domain with all below it, or a host with the first
segments of its path, however many) was added to or removed from the block or the allow list;
of several changes of one entry on a day the last (largest ``seq``) counts. An entry's changes
make validity intervals, from each addition to the next removal, and a capture is judged by the
entries whose interval holds its fetch date: the most specific one decides, on a tie the allow
list, and without any the capture is unlisted and stays.

Plan, DataFrame functions only: captures are first reduced to the distinct (host, path, day),
the path cut to the depth of the deepest entry, and those to the distinct (entry, day) they
could match, so a host with a third of all captures counts once a day. Changes are reduced to
one row per entry and day before they become intervals, so an entry has at most one interval
in two days, however often it is named. The as-of join is one on the entry with the day between
the interval's ends; its result is joined back by (entry, day) and (host, path, day).

Defined results: a null url or one without a host is ``invalid`` and not kept; a capture
without a date matches no entry; repeated rows yield a row each; changes without an entry
or a day are ignored, and so are unknown lists and actions; empty tables give unlisted
captures or an empty result. A path ends at its first empty segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import table, written

HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
SEGMENT = r"^[^/?#]*://[^/?#]*/([^/?#]+)"
PATH = r"^[^/?#]*://[^/?#]*/([^?#]*)"
#: The end of an interval that is still valid.
OPEN_END = "9999-12-31"


def host(url: Column) -> Column:
    return F.rtrim(F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), HOST, 1), F.lit("."))


def segment(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), SEGMENT, 1)


def path(url: Column, depth: int) -> Column:
    """The first ``depth`` segments of the path, up to an empty one, joined by slashes."""
    segments = F.slice(F.split(F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1), "/", depth + 1), 1, depth)
    blank = F.array_position(segments, "")
    return F.array_join(F.when(blank > 0, F.slice(segments, 1, F.greatest(blank - 1, F.lit(0)).cast("int"))).otherwise(segments), "/")


def entries_of(host_: Column, path_: Column) -> Column:
    """(rank, entry) of all that could list a capture: its domains, shortest first, and its
    host with one segment of the path, two, and so on."""
    labels, segments = F.split(host_, r"\."), F.split(path_, "/")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
        i.alias("rank"), F.array_join(F.slice(labels, n - i + 1, i), ".").alias("entry")))
    paths = F.transform(F.sequence(F.lit(1), F.size(segments)), lambda i: F.struct(
        (n + i).alias("rank"), F.concat(host_, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")).alias("entry")))
    return F.when(path_ != "", F.concat(domains, paths)).otherwise(domains)


def depth_of(changes: DataFrame) -> int:
    """Segments of the path of the deepest entry."""
    return int(changes.agg(F.max(F.size(F.split("entry", "/")) - 1)).first()[0] or 0)


def daily(changes: DataFrame) -> DataFrame:
    """entry, day, block, allow: the last change (true: added) of each entry on a day."""
    known = changes.filter(F.col("entry").isNotNull() & F.col("day").isNotNull()
                           & F.col("list").isin("block", "allow") & F.col("action").isin("add", "remove"))
    last = lambda name: F.max(F.when(F.col("list") == name, F.struct("seq", F.col("action") == "add")))
    both = known.groupBy("entry", "day").agg(last("block").alias("b"), last("allow").alias("a"))
    return both.select("entry", "day", F.col("b")["col2"].alias("block"), F.col("a")["col2"].alias("allow"))


def intervals(changes: DataFrame) -> DataFrame:
    """list, entry, valid_from, valid_to (exclusive; null: still valid) of a log of changes."""
    flat = daily(changes).select("entry", "day", F.explode(F.create_map(F.lit("block"), "block", F.lit("allow"), "allow"))
                                 .alias("list", "added")).filter("added IS NOT NULL")
    by = Window.partitionBy("list", "entry").orderBy("day")
    turns = flat.withColumn("was", F.lag("added").over(by)).filter("was IS NULL OR was <> added")
    spans = turns.withColumn("valid_to", F.lead("day").over(by)).filter("added")
    return spans.select("list", "entry", F.col("day").alias("valid_from"), "valid_to")


def as_of(probes: DataFrame, spans: DataFrame) -> DataFrame:
    """(entry, day, allow) of the ``probes`` (entry, day) that an interval of ``spans`` holds;
    allow: whether one of the allow list does."""
    until = F.coalesce("valid_to", F.lit(OPEN_END).cast("date"))
    spans = spans.select(F.col("entry").alias("_entry"), "valid_from", until.alias("valid_to"),
                         (F.col("list") == "allow").alias("allow"))
    held = probes.join(spans.hint("merge"), (F.col("entry") == F.col("_entry"))
                       & (F.col("day") >= F.col("valid_from")) & (F.col("day") < F.col("valid_to")))
    return held.groupBy("entry", "day").agg(F.max("allow").alias("allow"))


def evaluate(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """``captures`` (url, fetch_date, any id columns) with decision (blocked, allowed,
    unlisted, invalid), the entry that decides, and kept. ``changes``: list, entry, day,
    action, seq."""
    spark = captures.sparkSession
    deepest = depth_of(changes)
    placed = captures.withColumns({"_host": host(F.col("url")),
                                   "_path": path(F.col("url"), deepest) if deepest else F.lit("")})
    kinds = (placed.filter("_host <> '' AND fetch_date IS NOT NULL").select("_host", "_path", F.col("fetch_date").alias("day"))
             .distinct())
    wanted = kinds.select("*", F.inline(entries_of(F.col("_host"), F.col("_path"))))
    active = written(spark, as_of(wanted.select("entry", "day").distinct(), intervals(changes)), "url-active")
    # these tables compress to a fraction of their size in memory, so the planner's size check
    # would broadcast far more than it assumes: sort-merge joins, whose skew Spark splits
    found = (wanted.join(active.hint("merge"), ["entry", "day"]).groupBy("_host", "_path", "day")
             .agg(F.max(F.struct("rank", "allow", "entry")).alias("_best"))
             .select(F.col("_host").alias("_h"), F.col("_path").alias("_p"), F.col("day").alias("_d"), "_best"))
    found = written(spark, found, "url-found")
    joined = placed.join(found.hint("merge"), (F.col("_host") == F.col("_h")) & (F.col("_path") == F.col("_p"))
                         & (F.col("fetch_date") == F.col("_d")), "left")
    decision = (F.when(F.col("_host") == "", "invalid").when(F.col("_best").isNull(), "unlisted")
                .when(F.col("_best.allow"), "allowed").otherwise("blocked"))
    return (joined.withColumn("decision", decision).withColumn("entry", F.col("_best.entry"))
            .withColumn("kept", F.col("decision").isin("unlisted", "allowed"))
            .drop("_host", "_path", "_h", "_p", "_d", "_best"))


DAYS = 730
FIRST_DAY = "2024-01-01"


def day_of(number: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod(number, F.lit(DAYS)).cast("int"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Every page as a capture; the tables have no fetch time, so a page's id gives its day."""
    return pages.select("page_id", "url", day_of(F.col("page_id") * 7919 + 11).alias("fetch_date"))


def changes_of(pages: DataFrame) -> DataFrame:
    """Every page as one change of the lists: its id tells what about its url is listed
    (host, parent domain, host and segment), on which list, from which day, and whether
    that is an addition or a removal."""
    n, h, s = F.col("page_id"), host(F.col("url")), segment(F.col("url"))
    parent = F.when(F.size(F.split(h, r"\.")) > 2, F.regexp_replace(h, r"^[^.]*\.", "")).otherwise(h)
    kind = F.pmod(n, F.lit(4))
    entry = F.when(kind == 1, parent).when((kind == 2) & (s != ""), F.concat(h, F.lit("/"), s)).otherwise(h)
    return pages.filter(h != "").select(
        F.when(F.pmod(n, F.lit(5)) < 3, "block").otherwise("allow").alias("list"), entry.alias("entry"),
        day_of(n * 104729 + 17).alias("day"),
        F.when(F.pmod(n, F.lit(3)) < 2, "add").otherwise("remove").alias("action"), n.alias("seq"))


def op8_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url")
    return evaluate(captures_of(pages), changes_of(pages)).select("page_id", "fetch_date", "decision", "entry", "kept")


#: The same in DuckDB's SQL, with intervals and a range join.
OP8_SQL = r"""
WITH p AS (SELECT page_id, url,
    rtrim(regexp_extract(lower(coalesce(url, '')), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '.') AS host,
    regexp_extract(coalesce(url, ''), '^[^/?#]*://[^/?#]*/([^/?#]+)', 1) AS seg,
    DATE '2024-01-01' + ((page_id * 7919 + 11) % 730)::INTEGER AS fetch_date FROM pages),
log AS (SELECT CASE WHEN page_id % 5 < 3 THEN 'block' ELSE 'allow' END AS list,
    CASE WHEN page_id % 4 = 1 AND len(string_split(host, '.')) > 2 THEN regexp_replace(host, '^[^.]*\.', '')
         WHEN page_id % 4 = 2 AND seg <> '' THEN host || '/' || seg ELSE host END AS entry,
    DATE '2024-01-01' + ((page_id * 104729 + 17) % 730)::INTEGER AS day,
    page_id % 3 < 2 AS added, page_id AS seq FROM p WHERE host <> ''),
daily AS (SELECT list, entry, day, arg_max(added, seq) AS added FROM log GROUP BY list, entry, day),
spans AS (SELECT list, entry, added, day AS valid_from,
    lead(day) OVER (PARTITION BY list, entry ORDER BY day) AS valid_to FROM daily),
k AS (SELECT DISTINCT host, seg, fetch_date FROM p WHERE host <> ''),
l AS (SELECT *, string_split(host, '.') AS labels FROM k),
c AS (SELECT host, seg, fetch_date, i AS rank, array_to_string(labels[len(labels) - i + 1:], '.') AS entry
      FROM (SELECT *, unnest(range(1, len(labels) + 1)) AS i FROM l)
      UNION ALL SELECT host, seg, fetch_date, len(labels) + 1, host || '/' || seg FROM l WHERE seg <> ''),
a AS (SELECT c.host, c.seg, c.fetch_date, c.rank, c.entry, bool_or(s.list = 'allow') AS allow
      FROM c JOIN spans s ON s.entry = c.entry AND s.added AND s.valid_from <= c.fetch_date
        AND (s.valid_to IS NULL OR c.fetch_date < s.valid_to)
      GROUP BY ALL),
b AS (SELECT host, seg, fetch_date, arg_max(allow, rank) AS allow, arg_max(entry, rank) AS entry FROM a GROUP BY ALL)
SELECT p.page_id, p.fetch_date,
  CASE WHEN p.host = '' THEN 'invalid' WHEN b.entry IS NULL THEN 'unlisted' WHEN b.allow THEN 'allowed' ELSE 'blocked' END AS decision,
  b.entry, p.host <> '' AND (b.entry IS NULL OR b.allow) AS kept
FROM p LEFT JOIN b ON b.host = p.host AND b.seg = p.seg AND b.fetch_date = p.fetch_date
"""
