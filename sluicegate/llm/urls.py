"""URL filters by temporal list join: dated list entries become validity intervals, and each capture is judged by the
entries active when it was fetched.

A list says when a pattern (a host, or a host with a path prefix) was put on it, with what action, and when it was taken
off. A capture looks for its host, the host's parent domains and its path prefixes; the longest active pattern decides.
Intervals and captures meet by (pattern, period of time), so a host with a third of all captures is spread over periods
and what is left of the skew can be split by the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Length of the periods by which intervals and captures meet.
PERIOD_DAYS = 30
#: Path segments that ``patterns_of`` gives below a host if nothing else is asked for.
PATH_DEPTH = 3


def host_of(url: Column) -> Column:
    """Lower-case host without user, port, a leading ``www.`` or a final dot; NULL if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    bare = F.regexp_replace(F.regexp_replace(host, r"^www[.]", ""), r"[.]+$", "")
    return F.when(bare != "", bare)


def path_of(url: Column) -> Column:
    """Path of a URL as it is written, without query and fragment."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def patterns_of(url: Column, path_depth: int = PATH_DEPTH) -> Column:
    """Patterns that would cover a URL: host and parent domains, and the host with up to ``path_depth`` path segments."""
    labels = F.split(host_of(url), "[.]")
    first = F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1)))
    domains = F.transform(first, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.filter(F.split(path_of(url), "/"), lambda p: p != "")
    depth = F.least(F.size(parts), F.lit(path_depth))
    lengths = F.when(depth > 0, F.sequence(F.lit(1), depth)).otherwise(F.array().cast("array<int>"))
    paths = F.transform(lengths, lambda n: F.concat_ws("/", host_of(url), F.array_join(F.slice(parts, 1, n), "/")))
    return F.when(host_of(url).isNotNull(), F.array_distinct(F.concat(domains, paths)))


def plain_pattern(pattern: Column) -> Column:
    """A list's pattern as ``patterns_of`` spells it: bare lower-case host, then the path's segments without empty ones."""
    parts = F.filter(F.split(pattern, "/"), lambda p: p != "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.get(parts, F.lit(0))), r"^www[.]", ""), r"[.]+$", "")
    return F.array_join(F.concat(F.array(host), F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1)))), "/")


def validity(entries: DataFrame) -> DataFrame:
    """``pattern``, ``action``, ``valid_from`` and ``valid_to`` (NULL: still open) of the list ``entries``.

    ``entries`` has ``pattern``, ``action`` (block, allow or remove) and ``at``. An entry holds until the pattern's next
    one; of entries of one pattern and time the last by name of action holds. Entries with a NULL are left out. Patterns are
    told apart, and returned, as ``plain_pattern`` spells them.
    """
    sound = entries.select(plain_pattern(entries["pattern"]).alias("pattern"), "action", "at").dropna()
    one = sound.groupBy("pattern", "at").agg(F.max("action").alias("action"))
    following = F.lead("at").over(Window.partitionBy("pattern").orderBy("at"))
    spans = one.select("pattern", "action", F.col("at").alias("valid_from"), following.alias("valid_to"))
    return spans.filter("action <> 'remove'")


def period(at: Column) -> Column:
    return F.floor(F.unix_micros(at) / F.lit(PERIOD_DAYS * 86_400_000_000)).cast("long")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Per row of ``captures`` (``page_id``, ``url``, ``fetched_at``): ``blocked``, ``pattern``, ``action``, ``valid_from``.

    The decisive entry is the active one of longest pattern (the greater by name among equally long ones); without any the
    three last columns are NULL and the page is not blocked. NULL or hostless URLs and NULL times: not blocked. Repeated
    rows: each is judged. Paths are looked up as deep as the list has any. Empty tables: no rows, or nothing blocked. Other columns are not read.
    """
    segments = F.size(F.split(plain_pattern(F.col("pattern")), "/")) - 1
    deepest = entries.filter("pattern IS NOT NULL").agg(F.max(segments).alias("n")).first()["n"] or 0
    sure = captures.select("url", "fetched_at").filter("url IS NOT NULL AND fetched_at IS NOT NULL").distinct()
    looked = sure.select("url", "fetched_at", F.explode(patterns_of(F.col("url"), deepest)).alias("pattern"))
    looked = looked.withColumn("period", period(F.col("fetched_at")))
    ends = captures.agg(F.max(period(F.col("fetched_at"))).alias("last")).first()["last"]
    last = F.least(F.coalesce(period(F.col("valid_to")), F.lit(ends)), F.lit(ends))
    spans = validity(entries).withColumn("first", period(F.col("valid_from"))).withColumn("last", last).filter("first <= last")
    listed = spans.select("*", F.explode(F.sequence("first", "last")).alias("period")).drop("first", "last")
    met = looked.join(listed, ["pattern", "period"]).filter(
        "fetched_at >= valid_from AND (valid_to IS NULL OR fetched_at < valid_to)"
    )
    entry = F.struct("pattern", "action", "valid_from")
    best = met.groupBy("url", "fetched_at").agg(F.max(F.struct(F.length("pattern").alias("n"), entry.alias("entry"))).alias("best"))
    found = best.select(F.col("url").alias("u"), F.col("fetched_at").alias("f"), "best.entry.*")
    rows = captures.select("page_id", "url", "fetched_at")
    joined = rows.join(found, (rows["url"] == found["u"]) & (rows["fetched_at"] == found["f"]), "left").drop("u", "f")
    return joined.withColumn("blocked", F.coalesce(F.col("action") == "block", F.lit(False)))
