"""URL lists as of the time of each capture, with column functions only.

A list is a history of dated entries: a pattern was added or removed. A pattern is a
domain (it covers its subdomains) or a host with a path (it covers what lies below).
Between an addition and the next removal it is active, and a capture is judged by the
entries active when it was fetched, an addition at that very moment included.

Histories are cut into months, of which only those that have captures of the list and key are
looked at: the state that such a month begins with is carried in from the last entry
before it. Captures and entries of one list, key and month are merged
in the order of time, and the last state before a capture holds. Captures of a key
are dealt over salts, as many as their number asks for, and its entries repeated for each salt that has captures, so that a host with a
third of all captures is many groups, and no capture is paired with more than one
state per list and key.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import saved

URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"
SALTS = 16  # at least
PER_SALT = 1_000_000  # captures of the table for each salt


def host_of(url: Column) -> Column:
    """Lower-case host without a leading www. and a trailing dot; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, URL, 1)), r"^www\.|\.$", "")


def path_of(url: Column) -> Column:
    """Segments of the path, joined by one slash each."""
    return F.array_join(F.filter(F.split(F.regexp_extract(url, URL, 2), "/"), lambda s: s != ""), "/")


def url_keys(url: Column, depth: int) -> Column:
    """All patterns that could cover a URL: its host and parent domains, and its path prefixes of up to `depth` segments."""
    labels = F.split(host_of(url), r"\.")
    steps = F.split(path_of(url), "/")
    domains = F.transform(labels, lambda x, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    below = F.filter(F.transform(steps, lambda s, i: F.when((s != "") & (i < depth), F.concat_ws("/", host_of(url), F.array_join(F.slice(steps, 1, i + 1), "/")))),
                     lambda k: k.isNotNull())
    return F.when(host_of(url) != "", F.array_distinct(F.concat(domains, below)))


def entry_key(pattern: Column) -> Column:
    """A pattern in the form of `url_keys`."""
    host = F.regexp_replace(F.lower(F.substring_index(pattern, "/", 1)), r"^www\.|\.$", "")
    rest = F.array_join(F.filter(F.slice(F.split(pattern, "/"), 2, F.size(F.split(pattern, "/"))), lambda s: s != ""), "/")
    return F.when(rest != "", F.concat_ws("/", host, rest)).otherwise(host)


def changes(entries: DataFrame) -> DataFrame:
    """(list, key, at, active): every moment at which a pattern is added or removed."""
    return (entries.where("list is not null and pattern is not null and at is not null and action in ('add', 'remove')")
            .select("list", entry_key(F.col("pattern")).alias("key"), "at", (F.col("action") == "add").alias("active")).where("key <> ''")
            .groupBy("list", "key", "at").agg(F.max("active").alias("active")))


def states(known: DataFrame, months: DataFrame) -> DataFrame:
    """(list, key, month, at, carried, active) for the given (list, key, month): their changes, and what the month begins with where that is active."""
    dated = known.withColumn("month", F.date_trunc("month", "at"))
    last = dated.groupBy("list", "key", "month").agg(F.max_by("active", "at").alias("active"))
    # a month that is asked for stands before its own changes
    both = (months.select("list", "key", "month", F.lit(0).alias("turn"), F.lit(None).cast("boolean").alias("active"))
            .union(last.select("list", "key", "month", F.lit(1), "active")))
    order = Window.partitionBy("list", "key").orderBy("month", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = (both.withColumn("now", F.last("active", ignorenulls=True).over(order)).where("turn = 0 and now")
               .select("list", "key", "month", F.col("month").alias("at"), F.lit(True).alias("carried"), F.lit(True).alias("active")))
    own = dated.join(months, ["list", "key", "month"], "left_semi").select("list", "key", "month", "at", F.lit(False), "active")
    return carried.union(own)


def judged(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched_at", *, salts: int | None = None) -> DataFrame:
    """All rows and columns of `captures` with `lists`: names of the lists that cover the URL at its time, sorted.

    `entries` has list, pattern, action ('add' or 'remove') and at (a timestamp). Of an addition and a removal at one
    moment the addition holds. A `lists` column of `captures` is replaced.

    Null, relative or empty URLs and null times are on no list. Entries with a null or another action are ignored.
    Repeated captures are judged once and each come back; repeated entries change nothing. Empty tables: no rows, or no
    lists. URLs of any length are taken whole; path prefixes go as deep as the deepest pattern.
    """
    deepest = entries.agg(F.max(F.size(F.split(entry_key(F.col("pattern")), "/")) - 1)).first()[0] or 0
    capture = F.when(F.col(url).isNotNull() & F.col(at).isNotNull(), F.md5(F.concat_ws("|", F.unix_micros(at).cast("string"), F.col(url))))
    kept = F.struct(*[F.col(f"`{c}`") for c in captures.columns if c.lower() != "lists"])
    rows = captures.select(kept.alias("__row"), capture.alias("__capture"), F.col(url).alias("u"), F.col(at).cast("timestamp").alias("at"))
    known = changes(entries)
    seen = rows.where("__capture is not null").select("__capture", "u", "at").dropDuplicates(["__capture"])
    salts = salts or max(SALTS, rows.count() // PER_SALT)
    salt = F.pmod(F.xxhash64("__capture"), F.lit(salts)).cast("int").alias("salt")
    probes = seen.select("__capture", "at", salt, F.explode(url_keys(F.col("u"), deepest)).alias("key"))
    # only keys that some list has go on, once for each of these lists; a hot key is as many pairs as it has salts
    listed = known.select("list", "key").distinct().join(probes.select("key", "salt").distinct(), "key")
    probes = probes.join(listed, ["key", "salt"]).select("list", "key", F.date_trunc("month", "at").alias("month"), "salt", "at", "__capture")
    groups = saved(probes.select("list", "key", "month", "salt").distinct(), "url-months")
    asked = probes.select("list", "key", "month", "salt", "at", F.lit(2).alias("turn"), F.lit(None).cast("boolean").alias("active"), "__capture")
    told = (states(known, groups.select("list", "key", "month").distinct()).join(groups, ["list", "key", "month"])
            .select("list", "key", "month", "salt", "at", F.when(F.col("carried"), 0).otherwise(1).alias("turn"), "active", F.lit(None).cast("string").alias("__capture")))
    merged = asked.union(told)
    order = Window.partitionBy("list", "key", "month", "salt").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = merged.withColumn("now", F.last("active", ignorenulls=True).over(order)).where("turn = 2 and now")
    found = hits.groupBy("__capture").agg(F.array_sort(F.collect_set("list")).alias("__lists"))
    return rows.join(found, "__capture", "left").select("__row.*", F.coalesce("__lists", F.array().cast("array<string>")).alias("lists"))


def _draw(key: Column, place: int, n: int) -> Column:
    return F.conv(F.substring(F.md5(key), place, 6), 16, 10).cast("long") % n


START = 1704067200  # 2024-01-01, the first day of the histories made from the hosts
DAY = 86400


def made_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time, as the table has none: a moment of two years that the id's digest draws."""
    second = F.lit(START) + _draw(F.col("page_id").cast("string"), 1, 730) * DAY + _draw(F.col("page_id").cast("string"), 7, DAY)
    return pages.select("page_id", "url", F.timestamp_seconds(second).alias("fetched_at"))


def made_entries(pages: DataFrame) -> DataFrame:
    """Dated entries of three lists, drawn from the digests of the hosts: added, removed and added again."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    host = F.col("host")
    labels = F.split(host, r"\.")
    domain = F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 2), 3), ".")
    kinds = hosts.select("host", F.explode(F.array(
        F.struct(F.lit("domains").alias("list"), domain.alias("pattern"), F.lit(3).alias("one_in")),
        F.struct(F.lit("hosts").alias("list"), host.alias("pattern"), F.lit(4).alias("one_in")),
        F.struct(F.lit("paths").alias("list"), F.concat(host, F.lit("/en")).alias("pattern"), F.lit(2).alias("one_in")))).alias("k"))
    drawn = kinds.select("k.*").distinct().where(_draw(F.concat("list", "pattern"), 1, 1 << 20) % F.col("one_in") == 0)
    first = _draw(F.concat("list", "pattern"), 7, 400)
    gap = _draw(F.concat("list", "pattern"), 13, 200) + 1
    return drawn.select("list", "pattern", F.explode(F.array(
        F.struct(F.lit("add").alias("action"), first.alias("day")), F.struct(F.lit("remove").alias("action"), (first + gap).alias("day")),
        F.struct(F.lit("add").alias("action"), (first + gap * 2).alias("day")))).alias("e")
    ).select("list", "pattern", "e.action", F.timestamp_seconds(F.lit(START) + F.col("e.day") * DAY).alias("at"))


def op9_query(spark, sf_dir: str) -> DataFrame:
    """The lists that cover each page at its fetch time."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    done = judged(made_captures(pages), made_entries(pages))
    return done.select("page_id", F.unix_seconds("fetched_at").alias("fetched_s"), F.array_join("lists", ",").alias("lists"), (F.size("lists") > 0).alias("blocked"))


def _sql_draw(key: str, place: int, n) -> str:
    return f"(('0x' || substr(md5({key}), {place}, 6))::BIGINT % {n})"


OP9_SQL = rf"""
WITH u_pages AS (
  SELECT page_id, url, {START} + {_sql_draw("page_id::VARCHAR", 1, 730)} * {DAY} + {_sql_draw("page_id::VARCHAR", 7, DAY)} AS fetched_s,
         regexp_replace(lower(regexp_extract(url, '{URL}', 1)), '^www\.|\.$', '', 'g') AS host,
         list_filter(string_split(regexp_extract(url, '{URL}', 2), '/'), lambda s: s <> '') AS steps
  FROM pages),
u_hosts AS (SELECT DISTINCT host, string_split(host, '.') AS labels FROM u_pages WHERE host <> ''),
u_kinds AS (
  SELECT DISTINCT * FROM (
    SELECT 'domains' AS list, array_to_string(labels[greatest(1, len(labels) - 2):], '.') AS pattern, 3 AS one_in FROM u_hosts
    UNION ALL SELECT 'hosts', host, 4 FROM u_hosts
    UNION ALL SELECT 'paths', host || '/en', 2 FROM u_hosts)),
u_drawn AS (SELECT list, pattern, {_sql_draw("list || pattern", 7, 400)} AS first, {_sql_draw("list || pattern", 13, 200)} + 1 AS gap
            FROM u_kinds WHERE {_sql_draw("list || pattern", 1, 1 << 20)} % one_in = 0),
u_spans AS (
  SELECT list, pattern, {START} + first * {DAY} AS begin_s, {START} + (first + gap) * {DAY} AS end_s FROM u_drawn
  UNION ALL SELECT list, pattern, {START} + (first + 2 * gap) * {DAY}, NULL FROM u_drawn),
u_found AS (
  SELECT DISTINCT p.page_id, p.url, s.list FROM u_pages p JOIN u_spans s
  ON (p.host = s.pattern OR ends_with(p.host, '.' || s.pattern) OR (len(steps) > 0 AND s.pattern = p.host || '/' || steps[1]))
  AND p.fetched_s >= s.begin_s AND (s.end_s IS NULL OR p.fetched_s < s.end_s) AND p.host <> ''),
u_lists AS (SELECT page_id, url, string_agg(list, ',' ORDER BY list) AS lists FROM u_found GROUP BY page_id, url)
SELECT p.page_id, p.fetched_s::BIGINT AS fetched_s, coalesce(l.lists, '') AS lists, l.lists IS NOT NULL AS blocked
FROM u_pages p LEFT JOIN u_lists l ON p.page_id = l.page_id AND p.url = l.url"""
