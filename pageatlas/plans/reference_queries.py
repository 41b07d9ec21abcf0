"""A query for each operator of the pipeline over the test tables, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pageatlas.config import Enrich
from pageatlas.functions import page
from pageatlas.functions.url import authority, base_url, host, raw_object_key, url_key
from pageatlas.functions.vector import cosine, doubles, mean_pool
from pageatlas.operators import directory, enrich, fetchlog, snapshots, topics, versions, viewagg
from pageatlas.session import numbered, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


# --- A: tables ------------------------------------------------------------------------------------


@query("SELECT run_id, url, fetched_at, status, etag, error FROM (SELECT DISTINCT * FROM fetches WHERE run_id IS NOT NULL)")
def a9_read_fetch_log(spark, sf_dir):
    """The log as parts of a store, one by hour of the day, each with columns of its own, read again by name."""
    from pageatlas.schemas import SCHEMAS
    from pageatlas.session import scratch
    from pageatlas.sources.store import Store

    store = Store(spark, scratch(spark))
    log = table(spark, sf_dir, "fetches").distinct().where("run_id is not null")
    early = F.coalesce(F.substring("fetched_at", 12, 2) < "12", F.lit(True))
    store.append("fetches", log.where(early).withColumn("status", F.col("status").cast("int")).drop("bytes"), "early")
    store.append("fetches", log.where(~early).withColumn("note", F.lit("x")), "late")
    return store.read_parts("fetches", SCHEMAS["fetches"]).select("run_id", "url", "fetched_at", "status", "etag", "error")


@query("""WITH runs AS (SELECT DISTINCT run_id FROM fetches WHERE raw_object_key IS NOT NULL), mid AS (SELECT quantile_disc(run_id, 0.5) AS m FROM runs)
SELECT DISTINCT raw_object_key FROM fetches, mid WHERE raw_object_key IS NOT NULL AND run_id >= m
AND raw_object_key NOT IN (SELECT raw_object_key FROM fetches, mid WHERE raw_object_key IS NOT NULL AND run_id < m)""")
def a13_raw_objects_to_store(spark, sf_dir):
    """Objects that the later half of the runs has to write, the earlier half having written its own."""
    f = table(spark, sf_dir, "fetches").where("raw_object_key is not null")
    w = Window.orderBy("run_id")  # a row per run
    runs = f.where("run_id is not null").select("run_id").distinct()
    half = runs.withColumn("place", F.row_number().over(w)).crossJoin(F.broadcast(runs.agg(F.count("*").alias("n")))).where("place = ceil(n * 0.5)").select(F.col("run_id").alias("m"))
    both = f.crossJoin(F.broadcast(half))  # one row
    return fetchlog.missing_raw(both.where("run_id >= m").select("raw_object_key").distinct(), both.where("run_id < m").select("raw_object_key"))


# --- B: directory -----------------------------------------------------------------------------------

_LINE = ["name", "city", "state", "country", "created", "updated", "checked", "url"]
_PARSED_SQL = r"""
WITH lines AS (
  SELECT snapshot_date || '/' || delivery AS file, line_no, list_transform(string_split(concat_ws(chr(9), coalesce(name,''), coalesce(city,''), coalesce(state,''),
    coalesce(country,''), coalesce(created,''), coalesce(updated,''), coalesce(checked,''), coalesce(url,'')), chr(9)),
    lambda x: regexp_replace(x, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS f FROM (SELECT DISTINCT * FROM directory_snapshots)),
parsed AS (
  SELECT file, f[8] AS url, arg_min(f, line_no) AS f, min(line_no) AS line_no FROM lines
  WHERE len(f) >= 8 AND regexp_matches(f[-1], '^https?://') GROUP BY file, f[8])
"""


def _lines(spark, sf_dir):
    s = table(spark, sf_dir, "directory_snapshots").distinct()
    line = F.concat_ws("\t", *[F.coalesce(c, F.lit("")) for c in _LINE])
    return s.select(F.concat_ws("/", "snapshot_date", F.col("delivery").cast("string")).alias("file"), "line_no", line.alias("line"))


@query(_PARSED_SQL + "SELECT file, line_no, f[1] AS name, f[2] AS city, f[3] AS state, f[4] AS country, f[5] AS created, f[6] AS updated, f[7] AS checked, url FROM parsed")
def b1_parse_directory(spark, sf_dir):
    return directory.parse_directory(_lines(spark, sf_dir))


def _two_days(spark, sf_dir):
    rows = directory.parse_directory(_lines(spark, sf_dir))
    return rows.where("file = '2026-01-04/1'"), rows.where("file = '2026-01-11/1'")


@query(_PARSED_SQL + """
SELECT coalesce(c.url, p.url) AS url, CASE WHEN p.url IS NULL THEN 'new' WHEN c.url IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM (SELECT * FROM parsed WHERE file = '2026-01-04/1') p FULL JOIN (SELECT * FROM parsed WHERE file = '2026-01-11/1') c ON p.url = c.url
WHERE p.url IS NULL OR c.url IS NULL OR p.f[1:4] <> c.f[1:4]""")
def b3_diff_snapshots(spark, sf_dir):
    return directory.diff_snapshots(*_two_days(spark, sf_dir))


@query("SELECT DISTINCT url, 'p_' || substr(sha1(url), 1, 12) AS person_id FROM people WHERE url IS NOT NULL")
def b4_person_id(spark, sf_dir):
    return table(spark, sf_dir, "people").where("url is not null").select("url", directory.person_id(F.col("url")).alias("person_id")).distinct()


def _numbered_people(spark, sf_dir):
    people = numbered(table(spark, sf_dir, "people").distinct(), "place", "valid_from", "url", "person_id")
    return people.withColumn("seq", F.col("place") + 1).drop("place")


_FOLD = "replace(lower({0}), 'ß', 'ss')"
_PEOPLE_SQL = ", ppl AS (SELECT *, row_number() OVER (ORDER BY valid_from, url, person_id) AS seq FROM (SELECT DISTINCT * FROM people)), cur AS (SELECT f, line_no, url FROM parsed WHERE file = '2026-01-04/1')"


@query(_PARSED_SQL + _PEOPLE_SQL + f""",
fate AS (
  SELECT p.seq, p.person_id, p.url, c.f, CASE WHEN c.url IS NULL THEN 'removed' WHEN [p.name, p.city, p.state, p.country] IS DISTINCT FROM c.f[1:4] THEN 'changed' END AS fate
  FROM ppl p LEFT JOIN cur c ON p.url = c.url WHERE p.valid_to IS NULL),
fresh AS (SELECT *, {_FOLD.format('f[1]')} || chr(31) || {_FOLD.format('f[2]')} AS place FROM cur WHERE url NOT IN (SELECT url FROM ppl WHERE valid_to IS NULL)),
by_url AS (SELECT url, arg_max(person_id, seq) AS by_url FROM ppl GROUP BY url),
by_place AS (SELECT {_FOLD.format("name")} || chr(31) || {_FOLD.format("city")} AS place, arg_max(person_id, seq) AS by_place FROM ppl GROUP BY 1),
given AS (
  SELECT f, line_no, fresh.url, coalesce(last_value(by_url IGNORE NULLS) OVER w, by_place, 'p_' || substr(sha1(first_value(fresh.url) OVER w), 1, 12)) AS person_id
  FROM fresh LEFT JOIN by_url USING (url) LEFT JOIN by_place USING (place)
  WINDOW w AS (PARTITION BY place ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT person_id, name, url, city, state, country, valid_from, CASE WHEN fate IS NOT NULL THEN '2026-01-04' ELSE valid_to END AS valid_to
FROM ppl LEFT JOIN (SELECT seq, fate FROM fate WHERE fate IS NOT NULL) USING (seq)
UNION ALL SELECT person_id, f[1], url, f[2], f[3], f[4], '2026-01-04', NULL FROM fate WHERE fate = 'changed'
UNION ALL SELECT person_id, f[1], url, f[2], f[3], f[4], '2026-01-04', NULL FROM given""")
def b10_update_people(spark, sf_dir):
    people = _numbered_people(spark, sf_dir)
    return directory.update_people(people, _two_days(spark, sf_dir)[0], "2026-01-04").drop("block", "pos")


@query(_PARSED_SQL + _PEOPLE_SQL + """, was AS (SELECT url, [name, city, state, country] AS w FROM ppl WHERE valid_to IS NULL)
SELECT DISTINCT CASE WHEN was.url IS NULL THEN 'new' WHEN cur.url IS NULL THEN 'removed' ELSE 'changed' END AS change, coalesce(was.url, cur.url) AS url
FROM was FULL JOIN cur ON was.url = cur.url WHERE was.url IS NULL OR cur.url IS NULL OR w IS DISTINCT FROM cur.f[1:4]""")
def b12_applied_changes(spark, sf_dir):
    return directory.applied_changes(table(spark, sf_dir, "people").distinct(), _two_days(spark, sf_dir)[0])


def _all_days(spark, sf_dir):
    """Every day's parsed rows of its highest delivery, and the days."""
    days = snapshots.snapshot_days(table(spark, sf_dir, "directory_snapshots"))
    s = table(spark, sf_dir, "directory_snapshots").distinct().join(F.broadcast(days.select(F.col("day").alias("snapshot_date"), F.col("delivery").alias("highest"))), "snapshot_date")  # a row per day
    line = F.concat_ws("\t", *[F.coalesce(c, F.lit("")) for c in _LINE])
    lines = s.where(F.coalesce("delivery", F.lit(-1)) == F.col("highest")).select(F.col("snapshot_date").alias("file"), "line_no", line.alias("line"))
    return directory.parse_directory(lines).withColumnRenamed("file", "day"), days


@query(_PARSED_SQL.replace("WITH lines", "WITH days AS (SELECT snapshot_date AS day, snapshot_date || '/' || max(delivery) AS file, lead(snapshot_date) OVER (ORDER BY snapshot_date) AS next_day FROM directory_snapshots GROUP BY snapshot_date), lines") + """,
recs AS (SELECT day, next_day, url, f[1:4] AS attrs FROM parsed JOIN days USING (file))
SELECT coalesce(c.day, p.next_day) AS snapshot_date, coalesce(c.url, p.url) AS url, CASE WHEN p.url IS NULL THEN 'new' WHEN c.url IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM (SELECT * FROM recs WHERE next_day IS NOT NULL) p FULL JOIN (SELECT * FROM recs WHERE day > (SELECT min(day) FROM days)) c ON p.next_day = c.day AND p.url = c.url
WHERE p.url IS NULL OR c.url IS NULL OR p.attrs <> c.attrs""")
def b3_all_days(spark, sf_dir):
    return directory.diff_days(*_all_days(spark, sf_dir))


@query(None)
def b10_all_days(spark, sf_dir):
    people = _numbered_people(spark, sf_dir)
    return directory.update_people_daily(people, _all_days(spark, sf_dir)[0])


@query("SELECT DISTINCT person_id, url FROM people WHERE valid_to IS NULL")
def b6_open_rows(spark, sf_dir):
    return table(spark, sf_dir, "people").where("valid_to is null").select("person_id", "url").distinct()


# --- C: fetch log -----------------------------------------------------------------------------------

_HOST = r"lower(regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^(?:.*@)?(\[[^\]]*\]|[^:]*)', 1))"


@query(f"""SELECT DISTINCT url, split_part(url, '#', 1) AS base, {_HOST} AS host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS netloc, sha1(url) AS url_key FROM fetches WHERE url IS NOT NULL""")
def c2_url_parts(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "fetches").where("url is not null").select("url", base_url(u).alias("base"), host(u).alias("host"), authority(u).alias("netloc"), url_key(u).alias("url_key")).distinct()


_DENY = f"""WITH hosts AS (SELECT DISTINCT {_HOST} AS h FROM people WHERE url IS NOT NULL),
deny AS (SELECT h AS entry FROM hosts WHERE substr(sha1(h), 1, 1) = '0' UNION ALL SELECT 'test' UNION ALL SELECT DISTINCT upper(url) FROM people WHERE substr(sha1(url), 1, 2) = 'aa'),
urls AS (SELECT DISTINCT url, {_HOST} AS h FROM people WHERE url IS NOT NULL),
denied AS (SELECT url, bool_or(lower(entry) = lower(url) OR lower(entry) = lower(split_part(url, '#', 1)) OR h = lower(entry) OR ends_with(h, '.' || lower(entry))) AS denied FROM urls, deny GROUP BY url)
"""


def _deny(spark, sf_dir):
    u = F.col("url")
    people = table(spark, sf_dir, "people").where("url is not null").select("url").distinct()
    hosts = people.select(host(u).alias("entry")).distinct().where(F.substring(F.sha1("entry"), 1, 1) == "0")
    some = people.where(F.substring(F.sha1("url"), 1, 2) == "aa").select(F.upper("url").alias("entry"))
    return people, hosts.unionByName(some).unionByName(spark.createDataFrame([("test",), ("  ",)], "entry string"))


@query(_DENY + "SELECT url, denied FROM denied")
def c4_denied(spark, sf_dir):
    return fetchlog.is_denied(*_deny(spark, sf_dir))


@query(_DENY + "SELECT url, split_part(url, '#', 1) AS base, bool_or(denied) OVER (PARTITION BY split_part(url, '#', 1)) AS denied FROM denied")
def c8_denied_groups(spark, sf_dir):
    return fetchlog.deny_groups(*_deny(spark, sf_dir))


_PRIORS = """WITH priors AS (SELECT url, etag, last_modified, content_hash, raw_object_key FROM (SELECT *, row_number() OVER (PARTITION BY url
  ORDER BY fetched_at DESC, run_id DESC NULLS LAST, etag DESC NULLS LAST, last_modified DESC NULLS LAST, content_hash DESC NULLS LAST, raw_object_key DESC NULLS LAST) AS rn
  FROM fetches WHERE status IN (200, 304) AND content_hash IS NOT NULL) WHERE rn = 1)
"""


@query(_PRIORS + "SELECT * FROM priors")
def c5_priors(spark, sf_dir):
    return fetchlog.priors(table(spark, sf_dir, "fetches"))


@query("SELECT DISTINCT url FROM people WHERE valid_to IS NULL ORDER BY url LIMIT 50")
def c6_targets(spark, sf_dir):
    return fetchlog.targets(table(spark, sf_dir, "people"), 50)


@query("SELECT DISTINCT url FROM people WHERE coalesce(valid_to, '') = '' ORDER BY url")
def c6_all_targets(spark, sf_dir):
    return fetchlog.targets(table(spark, sf_dir, "people"))


@query("""WITH u AS (SELECT DISTINCT url FROM people WHERE url IS NOT NULL UNION SELECT DISTINCT url || '#now' FROM people WHERE url NOT LIKE '%#%')
SELECT split_part(url, '#', 1) AS base, list(url ORDER BY url) AS listed FROM u GROUP BY 1""")
def c7_fan_out(spark, sf_dir):
    u = table(spark, sf_dir, "people").where("url is not null").select("url").distinct()
    return fetchlog.fan_out(u.union(u.where("url not like '%#%'").select(F.concat("url", F.lit("#now")))))


@query(_PRIORS + """SELECT base, min(url) AS prior_url, arg_min(content_hash, url) AS content_hash
FROM (SELECT split_part(p.url, '#', 1) AS base, p.url, content_hash FROM (SELECT DISTINCT url FROM people) p JOIN priors USING (url)) GROUP BY base""")
def c9_chosen_priors(spark, sf_dir):
    return fetchlog.chosen_priors(table(spark, sf_dir, "people"), fetchlog.priors(table(spark, sf_dir, "fetches")))


_BODY = "CASE WHEN doc_id % 7 = 0 THEN '<META name=\"robots\" x content=''a, NoArchive''>' WHEN doc_id % 11 = 0 THEN '<meta content=\"noarchive\" name=\"robots\">' ELSE '<p>' END || coalesce(text, '')"
_ROBOTS = r"(?i)<meta[^>]+name=[\"''](?:robots|googlebot)[\"''][^>]*content=[\"''][^\"'']*noarchive"


def _pages(spark, sf_dir):
    i = F.col("doc_id")
    body = F.when(i % 7 == 0, "<META name=\"robots\" x content='a, NoArchive'>").when(i % 11 == 0, '<meta content="noarchive" name="robots">').otherwise("<p>")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(body, F.coalesce("text", F.lit(""))).alias("body"), F.get(F.array(*map(F.lit, (200, 304, 404, 503, 206))), (i % 5).cast("int")).alias("status"),
        F.get(F.array(F.lit("text/html; charset=utf-8"), F.lit("application/pdf"), F.lit(None), F.lit("application/XHTML+xml")), (i % 4).cast("int")).alias("kind"),
        F.when(i % 13 == 0, "NoArchive").alias("tag"),
    )


@query(f"""SELECT doc_id, CASE WHEN status = 304 THEN NULL WHEN status < 200 OR status >= 400 THEN 'http_' || status
  WHEN coalesce(kind, '') <> '' AND NOT (lower(kind) LIKE '%html%' OR lower(kind) LIKE '%text/%' OR lower(kind) LIKE '%xml%') THEN 'content_type'
  WHEN strlen(body) > 5000 THEN 'too_large' WHEN lower(coalesce(tag, '')) LIKE '%noarchive%' OR regexp_matches(substr(body, 1, 200000), '{_ROBOTS}') THEN 'noarchive' END AS error
FROM (SELECT doc_id, {_BODY} AS body, [200, 304, 404, 503, 206][doc_id % 5 + 1] AS status,
  ['text/html; charset=utf-8', 'application/pdf', NULL, 'application/XHTML+xml'][doc_id % 4 + 1] AS kind, CASE WHEN doc_id % 13 = 0 THEN 'NoArchive' END AS tag FROM documents)""")
def c14_classify_responses(spark, sf_dir):
    p = _pages(spark, sf_dir)
    return p.select("doc_id", fetchlog.response_error(F.col("status"), F.col("kind"), F.octet_length("body"), F.col("tag"), F.col("body"), 5000).alias("error"))


@query(f"SELECT doc_id, regexp_matches(substr({_BODY}, 1, 200000), '{_ROBOTS}') AS noarchive FROM documents")
def c15_noarchive(spark, sf_dir):
    return _pages(spark, sf_dir).select("doc_id", F.substring("body", 1, 200_000).rlike(fetchlog.NOARCHIVE).alias("noarchive"))


@query("SELECT DISTINCT url, content_hash, 'raw/' || substr(sha1(url), 1, 2) || '/' || sha1(url) || '/' || substr(content_hash, 1, 16) AS key FROM fetches WHERE url IS NOT NULL AND content_hash IS NOT NULL")
def c16_raw_object_key(spark, sf_dir):
    f = table(spark, sf_dir, "fetches").where("url is not null and content_hash is not null")
    return f.select("url", "content_hash", raw_object_key(F.col("url"), F.col("content_hash")).alias("key")).distinct()


_SKIP = "('robots', 'noarchive', 'denylist')"


@query(f"""WITH s AS (SELECT run_id, count(*) AS n, count(*) FILTER (error IN {_SKIP}) AS skipped, count(*) FILTER (error <> '' AND error NOT IN {_SKIP}) AS failed,
  count(*) FILTER (status = 304) AS not_modified FROM (SELECT DISTINCT * FROM fetches) GROUP BY run_id)
SELECT run_id, n - skipped AS attempted, n - skipped - failed - not_modified AS ok, not_modified, failed, skipped,
  CASE WHEN n > skipped THEN failed::DOUBLE / (n - skipped) ELSE 0.0 END AS failure_rate, (CASE WHEN n > skipped THEN failed::DOUBLE / (n - skipped) ELSE 0.0 END) <= 0.30 AS healthy FROM s""")
def c18_run_summary(spark, sf_dir):
    return fetchlog.run_summary(table(spark, sf_dir, "fetches").distinct())


@query(f"SELECT run_id, CASE WHEN error IN {_SKIP} THEN 'skip' ELSE 'fail' END AS kind, error, count(*) AS n FROM (SELECT DISTINCT * FROM fetches) WHERE error <> '' GROUP BY ALL")
def c21_error_reasons(spark, sf_dir):
    return fetchlog.error_reasons(table(spark, sf_dir, "fetches").distinct())


# --- D: versions ------------------------------------------------------------------------------------

_STAMPED = r"""(SELECT doc_id, coalesce(text, '') || chr(10) || chr(10) || chr(10) || CASE doc_id % 4 WHEN 0 THEN 'Last updated: March 2026' WHEN 1 THEN '  _This page was last modified on 3 March 2026_  '
  WHEN 2 THEN '1,234 visitors since' ELSE 'updated 2026-01-04 | 12 views' END || '   ' || chr(10) || 'end' AS t FROM documents)"""


def _stamped(spark, sf_dir):
    tail = F.get(F.array(*map(F.lit, ("Last updated: March 2026", "  _This page was last modified on 3 March 2026_  ", "1,234 visitors since", "updated 2026-01-04 | 12 views"))), (F.col("doc_id") % 4).cast("int"))
    text = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(text, F.lit("\n\n\n"), tail, F.lit("   \nend")).alias("t"))


@query(rf"""SELECT doc_id, regexp_replace(regexp_replace(array_to_string(list_filter(list_transform(regexp_split_to_array(t, '\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{{85}}\x{{2028}}\x{{2029}}]'), lambda x: rtrim(regexp_replace(x, '(?i)\b\d[\d,]*\s+(visitors?|views?|hits|visits)\b', '', 'g'))),
  lambda x: NOT regexp_matches(trim(x), '(?i)^[^\p{{L}}\p{{N}}_]*(this page was\s+)?(last\s+)?(updated|modified|edited)\b.{{0,60}}$')), chr(10)), '\n{{3,}}', chr(10) || chr(10), 'g'), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g') AS normal
FROM {_STAMPED}""")
def d4_normalize_text(spark, sf_dir):
    return _stamped(spark, sf_dir).select("doc_id", page.normalize(F.col("t")).alias("normal"))


@query(f"SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '2026-03-01' WHEN 1 THEN '2026-03-03' WHEN 3 THEN '2026-01-04' END AS stated FROM {_STAMPED} WHERE NOT regexp_matches(t, '(?i)(updated|modified|edited).*\\n.*(updated|modified|edited)')")
def d3_stated_date(spark, sf_dir):
    return _stamped(spark, sf_dir).select("doc_id", page.stated_date(F.col("t")).alias("stated"))


@query(None)
def d4_all_texts(spark, sf_dir):
    return _stamped(spark, sf_dir).select("doc_id", page.normalize(F.col("t")).alias("normal"))


@query(None)
def d3_all_texts(spark, sf_dir):
    return _stamped(spark, sf_dir).select("doc_id", page.stated_date(F.col("t")).alias("stated"))


@query("SELECT DISTINCT text_hash IS NOT DISTINCT FROM sha256(text_md) AS same, version_id, sha256(text_md) AS hashed FROM versions WHERE text_md IS NOT NULL")
def d5_text_hash(spark, sf_dir):
    v = table(spark, sf_dir, "versions").where("text_md is not null")
    hashed = page.text_hash(F.col("text_md"))
    return v.select("version_id", hashed.alias("hashed"), F.col("text_hash").eqNullSafe(hashed).alias("same")).distinct()


@query("""SELECT DISTINCT url, first_seen AS fetched_at, sha1(url || chr(0) || sha256(text_md) || chr(0) || first_seen) AS version_id, sha256(text_md) AS text_hash, length(text_md) < 200 AS needs_js
FROM versions WHERE text_md IS NOT NULL""")
def d7_version_rows(spark, sf_dir):
    v = table(spark, sf_dir, "versions").where("text_md is not null")
    return versions.new_version_rows(v.select("url", F.col("first_seen").alias("fetched_at"), F.col("text_md").alias("text")).distinct())


@query("SELECT url, arg_max(person_id, (coalesce(valid_from, ''), person_id)) AS person_id FROM people WHERE url IS NOT NULL GROUP BY url")
def d8_owner_by_url(spark, sf_dir):
    return versions.owner_by_url(table(spark, sf_dir, "people"))


_LATEST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY last_seen DESC, version_id DESC) AS rn FROM versions {0}) WHERE rn = 1)"
_READY = "WHERE text_md IS NOT NULL AND NOT coalesce(needs_js, false) AND length(text_md) > 0"


@query(f"SELECT url, version_id, last_seen FROM {_LATEST.format('')}")
def d9_latest_by_url(spark, sf_dir):
    return versions.latest_by_url(table(spark, sf_dir, "versions")).select("url", "version_id", "last_seen")


@query(f"""SELECT f.url, f.fetched_at, f.status, f.content_hash FROM (SELECT DISTINCT url, fetched_at, status, content_hash FROM fetches WHERE status IN (200, 304) AND content_hash IS NOT NULL) f
LEFT JOIN {_LATEST.format('')} v ON f.url = v.url WHERE v.url IS NULL OR f.fetched_at > v.last_seen""")
def d11_fetches_past_mark(spark, sf_dir):
    mark = versions.latest_by_url(table(spark, sf_dir, "versions")).select("url", F.col("last_seen").alias("mark"))
    f = fetchlog.usable(table(spark, sf_dir, "fetches")).select("url", "fetched_at", "status", "content_hash").distinct()
    return f.join(mark, "url", "left").where("mark is null or fetched_at > mark").drop("mark")


@query("""WITH u AS (SELECT DISTINCT url, fetched_at, run_id, status, content_hash FROM fetches WHERE status IN (200, 304) AND content_hash IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY fetched_at, run_id) AS rn FROM u),
o AS (SELECT *, CASE WHEN status <> 304 OR rn = 1 THEN content_hash END AS own FROM n),
b AS (SELECT *, last_value(own IGNORE NULLS) OVER (PARTITION BY url ORDER BY fetched_at, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM o),
i AS (SELECT *, sum(CASE WHEN own IS NOT NULL AND (rn = 1 OR own <> before) THEN 1 ELSE 0 END) OVER (PARTITION BY url ORDER BY fetched_at, run_id ROWS UNBOUNDED PRECEDING) AS island FROM b)
SELECT url, arg_min(content_hash, (fetched_at, run_id)) AS content_hash, min(fetched_at) AS first_seen, max(fetched_at) AS last_seen, count(*) AS fetches FROM i GROUP BY url, island""")
def d12_version_islands(spark, sf_dir):
    return fetchlog.version_islands(table(spark, sf_dir, "fetches"))


#: Texts of two kinds, by their object's key: a hundred lines, all of them of the kind but for one of the object's
#: own. Two texts of a kind are alike but for that line, which is no meaningful change.
_FOLDED_SQL = """WITH u AS (SELECT DISTINCT url, fetched_at, status, content_hash, raw_object_key, CASE WHEN sha1(raw_object_key)[1] < '8' THEN 'low' ELSE 'high' END AS kind
  FROM fetches WHERE status IN (200, 304) AND content_hash IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY fetched_at, content_hash, raw_object_key) AS rn FROM u),
o AS (SELECT *, CASE WHEN status <> 304 OR rn = 1 THEN kind END AS own FROM n),
b AS (SELECT *, last_value(own IGNORE NULLS) OVER (PARTITION BY url ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM o),
s AS (SELECT *, own IS NOT NULL AND (rn = 1 OR own <> before) AS opens FROM b),
t AS (SELECT *, CASE WHEN opens THEN sha256(array_to_string(list_transform(range(1, 100), lambda i: kind || ' line ' || i), chr(10)) || chr(10) || raw_object_key) END AS hashed FROM s),
f AS (SELECT *, last_value(CASE WHEN opens THEN fetched_at END IGNORE NULLS) OVER w AS first_seen, last_value(hashed IGNORE NULLS) OVER w AS text_hash FROM t WINDOW w AS (PARTITION BY url ORDER BY rn ROWS UNBOUNDED PRECEDING))
"""


def _folded(spark, sf_dir):
    empty = table(spark, sf_dir, "versions").where("1 = 0")
    fetches = table(spark, sf_dir, "fetches")
    kind = F.when(F.substring(F.sha1("raw_object_key"), 1, 1) < "8", "low").otherwise("high")
    lines = F.transform(F.sequence(F.lit(1), F.lit(99)), lambda i: F.concat(kind, F.lit(" line "), i.cast("string")))
    text = F.concat_ws("\n", F.array_join(lines, "\n"), "raw_object_key")
    texts = fetches.where("raw_object_key is not null").select("url", "raw_object_key").distinct().select("url", "raw_object_key", text.alias("text"), F.lit(None).cast("string").alias("stated_date"))
    return versions.fold_versions(fetches, empty, texts)


@query(_FOLDED_SQL + "SELECT url, CASE WHEN opens THEN 'new' ELSE 'unchanged' END AS action, sha1(url || chr(0) || text_hash || chr(0) || first_seen) AS version_id, first_seen, fetched_at AS last_seen FROM f")
def d15_fold_versions(spark, sf_dir):
    return _folded(spark, sf_dir).select("url", "action", "version_id", "first_seen", "last_seen")


@query(_FOLDED_SQL + "SELECT count(*) AS examined, count(*) FILTER (opens) AS new_versions, count(*) FILTER (NOT opens) AS unchanged, 0::BIGINT AS needs_js, 0::BIGINT AS errors FROM f")
def d18_extract_report(spark, sf_dir):
    return versions.extract_report(_folded(spark, sf_dir))


@query("""WITH v AS (SELECT url, version_id, text_md, lag(text_md) OVER (PARTITION BY url ORDER BY first_seen, version_id) AS old FROM (SELECT DISTINCT url, version_id, first_seen, text_md FROM versions WHERE text_md IS NOT NULL)),
s AS (SELECT version_id, regexp_split_to_array(old, '\\r\\n|[\\n\\r]') AS a, regexp_split_to_array(text_md, '\\r\\n|[\\n\\r]') AS b FROM v WHERE old IS NOT NULL)
SELECT version_id, round(2.0 * coalesce(list_sum(list_transform(list_distinct(list_intersect(a, b)), lambda x: least(len(list_filter(a, lambda y: y = x)), len(list_filter(b, lambda y: y = x))))), 0) / (len(a) + len(b)), 6) AS bound FROM s""")
def d6_line_bound(spark, sf_dir):
    from pyspark.sql import Window

    v = table(spark, sf_dir, "versions").where("text_md is not null").select("url", "version_id", "first_seen", "text_md").distinct()
    v = v.withColumn("old", F.lag("text_md").over(Window.partitionBy("url").orderBy("first_seen", "version_id"))).where("old is not null")
    return v.select("version_id", F.round(versions.line_bound(F.col("old"), F.col("text_md")), 6).alias("bound"))


@query(None)
def d6_line_ratio(spark, sf_dir):
    from pyspark.sql import Window

    v = table(spark, sf_dir, "versions").where("text_md is not null").select("url", "version_id", "first_seen", "text_md").distinct()
    v = v.withColumn("old", F.lag("text_md").over(Window.partitionBy("url").orderBy("first_seen", "version_id"))).where("old is not null")
    v = v.withColumn("bound", versions.line_bound(F.col("old"), F.col("text_md")))
    decided = v.where("bound < 0.98 or old = text_md").select("version_id", F.expr("old <> text_md").alias("meaningful"))
    open_ = v.where("not (bound < 0.98 or old = text_md)").select("version_id", (versions.line_ratio(F.col("old"), F.col("text_md")) < 0.98).alias("meaningful"))
    return decided.unionByName(open_)


# --- E: enrichment ----------------------------------------------------------------------------------


@query(f"SELECT version_id, url, last_seen FROM {_LATEST.format(_READY)}")
def e1_latest_versions(spark, sf_dir):
    return versions.latest_versions(table(spark, sf_dir, "versions")).select("version_id", "url", "last_seen")


_CFG = Enrich()
_IN = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_OBJECTS = f"""WITH e AS (SELECT DISTINCT version_id, prompt_version, json FROM extractions WHERE json_valid(json)),
o AS (SELECT version_id, prompt_version, json_extract(json, '$.focuses[*]') AS f, from_json(json_extract(json, '$.life_transitions'), '["VARCHAR"]') AS lt, from_json(json_extract(json, '$.quotes'), '["VARCHAR"]') AS q
  FROM e WHERE json_type(json, '$.focuses') = 'ARRAY'),
c AS (SELECT *, len(list_filter(f, lambda x: NOT coalesce(list_contains({_IN(_CFG.domains)}, json_extract_string(x, '$.domain')) AND list_contains({_IN(_CFG.statuses)}, json_extract_string(x, '$.status')), false))) = 0 AS ok FROM o)
"""


@query(_OBJECTS + f"SELECT version_id, prompt_version, ok AS allowed, len(list_filter(lt, lambda t: list_contains({_IN(_CFG.life_transitions)}, t))) AS transitions FROM c")
def e3_check_values(spark, sf_dir):
    e = table(spark, sf_dir, "extractions").select("version_id", "prompt_version", "json").distinct().withColumn("o", enrich.parse_enrichment(F.col("json"))).where("o is not null")
    return e.select("version_id", "prompt_version", enrich.values_allowed(F.col("o")).alias("allowed"), F.size(enrich.known_transitions(F.col("o"))).cast("bigint").alias("transitions"))


_ONE = r"regexp_replace(regexp_replace({0}, '[\s\p{{Z}}]+', ' ', 'g'), '^ | $', '', 'g')"


@query(_OBJECTS + f""", t AS (SELECT version_id, {_ONE.format('max(text_md)')} AS page FROM versions GROUP BY version_id)
SELECT version_id, prompt_version, list_filter(list_transform(q, lambda x: {_ONE.format('x')}), lambda x: length(x) > 0 AND contains(page, x))[1:3] AS quotes FROM c JOIN t USING (version_id) WHERE ok AND page IS NOT NULL""")
def e4_valid_quotes(spark, sf_dir):
    a = enrich.accepted(table(spark, sf_dir, "extractions"), table(spark, sf_dir, "versions"))
    return a.where("quotes is not null").select("version_id", "prompt_version", "quotes")


@query(f"SELECT version_id FROM {_LATEST.format(_READY)} WHERE version_id NOT IN (SELECT version_id FROM extractions WHERE prompt_version = '2' AND version_id IS NOT NULL)")
def e6_todo_versions(spark, sf_dir):
    latest = versions.latest_versions(table(spark, sf_dir, "versions"))
    return enrich.todo_versions(latest, table(spark, sf_dir, "extractions"), "2").select("version_id")


@query(_OBJECTS + """SELECT version_id || ':' || (i - 1) AS focus_id, prompt_version, json_extract_string(f[i], '$.domain') AS domain, json_extract_string(f[i], '$.summary') AS summary
FROM (SELECT version_id, prompt_version, f, unnest(range(1, least(len(f), 5) + 1)) AS i FROM c WHERE ok AND version_id IN (SELECT version_id FROM versions))""")
def e8_explode_focuses(spark, sf_dir):
    a = enrich.accepted(table(spark, sf_dir, "extractions"), table(spark, sf_dir, "versions"))
    return a.select("prompt_version", "version_id", F.posexplode("o.focuses").alias("i", "f")).select(
        F.concat_ws(":", "version_id", F.col("i").cast("string")).alias("focus_id"), "prompt_version", "f.domain", "f.summary"
    )


@query(_OBJECTS + """, good AS (SELECT prompt_version, count(*) AS enriched, sum(least(len(f), 5)) AS focuses FROM c WHERE ok AND version_id IN (SELECT version_id FROM versions) GROUP BY 1),
tried AS (SELECT prompt_version, count(*) AS candidates FROM (SELECT DISTINCT version_id, prompt_version, json FROM extractions) GROUP BY 1)
SELECT prompt_version, candidates, coalesce(enriched, 0) AS enriched, candidates - coalesce(enriched, 0) AS failed, coalesce(focuses, 0)::BIGINT AS focuses FROM tried LEFT JOIN good USING (prompt_version)""")
def e12_enrich_report(spark, sf_dir):
    return enrich.enrich_report(table(spark, sf_dir, "extractions"), table(spark, sf_dir, "versions"))


# --- F: embedding -----------------------------------------------------------------------------------


@query("SELECT DISTINCT focus_id, CASE WHEN len(tags) > 0 THEN summary || ' (' || array_to_string(list_filter(tags, lambda t: t IS NOT NULL), ', ') || ')' ELSE summary END AS text FROM focuses")
def f1_focus_text(spark, sf_dir):
    return table(spark, sf_dir, "focuses").select("focus_id", page.focus_text(F.col("summary"), F.col("tags")).alias("text")).distinct()


@query("""WITH h AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), p AS (SELECT vec_id, list_transform(range(1, 9), lambda d: (v[d] + CASE WHEN vec_id % 3 > 0 THEN v[d + 8] ELSE 0.0 END) / (CASE WHEN vec_id % 3 > 0 THEN 2 ELSE 1 END)) AS m FROM h)
SELECT vec_id, list_transform(m, lambda x: round(x / greatest(sqrt(list_sum(list_transform(m, lambda y: y * y))), 1e-9), 6)) AS pooled FROM p""")
def f2_mean_pool(spark, sf_dir):
    v = doubles(F.col("embedding"))
    hidden = F.array(*[F.slice(v, 1 + 8 * i, 8) for i in range(3)])
    mask = F.array(F.lit(1), F.when(F.col("vec_id") % 3 > 0, 1).otherwise(0), F.lit(0))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.transform(mean_pool(hidden, mask), lambda x: F.round(x, 6)).alias("pooled"))


_CANDIDATES = f"(SELECT DISTINCT focus_id, version_id FROM focuses WHERE NOT sensitive AND version_id IN (SELECT version_id FROM {_LATEST.format(_READY)}))"


@query(f"SELECT focus_id, version_id FROM {_CANDIDATES}")
def f3_candidate_focuses(spark, sf_dir):
    latest = versions.latest_versions(table(spark, sf_dir, "versions"))
    return enrich.candidate_focuses(table(spark, sf_dir, "focuses"), latest).select("focus_id", "version_id").distinct()


@query(f"SELECT DISTINCT focus_id FROM {_CANDIDATES} WHERE focus_id NOT IN (SELECT id FROM focus_vectors WHERE kind = 'focus' AND model = 'sentence-mini-64' AND id IS NOT NULL AND sha1(id)[1] < '8')")
def f4_todo_focuses(spark, sf_dir):
    """What is left to encode after a run that got through half of the focuses."""
    c = enrich.candidate_focuses(table(spark, sf_dir, "focuses"), versions.latest_versions(table(spark, sf_dir, "versions")))
    done = table(spark, sf_dir, "focus_vectors").where(F.substring(F.sha1("id"), 1, 1) < "8")
    return enrich.todo_focuses(c, done, "sentence-mini-64").select("focus_id").distinct()


# --- G: topics --------------------------------------------------------------------------------------

_FOC = f"""WITH fv AS (SELECT DISTINCT id AS focus_id, vector::DOUBLE[] AS v FROM focus_vectors WHERE kind = 'focus' AND model = 'sentence-mini-64' AND len(vector) = 64
  AND len(list_filter(vector, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(vector, lambda x: x <> 0)) > 0),
foc AS (SELECT DISTINCT focus_id, version_id, domain, summary, tags, coalesce(list_position({_IN(_CFG.domains)}, domain) - 1, -1)::INT AS topic, v FROM focuses JOIN fv USING (focus_id)),
el AS (SELECT focus_id, version_id, topic, unnest(range(1, 65)) AS pos, unnest(v) AS x FROM foc),
cents AS (SELECT topic, list(c ORDER BY pos) AS c FROM (SELECT topic, pos, avg(x) AS c FROM el WHERE topic >= 0 GROUP BY topic, pos) GROUP BY topic),
wts AS (SELECT version_id, topic, weight FROM (SELECT version_id, topic, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY version_id) AS weight FROM foc GROUP BY version_id, topic) WHERE topic >= 0),
snip AS (SELECT version_id, topic, arg_min(summary, (far, focus_id)) AS snippet FROM (SELECT f.*, round(-list_dot_product(v, c) / greatest(sqrt(list_dot_product(c, c)), 1e-9), 9) AS far FROM foc f JOIN cents USING (topic)) WHERE summary IS NOT NULL GROUP BY version_id, topic)
"""


def _foc(spark, sf_dir):
    f = topics.embedded_focuses(table(spark, sf_dir, "focuses").select("focus_id", "version_id", "domain", "summary", "tags"), table(spark, sf_dir, "focus_vectors"))
    at = F.array_position(F.array(*map(F.lit, _CFG.domains)), F.col("domain")).cast("int") - 1
    return f.withColumn("topic", F.coalesce(at, F.lit(-1)))


def _r6(c):
    return F.transform(c, lambda x: F.round(x, 6))


@query(_FOC + "SELECT topic, count(*) AS focuses, count(DISTINCT version_id) AS pages FROM foc GROUP BY topic")
def g1_embedded_focuses(spark, sf_dir):
    return _foc(spark, sf_dir).groupBy("topic").agg(F.count("*").alias("focuses"), F.count_distinct("version_id").alias("pages"))


@query(_FOC + f"SELECT version_id, url FROM {_LATEST.format(_READY)} WHERE version_id IN (SELECT version_id FROM foc)")
def g2_page_set(spark, sf_dir):
    latest = versions.latest_versions(table(spark, sf_dir, "versions"))
    return latest.join(_foc(spark, sf_dir).select("version_id").distinct(), "version_id", "left_semi").select("version_id", "url")


@query("""SELECT version_id, arg_max(q, (coalesce(created_at, ''), prompt_version, q)) AS quote FROM (SELECT version_id, created_at, prompt_version, json_extract_string(json, '$.quotes[0]') AS q
FROM extractions WHERE json_valid(json)) WHERE length(q) > 0 GROUP BY version_id""")
def g3_first_quotes(spark, sf_dir):
    return topics.first_quotes(table(spark, sf_dir, "extractions"))


@query(_FOC + """SELECT version_id, list_transform(s, lambda x: round(x / greatest(sqrt(list_dot_product(s, s)), 1e-9), 6)) AS v
FROM (SELECT version_id, list(s ORDER BY pos) AS s FROM (SELECT version_id, pos, sum(x) AS s FROM el GROUP BY version_id, pos) GROUP BY version_id)""")
def g5_page_vectors(spark, sf_dir):
    return topics.page_vectors(_foc(spark, sf_dir)).select("version_id", _r6(F.col("v")).alias("v"))


@query(_FOC + "SELECT topic, list_transform(c, lambda x: round(x, 6)) AS c FROM cents")
def g16_centroids(spark, sf_dir):
    return topics.centroids(_foc(spark, sf_dir)).select("topic", _r6(F.col("c")).alias("c"))


@query(_FOC + "SELECT a.topic AS a, b.topic AS b, round(list_cosine_similarity(a.c, b.c), 6) AS cos FROM cents a JOIN cents b ON a.topic < b.topic")
def g8_centroid_pairs(spark, sf_dir):
    return topics.centroid_pairs(topics.centroids(_foc(spark, sf_dir))).select("a", "b", F.round("cos", 6).alias("cos"))


@query(None)
def g8_merge_similar(spark, sf_dir):
    into = topics.merge_similar(topics.centroids(_foc(spark, sf_dir)), 0.3)
    return spark.createDataFrame(sorted(into.items()) or [(-1, -1)], "topic int, merged_into int").where("topic >= 0")


@query(_FOC + ", p AS (SELECT topic, count(DISTINCT version_id) AS n FROM foc WHERE topic >= 0 GROUP BY topic) SELECT focus_id, CASE WHEN n >= 40 THEN topic ELSE -1 END AS topic FROM foc LEFT JOIN p USING (topic)")
def g9_prune_small(spark, sf_dir):
    return topics.prune_small(_foc(spark, sf_dir), 40).select("focus_id", "topic")


_LABELS = _FOC + r""", pas AS (SELECT version_id AS page, topic, row_number() OVER (ORDER BY focus_id) AS pos,
  list_filter(regexp_extract_all(lower(CASE WHEN len(tags) > 0 THEN summary || ' (' || array_to_string(list_filter(tags, lambda t: t IS NOT NULL), ', ') || ')' ELSE summary END), '[\p{L}\p{N}_]+'), lambda w: regexp_matches(w, '^\p{L}{4,}$')) AS t FROM foc WHERE summary IS NOT NULL),
kinds AS (SELECT 'p' || page AS k, pos, t FROM pas UNION ALL SELECT 't' || topic, pos, t FROM pas WHERE topic >= 0),
w AS (SELECT k, word, row_number() OVER (PARTITION BY k ORDER BY pos, i) AS at FROM (SELECT k, pos, unnest(t) AS word, unnest(range(1, len(t) + 1)) AS i FROM kinds)),
terms AS (SELECT k, word AS term FROM w UNION ALL SELECT a.k, a.word || ' ' || b.word FROM w a JOIN w b ON a.k = b.k AND b.at = a.at + 1),
vocab AS (SELECT term, count(DISTINCT k) AS page_df FROM terms WHERE k[1] = 'p' GROUP BY term HAVING count(DISTINCT k) >= 2 AND count(DISTINCT k) <= greatest(3.0, 0.4 * (SELECT count(DISTINCT page) FROM pas)))
"""


def _passages(spark, sf_dir):

    f = _foc(spark, sf_dir).where("summary is not null")
    return f.select(F.col("version_id").alias("page"), "topic", F.col("focus_id").alias("pos"), page.focus_text(F.col("summary"), F.col("tags")).alias("text"))


@query(_LABELS + "SELECT term, page_df FROM vocab")
def g11_label_vocabulary(spark, sf_dir):
    return topics.label_vocabulary(_passages(spark, sf_dir))


@query(_LABELS + """, tf AS (SELECT k, term, count(*) AS n FROM terms JOIN vocab USING (term) WHERE k[1] = 't' GROUP BY k, term),
sh AS (SELECT k, term, n::DOUBLE / greatest(sum(n) OVER (PARTITION BY k), 1) AS tf FROM tf), tot AS (SELECT term, sum(tf) AS total FROM sh GROUP BY term)
SELECT k[2:]::INT AS topic, term, round(tf * ln(1 + (SELECT sum(tf) FROM sh) / (SELECT count(*) FROM vocab) / greatest(total, 1e-12)), 6) AS score FROM sh JOIN tot USING (term)""")
def g12_label_scores(spark, sf_dir):
    p = _passages(spark, sf_dir)
    return topics.label_scores(p, topics.label_vocabulary(p)).select("topic", "term", F.round("score", 6).alias("score"))


@query(None)
def g13_labels(spark, sf_dir):
    p = _passages(spark, sf_dir)
    ids = [r["topic"] for r in p.where("topic >= 0").select("topic").distinct().collect()]
    names = topics.pick_labels(topics.label_scores(p, topics.label_vocabulary(p)), ids)
    return spark.createDataFrame(sorted(names.items()) or [(-1, "")], "topic int, label string").where("topic >= 0")


@query(_FOC + """SELECT topic, rank::INT AS rank, focus_id FROM (SELECT topic, focus_id, row_number() OVER (PARTITION BY topic ORDER BY list_dot_product(v, c) DESC, focus_id) AS rank FROM foc JOIN cents USING (topic)) WHERE rank <= 10""")
def g14_topic_samples(spark, sf_dir):
    f = _foc(spark, sf_dir)
    return topics.topic_samples(f, topics.centroids(f))


@query(_FOC + "SELECT version_id, topic, round(weight, 6) AS weight FROM wts")
def g17_page_topic_weights(spark, sf_dir):
    return topics.page_topic_weights(_foc(spark, sf_dir)).withColumn("weight", F.round("weight", 6))


@query(_FOC + "SELECT version_id, topic, snippet FROM snip")
def g18_snippets(spark, sf_dir):
    f = _foc(spark, sf_dir)
    return topics.snippets(f.where("summary is not null"), topics.centroids(f))


@query(_FOC + """SELECT p.version_id, coalesce(t.topic, -1) AS cluster_id FROM (SELECT DISTINCT version_id FROM foc) p
LEFT JOIN (SELECT version_id, arg_max(topic, (weight, -topic)) AS topic FROM wts GROUP BY version_id) t USING (version_id)""")
def g19_primary_topics(spark, sf_dir):
    f = _foc(spark, sf_dir)
    return topics.primary_topics(topics.page_topic_weights(f), f)


_PLAIN = r"regexp_replace(text_md, '[#*_>`\[\]]|\(http[^)]*\)', '', 'g')"


@query(rf"""SELECT version_id, substr(p, 1, 280) || CASE WHEN length(p) > 280 THEN '…' ELSE '' END AS excerpt FROM (SELECT DISTINCT version_id, {_ONE.format(_PLAIN)} AS p FROM versions WHERE text_md IS NOT NULL)""")
def g21_excerpt(spark, sf_dir):
    return table(spark, sf_dir, "versions").where("text_md is not null").select("version_id", page.excerpt(F.col("text_md")).alias("excerpt")).distinct()


@query(_FOC + rf""", near AS (SELECT f.version_id, topic, summary, row_number() OVER (PARTITION BY f.version_id, topic ORDER BY -list_dot_product(v, c) / greatest(sqrt(list_dot_product(c, c)), 1e-9), focus_id, summary NULLS FIRST) AS rn FROM foc f JOIN cents USING (topic)),
tops AS (SELECT w.version_id, string_agg(w.topic || ':' || round_even(weight, 3) || ':' || coalesce(summary, ''), ';' ORDER BY round_even(weight, 3) DESC, w.topic) AS topics FROM wts w LEFT JOIN (SELECT * FROM near WHERE rn = 1) n USING (version_id, topic) GROUP BY w.version_id),
quoted AS (SELECT version_id, arg_max(q, (coalesce(created_at, ''), prompt_version, q)) AS quote FROM (SELECT version_id, created_at, prompt_version, json_extract_string(json, '$.quotes[0]') AS q FROM extractions WHERE json_valid(json)) WHERE length(q) > 0 GROUP BY version_id),
owner AS (SELECT url, name, city, country FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY coalesce(valid_from, '') DESC, name DESC NULLS LAST, city DESC NULLS LAST, country DESC NULLS LAST) AS rn FROM people WHERE coalesce(valid_to, '') = '') WHERE rn = 1),
page AS (SELECT version_id, url, last_seen, {_ONE.format(_PLAIN)} AS p FROM {_LATEST.format(_READY)} WHERE version_id IN (SELECT version_id FROM foc))
SELECT p.version_id AS id, p.url, name, city, country, last_seen AS captured_at, coalesce(quote, substr(p, 1, 280) || CASE WHEN length(p) > 280 THEN '…' ELSE '' END) AS excerpt, coalesce(topics, '') AS topics
FROM page p LEFT JOIN tops USING (version_id) LEFT JOIN quoted USING (version_id) LEFT JOIN owner ON p.url = owner.url""")
def g22_export_points(spark, sf_dir):
    f = _foc(spark, sf_dir)
    pages = versions.latest_versions(table(spark, sf_dir, "versions")).join(f.select("version_id").distinct(), "version_id", "left_semi")
    points = topics.export_points(pages, topics.page_topic_weights(f), topics.snippets(f, topics.centroids(f)), topics.first_quotes(table(spark, sf_dir, "extractions")), table(spark, sf_dir, "people"))
    listed = F.from_json("topics", "array<struct<id:int,weight:double,snippet:string>>")
    flat = F.array_join(F.transform(listed, lambda t: F.concat_ws(":", t["id"].cast("string"), t["weight"].cast("string"), F.coalesce(t["snippet"], F.lit("")))), ";")
    return points.withColumn("topics", flat)


@query(_FOC + "SELECT topic, count(DISTINCT version_id) AS pages FROM wts WHERE weight > 0 GROUP BY topic")
def g23_topic_pages(spark, sf_dir):
    return topics.topic_pages(topics.page_topic_weights(_foc(spark, sf_dir)))


@query(_FOC + "SELECT count(DISTINCT version_id) AS points, (SELECT count(DISTINCT topic) FROM wts) AS clusters, count(DISTINCT version_id) FILTER (version_id NOT IN (SELECT version_id FROM wts)) AS noise FROM foc")
def g24_cluster_report(spark, sf_dir):
    f = _foc(spark, sf_dir)
    per = f.groupBy("version_id").agg(F.max("topic").alias("top"))
    return per.agg(F.count("*").alias("points"), F.count_if(F.col("top") < 0).alias("noise")).crossJoin(f.where("topic >= 0").agg(F.count_distinct("topic").alias("clusters")))


@query(None)
def g7_density_clusters(spark, sf_dir):
    from pageatlas.operators import hdbscan

    e = table(spark, sf_dir, "embeddings")
    return hdbscan.cluster(e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")), 8)


@query(None)
def g6_layout(spark, sf_dir):
    from pageatlas.operators import layout

    e = table(spark, sf_dir, "embeddings")
    return layout.positions(e.select(F.col("vec_id").cast("string").alias("version_id"), doubles(F.col("embedding")).alias("v")))


@query(None)
def d2_main_text(spark, sf_dir):
    from pageatlas.functions.html import main_text

    d = table(spark, sf_dir, "documents").where("text is not null")
    body = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", "&", "&amp;"), "<", "&lt;"), "\n+", "</p><p>")
    html = F.concat(F.lit("<html><head><style>p {}</style></head><body><nav><a href='/'>Home</a></nav><article><p>"), body, F.lit("</p></article><footer>© 2026</footer></body></html>"))
    return d.select("doc_id", main_text(F.lit("https://a.example/now"), html).alias("text_md"))


# --- H: view ----------------------------------------------------------------------------------------

_PTS = "WITH pts AS (SELECT vec_id AS id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, label AS topic, (1 + vec_id % 4) / 4.0::DOUBLE AS weight FROM embeddings), b AS (SELECT min(x) AS x0, min(y) AS y0, CASE WHEN greatest(max(x) - min(x), max(y) - min(y)) = 0 THEN 1 ELSE greatest(max(x) - min(x), max(y) - min(y)) END AS span FROM pts), sc AS (SELECT id, topic, weight, 30 + (x - x0) / span * 580 AS cx, 30 + (y - y0) / span * 580 AS cy FROM pts, b)\n"


def _points(spark, sf_dir):
    e = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), e[0].cast("double").alias("x"), e[1].cast("double").alias("y"), F.col("label").alias("topic"), ((1 + F.col("vec_id") % 4) / 4.0).alias("weight")
    )


@query(_PTS + "SELECT id, round(cx, 6) AS cx, round(cy, 6) AS cy FROM sc")
def h1_scaled(spark, sf_dir):
    return viewagg.scaled(_points(spark, sf_dir)).select("id", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))


@query(_PTS + """, m AS (SELECT topic, sum(weight) AS w, sum(weight * cx) / sum(weight) AS gx, sum(weight * cy) / sum(weight) AS gy FROM sc GROUP BY topic)
SELECT topic, round(gx, 4) AS gx, round(gy, 4) AS gy, round(greatest(40.0, 1.6 * sqrt(sum(weight * (pow(cx - gx, 2) + pow(cy - gy, 2))) / any_value(w))), 4) AS r FROM sc JOIN m USING (topic) GROUP BY topic, gx, gy""")
def h2_glows(spark, sf_dir):
    g = viewagg.glows(viewagg.scaled(_points(spark, sf_dir)))
    return g.select("topic", *[F.round(c, 4).alias(c) for c in ("gx", "gy", "r")])


_RGB = "(0.65 - 0.2625 * greatest(-1.0, least(k - 3, 9 - k, 1.0))) * 255"
_CH = "(SELECT topic, {0} AS v FROM (SELECT topic, fmod({1} + fmod(topic * 137.5, 360.0) / 30, 12.0) AS k FROM t))"


@query(f"""WITH t AS (SELECT DISTINCT label AS topic FROM embeddings) SELECT t.topic, round(fmod(t.topic * 137.5, 360.0)::DOUBLE, 6) AS hue, round(r.v::DOUBLE, 4) AS red, round(g.v::DOUBLE, 4) AS green, round(b.v::DOUBLE, 4) AS blue
FROM t JOIN {_CH.format(_RGB, 0)} r USING (topic) JOIN {_CH.format(_RGB, 8)} g USING (topic) JOIN {_CH.format(_RGB, 4)} b USING (topic)""")
def h3_topic_colour(spark, sf_dir):
    h = viewagg.hue(F.col("topic"))
    r, g, b = viewagg.hsl_to_rgb(h)
    t = table(spark, sf_dir, "embeddings").select(F.col("label").alias("topic")).distinct()
    return t.select("topic", F.round(h, 6).alias("hue"), F.round(r, 4).alias("red"), F.round(g, 4).alias("green"), F.round(b, 4).alias("blue"))


@query(_FOC + f""", t AS (SELECT DISTINCT topic FROM wts), rgb AS (SELECT t.topic, r.v AS r, g.v AS g, b.v AS b FROM t JOIN {_CH.format(_RGB, 0)} r USING (topic) JOIN {_CH.format(_RGB, 8)} g USING (topic) JOIN {_CH.format(_RGB, 4)} b USING (topic)),
mix AS (SELECT version_id, floor(sum(weight * r) / sum(weight) + 0.5)::BIGINT AS red, floor(sum(weight * g) / sum(weight) + 0.5)::BIGINT AS green, floor(sum(weight * b) / sum(weight) + 0.5)::BIGINT AS blue FROM wts JOIN rgb USING (topic) GROUP BY version_id)
SELECT p.version_id, coalesce(red, 107) AS red, coalesce(green, 114) AS green, coalesce(blue, 128) AS blue FROM (SELECT DISTINCT version_id FROM foc) p LEFT JOIN mix USING (version_id)""")
def h4_blend(spark, sf_dir):
    f = _foc(spark, sf_dir)
    return viewagg.blend(f, topics.page_topic_weights(f))


@query(_FOC + """SELECT p.version_id, round(coalesce(weight, 0.0), 6) AS weight_on, round(0.1 + 0.9 * coalesce(weight, 0.0), 6) AS opacity, round(4 + 2 * coalesce(weight, 0.0), 6) AS radius
FROM (SELECT DISTINCT version_id FROM foc) p LEFT JOIN (SELECT * FROM wts WHERE topic = 4) USING (version_id)""")
def h5_emphasis(spark, sf_dir):
    f = _foc(spark, sf_dir)
    e = viewagg.emphasis(f, topics.page_topic_weights(f), 4)
    return e.select("version_id", *[F.round(c, 6).alias(c) for c in ("weight_on", "opacity", "radius")])


@query(_FOC + """SELECT p.version_id, coalesce(snippet, 'excerpt') AS text, floor(weight * 100 + 0.5)::INT || '%' AS percent FROM (SELECT DISTINCT version_id FROM foc) p
LEFT JOIN (SELECT * FROM wts WHERE topic = 4) USING (version_id) LEFT JOIN (SELECT version_id, snippet FROM snip WHERE topic = 4) USING (version_id)""")
def h6_postcards(spark, sf_dir):
    f = _foc(spark, sf_dir)
    points = f.select("version_id").distinct().withColumn("excerpt", F.lit("excerpt"))
    return viewagg.postcards(points, topics.page_topic_weights(f), topics.snippets(f.where("summary is not null"), topics.centroids(f)), 4)


@query("SELECT DISTINCT e.label AS topic, coalesce(n.l, 'topic ' || e.label) AS label FROM embeddings e LEFT JOIN (VALUES (0, 'zero'), (3, 'three')) n(t, l) ON e.label = n.t")
def h7_topic_labels(spark, sf_dir):
    ids = table(spark, sf_dir, "embeddings").select(F.col("label").alias("topic")).distinct()
    return viewagg.topic_labels(ids, spark.createDataFrame([(0, "zero"), (3, "three")], "topic int, label string"))
