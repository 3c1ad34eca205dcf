"""Named queries over the mapped archive, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.functions import amounts
from eventide.functions import tags as tg
from eventide.functions import time as tm
from eventide.operators import engagement as en
from eventide.operators import rollups as ro
from eventide.operators import serving as sv
from eventide.operators import users as us
from eventide.operators import zaps as za
from eventide.plans.mapping import AS_OF, AS_OF_DAY, EV, SO, events, social, table
from eventide.schema import DAY, GENESIS
from eventide.sources import files as fi

QUERIES: dict = {}
SQL: dict[str, str] = {}
AS = str(AS_OF)
MONTH_AGO, WEEK_AGO = AS_OF - 30 * DAY, AS_OF - 7 * DAY
HOT = (44, 45)


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _stats(spark, sf):
    return us.daily_user_stats(events(spark, sf), HOT)


def _served(name, build, files=None):
    """The product of that name over the events, from its serving table."""

    def read(spark, sf):
        return sv.product(spark, name, [f"{sf}/events.parquet"], lambda: build(spark, sf), files)

    return read


served_stats = _served("daily_user_stats", _stats)
served_seen = _served("first_seen", lambda spark, sf: us.first_seen(events(spark, sf), HOT))
served_kinds = _served("kinds_stats", lambda spark, sf: ro.kinds(events(spark, sf)), 1)
served_kind_days = {g: _served(f"kind_activity_{g}", lambda spark, sf, g=g: ro.kind_activity(events(spark, sf), g)) for g in ("day", "week", "month")}
# Made from the tables above, so the events are read once for each of those.
served_periods = {g: _served(f"periods_{g}", lambda spark, sf, g=g: us.periods(served_stats(spark, sf), g), 1) for g in ("day", "week", "month")}
served_active = {g: _served(f"active_users_{g}", lambda spark, sf, g=g: us.active_users(served_stats(spark, sf), g, last=AS_OF_DAY), 1) for g in ("day", "week", "month")}
served_new = {g: _served(f"new_users_{g}", lambda spark, sf, g=g: us.new_users(served_seen(spark, sf), AS_OF, g), 1) for g in ("day", "week", "month")}
served_cohorts = {g: _served(f"cohorts_{g}", lambda spark, sf, g=g: us.cohorts(served_stats(spark, sf), served_seen(spark, sf), g), 1) for g in ("day", "week", "month")}


STATS = f"""WITH {EV}, flags AS (SELECT pubkey, bool_or(kind = 0) AS has_profile, bool_or(kind = 3) AS has_follows FROM ev GROUP BY 1),
stats AS (SELECT day AS date, pubkey, count(*) AS event_count FROM ev WHERE kind NOT IN (44, 45) GROUP BY 1, 2)"""
SEEN = f"WITH {EV}, seen AS (SELECT pubkey, min(created_at) AS first_seen FROM ev WHERE kind NOT IN (44, 45) GROUP BY 1)"
DAY_STR = "strftime({0}, '%Y-%m-%d')"


# Rollups and overview.


@query(f"WITH {EV} SELECT strftime(day, '%Y-%m-%d') AS day, kind, count(*) AS event_count FROM ev GROUP BY 1, 2")
def rollup_event_daily_kind(spark, sf):
    return ro.daily_kind(ro.distinct_events(events(spark, sf))).withColumn("day", tm.shown(F.col("day")))


@query(f"WITH {EV} SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS event_count FROM ev GROUP BY 1")
def rollup_event_daily(spark, sf):
    return ro.daily(ro.distinct_events(events(spark, sf))).withColumn("day", tm.shown(F.col("day")))


@query(f"WITH {EV} SELECT kind, count(*) AS event_count FROM ev GROUP BY 1")
def rollup_kind_all_time(spark, sf):
    return ro.kind_all_time(ro.distinct_events(events(spark, sf)))


@query(f"""WITH {EV} SELECT count(*) AS total_events, count(*) AS representable_events, greatest(min(created_at), {GENESIS}) AS earliest_event,
max(created_at) FILTER (created_at <= {AS}) AS latest_event, count(*) FILTER (created_at >= {WEEK_AGO}) AS events_7d,
count(*) FILTER (created_at >= {WEEK_AGO}) / 168.0::DOUBLE AS events_per_hour_7d, count(DISTINCT kind) FILTER (created_at >= {MONTH_AGO}) AS kinds_30d FROM ev""")
def rollup_overview(spark, sf):
    return ro.overview(ro.distinct_events(events(spark, sf)), AS_OF)


@query(f"""WITH {EV} SELECT count(DISTINCT id) AS total_events, count(DISTINCT pubkey) AS total_pubkeys, count(DISTINCT kind) FILTER (created_at >= {MONTH_AGO}) AS total_kinds,
greatest(min(created_at), {GENESIS}) AS earliest_event, max(created_at) FILTER (created_at <= {AS}) AS latest_event FROM ev""")
def q01_stats(spark, sf):
    at = F.col("created_at")
    return events(spark, sf).agg(
        F.count_distinct("id").alias("total_events"), F.count_distinct("pubkey").alias("total_pubkeys"), F.count_distinct(F.when(at >= MONTH_AGO, F.col("kind"))).alias("total_kinds"),
        F.greatest(F.min(at), F.lit(GENESIS)).alias("earliest_event"), F.max(F.when(at <= AS_OF, at)).alias("latest_event"),
    )


@query("SELECT count(DISTINCT event_id) AS total_events FROM events")
def q02_events_total(spark, sf):
    return table(spark, sf, "events").agg(F.count_distinct("event_id").alias("total_events"))


@query("SELECT count(*) AS rows, min(event_id) AS min_event_id, max(event_id) AS max_event_id FROM events")
def s14_footer_count(spark, sf):
    """The number of rows by metadata alone; q02 counts ids exactly."""
    return fi.footer_facts(spark, f"{sf}/events.parquet", bounds=("event_id",))


@query(SEEN + " SELECT count(*) AS total_pubkeys FROM seen")
def q03_pubkeys_total(spark, sf):
    return served_seen(spark, sf).agg(F.count("*").alias("total_pubkeys"))


@query(f"WITH {EV} SELECT count(DISTINCT kind) AS total_kinds FROM ev WHERE created_at >= {MONTH_AGO}")
def q04_kinds_total(spark, sf):
    return events(spark, sf, since=MONTH_AGO).agg(F.count_distinct("kind").alias("total_kinds"))


@query(f"WITH {EV} SELECT greatest(min(created_at), {GENESIS}) AS earliest_event FROM ev")
def q05_earliest(spark, sf):
    return events(spark, sf).agg(F.greatest(F.min("created_at"), F.lit(GENESIS)).alias("earliest_event"))


@query(f"WITH {EV} SELECT max(created_at) AS latest_event FROM ev WHERE created_at <= {AS}")
def q06_latest(spark, sf):
    return events(spark, sf).where(F.col("created_at") <= AS_OF).agg(F.max("created_at").alias("latest_event"))


def _add_periods():
    starts = {"day": "day", "week": "date_trunc('week', day)", "month": "date_trunc('month', day)"}
    for grain, start in starts.items():
        most = {"day": 30, "week": 12, "month": 12}[grain]

        def raw(spark, sf, grain=grain, most=most):
            own = ro.within(events(spark, sf, since=AS_OF - 20 * DAY), as_of=AS_OF, days=20, kind=7)
            return ro.by_period(own, grain, most)

        raw.__name__ = f"q07_events_of_kind_by_{grain}"
        query(f"WITH {EV} SELECT strftime({start}, '%Y-%m-%d') AS period, count(*) AS count, count(DISTINCT pubkey) AS unique_pubkeys FROM ev WHERE kind = 7 AND created_at <= {AS} AND created_at >= {AS_OF - 20 * DAY} GROUP BY 1 ORDER BY 1 DESC LIMIT {most}")(raw)

        def summed(spark, sf, grain=grain, most=most):
            return served_periods[grain](spark, sf).orderBy(F.desc("period")).limit(most)

        summed.__name__ = f"q07_events_by_{grain}_from_daily_stats"
        on_date = start.replace("day)", "date)") if grain != "day" else "date"
        query(STATS + f" SELECT strftime({on_date}, '%Y-%m-%d') AS period, CAST(sum(event_count) AS BIGINT) AS count, count(DISTINCT pubkey) AS unique_pubkeys FROM stats GROUP BY 1 ORDER BY 1 DESC LIMIT {most}")(summed)

        def active(spark, sf, grain=grain):
            return served_active[grain](spark, sf)

        active.__name__ = {"day": "q10_active_daily", "week": "q11_active_weekly", "month": "q12_active_monthly"}[grain]
        query(STATS + f""" SELECT strftime({on_date}, '%Y-%m-%d') AS period, count(DISTINCT pubkey) AS active_users, count(DISTINCT pubkey) FILTER (has_profile) AS has_profile, count(DISTINCT pubkey) FILTER (has_follows) AS has_follows,
count(DISTINCT pubkey) FILTER (has_profile AND has_follows) AS has_both, CAST(sum(event_count) AS BIGINT) AS total_events FROM stats JOIN flags USING (pubkey) WHERE date <= DATE '{AS_OF_DAY}' GROUP BY 1""")(active)

        def new(spark, sf, grain=grain):
            return served_new[grain](spark, sf)

        new.__name__ = f"q13_new_users_by_{grain}"
        on_seen = start.replace("day", "day", 1) if grain == "day" else start.replace("day)", "d)")
        query(SEEN + f", x AS (SELECT CAST(to_timestamp(first_seen) AT TIME ZONE 'UTC' AS DATE) AS d FROM seen WHERE first_seen BETWEEN {GENESIS} AND {AS}) SELECT strftime({'d' if grain == 'day' else on_seen}, '%Y-%m-%d') AS period, count(*) AS new_users FROM x GROUP BY 1")(new)

        def zapped(spark, sf, grain=grain, most=most):
            return za.by_period(amounts.zaps(social(spark, sf, since=MONTH_AGO, types=("purchase",))), AS_OF, grain, 30, most)

        zapped.__name__ = f"q16_zaps_by_{grain}"
        query(ZAPS + f" SELECT strftime({start}, '%Y-%m-%d') AS period, count(*) AS zap_count, CAST(sum(amount_msats) // 1000 AS BIGINT) AS total_sats, count(DISTINCT zapper_pubkey) AS unique_zappers, avg(amount_msats) / 1000 AS avg_sats FROM z WHERE amount_msats > 0 AND created_at >= {MONTH_AGO} GROUP BY 1 ORDER BY 1 DESC LIMIT {most}")(zapped)


ZAPS = f"""WITH {SO}, z0 AS (
  SELECT id AS event_id, pubkey AS zapper_pubkey, created_at, day, p AS recipient_pubkey, CAST(regexp_extract(bolt11, '^lnbc([0-9]+)[munp]1', 1) AS BIGINT) AS n, regexp_extract(bolt11, '^lnbc[0-9]+([munp])1', 1) AS u
  FROM so WHERE kind = 9735 AND regexp_matches(bolt11, '^lnbc[0-9]+[munp]1')
), z1 AS (SELECT *, CASE u WHEN 'm' THEN n * 100000000 WHEN 'u' THEN n * 100000 WHEN 'n' THEN n * 100 ELSE n // 10 END AS a FROM z0),
z AS (SELECT event_id, zapper_pubkey, created_at, day, recipient_pubkey, CAST(CASE WHEN a > 1000000000 THEN 0 ELSE a END AS BIGINT) AS amount_msats FROM z1)"""
_add_periods()


@query(f"WITH {EV} SELECT count(*) AS count, count(DISTINCT pubkey) AS unique_pubkeys FROM ev WHERE created_at <= {AS} AND created_at >= {AS_OF - 20 * DAY} AND created_at < {AS_OF - 5 * DAY}")
def q07_events_aggregate(spark, sf):
    since, until = AS_OF - 20 * DAY, AS_OF - 5 * DAY
    return ro.within(events(spark, sf, since, until), as_of=AS_OF, since=since, until=until).agg(F.count("*").alias("count"), F.count_distinct("pubkey").alias("unique_pubkeys"))


@query(f"WITH {EV} SELECT count(*) AS events_7d, count(*) / 168.0::DOUBLE AS events_per_hour FROM ev WHERE created_at >= {WEEK_AGO}")
def q08_throughput(spark, sf):
    return ro.throughput(events(spark, sf, since=WEEK_AGO), AS_OF)


@query("\nUNION ALL\n".join(
    f"""(WITH {EV}, flags AS (SELECT pubkey, bool_or(kind = 0) AS has_profile, bool_or(kind = 3) AS has_follows FROM ev GROUP BY 1)
SELECT '{g}' AS grain, strftime({s}, '%Y-%m-%d') AS period, count(DISTINCT pubkey) AS active_users, count(DISTINCT pubkey) FILTER (has_profile) AS has_profile, count(DISTINCT pubkey) FILTER (has_follows) AS has_follows,
count(DISTINCT pubkey) FILTER (has_profile AND has_follows) AS has_both, count(*) AS total_events FROM ev JOIN flags USING (pubkey) WHERE kind NOT IN (44, 45) GROUP BY 2 ORDER BY 2 DESC LIMIT 1)"""
    for g, s in (("day", "day"), ("week", "date_trunc('week', day)"), ("month", "date_trunc('month', day)"))
))
def q09_active_latest(spark, sf):
    rows = [served_active[g](spark, sf).orderBy(F.desc("period")).limit(1).select(F.lit(g).alias("grain"), "*") for g in ("day", "week", "month")]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


RETENTION = SEEN + """, s AS (SELECT pubkey, CAST(to_timestamp(first_seen) AT TIME ZONE 'UTC' AS DATE) AS since FROM seen),
c AS (SELECT strftime(date_trunc('{0}', since), '%Y-%m-%d') AS cohort, strftime(date_trunc('{0}', day), '%Y-%m-%d') AS activity_period, count(DISTINCT pubkey) AS active_count
FROM ev JOIN s USING (pubkey) WHERE kind NOT IN (44, 45) AND since <= day GROUP BY 1, 2)"""


def _add_retention():
    for grain, most in (("day", 30), ("week", 12), ("month", 12)):
        name = {"day": "daily", "week": "weekly", "month": "monthly"}[grain]

        def cohorts(spark, sf, grain=grain):
            return us.cohorts(_stats(spark, sf), us.first_seen(events(spark, sf), HOT), grain)

        cohorts.__name__ = f"m14_cohorts_{name}"
        query(RETENTION.format(grain) + " SELECT * FROM c")(cohorts)

        def retention(spark, sf, grain=grain, most=most):
            """One row for each period, so that both engines' rows compare; retention() itself gives arrays."""
            table_ = served_cohorts[grain](spark, sf)
            rows = us.retention(table_, limit=most)
            ordered = table_.groupBy("cohort").agg(F.array_sort(F.collect_list("activity_period")).alias("periods"))
            zipped = rows.join(ordered, "cohort").select("cohort", "cohort_size", F.explode(F.arrays_zip("periods", "retention", "retention_pct")).alias("x"))
            return zipped.select("cohort", "cohort_size", F.col("x.periods").alias("activity_period"), F.col("x.retention").alias("active_count"), F.col("x.retention_pct").alias("pct"))

        retention.__name__ = f"q14_retention_{name}"
        query(RETENTION.format(grain) + f""", o AS (SELECT cohort, coalesce(max(active_count) FILTER (activity_period = cohort), 0) AS cohort_size FROM c GROUP BY 1 ORDER BY 1 LIMIT {most})
SELECT cohort, cohort_size, activity_period, active_count, CASE WHEN cohort_size > 0 THEN active_count * 100.0::DOUBLE / cohort_size ELSE 0.0 END AS pct FROM c JOIN o USING (cohort)""")(retention)


_add_retention()


@query("""WITH s AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS since FROM orders GROUP BY 1)
SELECT strftime(date_trunc('month', since), '%Y-%m-%d') AS cohort, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS activity_period, count(DISTINCT o_custkey) AS active_count FROM orders JOIN s USING (o_custkey) WHERE CAST(o_orderdate AS DATE) >= since GROUP BY 1, 2""")
def m14_cohorts_monthly_orders(spark, sf):
    """Years of cohorts: customers by their first order."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("pubkey"), F.to_date("o_orderdate").alias("date"))
    days = o.groupBy("pubkey", "date").agg(F.count("*").alias("event_count"))
    since = days.groupBy("pubkey").agg(F.min("date").alias("since"))
    month = lambda c: F.trunc(c, "month")
    periods = days.join(since, "pubkey").where("since <= date").select("pubkey", month("since").alias("c"), month("date").alias("a")).distinct()
    return periods.groupBy("c", "a").agg(F.count("*").alias("active_count")).select(tm.shown(F.col("c")).alias("cohort"), tm.shown(F.col("a")).alias("activity_period"), "active_count")


@query(f"WITH {EV} SELECT CAST(created_at % 86400 // 3600 AS INT) AS hour, count(*) AS event_count, count(DISTINCT pubkey) AS unique_pubkeys, count(*) / 7.0::DOUBLE AS avg_per_day FROM ev WHERE created_at >= {WEEK_AGO} GROUP BY 1")
def q15_hourly(spark, sf):
    return ro.hourly_activity(events(spark, sf, since=WEEK_AGO), AS_OF)


@query(ZAPS + f" SELECT count(*) AS total_zaps, CAST(sum(amount_msats) // 1000 AS BIGINT) AS total_sats, count(DISTINCT zapper_pubkey) AS unique_zappers, count(DISTINCT recipient_pubkey) AS unique_recipients, avg(amount_msats) / 1000 AS avg_sats, median(amount_msats) / 1000 AS median_sats FROM z WHERE amount_msats > 0 AND created_at >= {MONTH_AGO}")
def q16_zaps_totals(spark, sf):
    return za.totals(amounts.zaps(social(spark, sf, since=MONTH_AGO, types=("purchase",))), AS_OF)


@query(ZAPS + " SELECT event_id, zapper_pubkey, created_at, amount_msats, recipient_pubkey, '' AS sender_pubkey FROM z")
def m15_zap_amounts(spark, sf):
    return amounts.zaps(social(spark, sf, types=("purchase",)))


_HISTOGRAM = "CASE " + " ".join(f"WHEN amount_msats <= {b}000 THEN {i}" for i, b in enumerate(za.BOUNDS)) + f" ELSE {len(za.BOUNDS)} END"


@query(ZAPS + f""", b AS (SELECT {_HISTOGRAM} AS i, count(*) AS c, sum(amount_msats) AS m FROM z WHERE amount_msats > 0 AND created_at >= {MONTH_AGO} GROUP BY 1)
SELECT {za.NAMES}[i + 1] AS bucket, CAST({[1] + [x + 1 for x in za.BOUNDS]}[i + 1] AS BIGINT) AS min_sats, CAST({[*za.BOUNDS, za.OPEN_END]}[i + 1] AS BIGINT) AS max_sats, c AS count, CAST(m // 1000 AS BIGINT) AS total_sats,
round(c * 100.0::DOUBLE / sum(c) OVER (), 2) AS pct_count, round(m * 100.0::DOUBLE / sum(m) OVER (), 2) AS pct_sats FROM b""")
def q17_zap_histogram(spark, sf):
    return za.histogram(amounts.zaps(social(spark, sf, since=MONTH_AGO, types=("purchase",))), AS_OF)


@query(f"""WITH {SO}, c AS (SELECT count(*) FILTER (kind = 1) AS n, count(*) FILTER (kind = 1 AND e IS NOT NULL) AS r, count(*) FILTER (kind = 7) AS x FROM so WHERE created_at >= {MONTH_AGO})
SELECT 30 AS period_days, n - r AS original_notes, r AS replies, x AS reactions, r / greatest(n - r, 1)::DOUBLE AS replies_per_note, x / greatest(n - r, 1)::DOUBLE AS reactions_per_note FROM c""")
def q18_engagement(spark, sf):
    return ro.engagement(social(spark, sf, since=MONTH_AGO), AS_OF)


@query("""SELECT count(*) AS articles, count(DISTINCT source) AS authors, avg(octet_length(encode(text))) AS avg_length, CAST(sum(octet_length(encode(text))) AS BIGINT) AS total_length, CAST(sum(octet_length(encode(text))) // 5 AS BIGINT) AS estimated_words FROM documents""")
def q19_long_form(spark, sf):
    docs = table(spark, sf, "documents").select(F.lit(30023).alias("kind"), F.col("source").alias("pubkey"), F.col("text").alias("content"))
    return ro.long_form(docs)


@query(f"WITH {EV} SELECT pubkey, count(*) AS event_count, count(DISTINCT kind) AS kinds_count, min(created_at) AS first_event, max(created_at) AS last_event FROM ev WHERE created_at >= {MONTH_AGO} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50")
def q20_publishers(spark, sf):
    return ro.publishers(events(spark, sf, since=MONTH_AGO), AS_OF, 30, 50)


@query(f"WITH {EV} SELECT kind, count(*) AS event_count, count(DISTINCT pubkey) AS unique_pubkeys, min(created_at) AS first_seen, max(created_at) AS last_seen FROM ev GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50")
def q22_kinds(spark, sf):
    return served_kinds(spark, sf).orderBy(F.desc("event_count"), "kind").limit(50)


@query(f"WITH {EV} SELECT kind, count(*) AS event_count, count(DISTINCT pubkey) AS unique_pubkeys, min(created_at) AS first_seen, max(created_at) AS last_seen FROM ev GROUP BY 1 ORDER BY 1 LIMIT 50")
def q22_kinds_by_kind(spark, sf):
    return served_kinds(spark, sf).orderBy("kind").limit(50)


@query(f"WITH {EV} SELECT count(*) AS events_7d, count(*) / 168.0::DOUBLE AS events_per_hour FROM ev WHERE created_at >= {WEEK_AGO} AND kind = 7")
def q08_throughput_of_kind(spark, sf):
    return ro.throughput(events(spark, sf, since=WEEK_AGO), AS_OF, kind=7)


@query(f"WITH {EV} SELECT kind, count(*) AS event_count, count(DISTINCT pubkey) AS unique_pubkeys, min(created_at) AS first_seen, max(created_at) AS last_seen FROM ev GROUP BY 1")
def m13_kinds_stats(spark, sf):
    return ro.kinds(events(spark, sf))


@query(f"""WITH {EV} SELECT 7 AS kind, count(*) AS event_count, count(DISTINCT pubkey) AS unique_pubkeys, min(created_at) AS first_seen, max(created_at) AS last_seen, avg(octet_length(encode(content))) AS avg_content_length,
count(*) FILTER (created_at >= {AS_OF - DAY}) AS events_24h, count(*) FILTER (created_at >= {WEEK_AGO}) AS events_7d, count(*) FILTER (created_at >= {MONTH_AGO}) AS events_30d FROM ev WHERE kind = 7""")
def q23_kind_detail(spark, sf):
    return ro.kind_detail(events(spark, sf), 7, AS_OF)


@query(f"WITH {EV} SELECT strftime(date_trunc('week', day), '%Y-%m-%d') AS period, count(*) AS count, count(DISTINCT pubkey) AS unique_pubkeys FROM ev WHERE kind = 3 GROUP BY 1 ORDER BY 1 DESC LIMIT 52")
def q24_kind_activity(spark, sf):
    return _activity(spark, sf, "week", 52)


def _activity(spark, sf, grain, most):
    own = served_kind_days[grain](spark, sf).where("kind = 3").orderBy(F.desc("p")).limit(most)
    return own.select(tm.shown(F.col("p")).alias("period"), "count", "unique_pubkeys")


@query(f"WITH {EV} SELECT strftime(day, '%Y-%m-%d') AS period, count(*) AS count, count(DISTINCT pubkey) AS unique_pubkeys FROM ev WHERE kind = 3 GROUP BY 1 ORDER BY 1 DESC LIMIT 30")
def q24_kind_activity_by_day(spark, sf):
    return _activity(spark, sf, "day", 30)


@query(f"WITH {EV} SELECT strftime(date_trunc('month', day), '%Y-%m-%d') AS period, count(*) AS count, count(DISTINCT pubkey) AS unique_pubkeys FROM ev WHERE kind = 3 GROUP BY 1 ORDER BY 1 DESC LIMIT 12")
def q24_kind_activity_by_month(spark, sf):
    return _activity(spark, sf, "month", 12)


# Users.


@query(STATS + " SELECT strftime(date, '%Y-%m-%d') AS date, pubkey, has_profile, has_follows, event_count FROM stats JOIN flags USING (pubkey)")
def m09_daily_user_stats(spark, sf):
    return _stats(spark, sf).withColumn("date", tm.shown(F.col("date")))


@query(SEEN + " SELECT pubkey, first_seen FROM seen")
def m10_first_seen(spark, sf):
    return us.first_seen(events(spark, sf), HOT)


# Tags and engagement.


@query(f"WITH {SO} SELECT id AS event_id, pubkey, kind, name AS tag_name, v AS tag_value_primary, '' AS tag_value_2, '' AS tag_value_3, '' AS tag_value_4, '' AS tag_value_5, 1 AS tag_value_count, created_at FROM so_tags")
def m01_tags_flat(spark, sf):
    return tg.flat(social(spark, sf)).drop("tag_full")


@query(f"WITH {SO} SELECT v AS target, max(created_at) AS deleted_at FROM so_tags WHERE name = 'e' AND kind = 6 GROUP BY 1")
def m02_deletions(spark, sf):
    own = social(spark, sf).withColumn("kind", F.when(F.col("kind") == 6, 5).otherwise(F.col("kind")))
    return en.deletions(own)


for _n, _f, _c, _k in (("m03_reactions", en.reactions, "reaction_count", "7"), ("m04_comments", en.comments, "comment_count", "1"), ("m05_reposts", en.reposts, "repost_count", "6, 16")):

    def _counter(spark, sf, f=_f):
        return f(social(spark, sf))

    _counter.__name__ = _n
    query(f"WITH {SO} SELECT v AS target, count(*) AS {_c} FROM so_tags WHERE name = 'e' AND kind IN ({_k}) GROUP BY 1")(_counter)


def _posts(spark, sf):
    """Orders as posts and their lines as what refers to them: return flag A a reaction, N a comment, R a repost."""
    posts = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").alias("pubkey"))
    kind = F.when(F.col("l_returnflag") == "A", 7).when(F.col("l_returnflag") == "N", 1).otherwise(6)
    lines = table(spark, sf, "lineitem").select(kind.alias("kind"), F.array(F.array(F.lit("e"), F.col("l_orderkey").cast("string"))).alias("tags"))
    return posts, lines


SCORED = """WITH x AS (SELECT l_orderkey, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS n, count(*) FILTER (l_returnflag NOT IN ('A', 'N')) AS r FROM lineitem GROUP BY 1),
v AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey AS pubkey, coalesce(a, 0) AS reactions, coalesce(n, 0) AS comments, coalesce(r, 0) AS reposts, coalesce(a, 0) + 2 * coalesce(n, 0) + 3 * coalesce(r, 0) AS engagement_score FROM orders LEFT JOIN x ON o_orderkey = l_orderkey)"""


@query(SCORED + " SELECT * FROM v")
def m06_scores(spark, sf):
    return en.scored(*_posts(spark, sf))


@query(SCORED + " SELECT pubkey, count(*) AS posts, CAST(sum(engagement_score) AS BIGINT) AS total_score, CAST(sum(reactions) AS BIGINT) AS total_reactions FROM v GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 50")
def m06_top_creators(spark, sf):
    return en.top_creators(en.scored(*_posts(spark, sf)), 50)


@query(f"""WITH {SO}, x AS (SELECT v AS target, count(*) FILTER (kind = 7) AS reactions, count(*) FILTER (kind = 1) AS comments, count(*) FILTER (kind IN (6, 16)) AS reposts FROM so_tags WHERE name = 'e' GROUP BY 1)
SELECT CAST(id AS VARCHAR) AS id, pubkey, created_at, coalesce(reactions, 0) AS reactions, coalesce(comments, 0) AS comments, coalesce(reposts, 0) AS reposts,
coalesce(reactions, 0) + 2 * coalesce(comments, 0) + 3 * coalesce(reposts, 0) AS engagement_score,
round((coalesce(reactions, 0) + 2 * coalesce(comments, 0) + 3 * coalesce(reposts, 0)) * exp(-({AS_OF // 3600} - created_at // 3600) / 168.0::DOUBLE), 9) AS trending_score
FROM so LEFT JOIN x ON CAST(so.id AS VARCHAR) = x.target WHERE so.kind = 1 AND so.created_at > {MONTH_AGO}""")
def m06_trending(spark, sf):
    all_ = social(spark, sf)
    posts = all_.where("kind = 1").select(F.col("id").cast("string").alias("id"), "pubkey", "created_at")
    return en.trending(en.scored(posts, all_), AS_OF).withColumn("trending_score", F.round("trending_score", 9))


@query(f"WITH {SO} SELECT v AS hashtag, count(*) AS post_count, count(DISTINCT id) AS unique_posts FROM so_tags WHERE name = 't' AND kind IN (1, 7) GROUP BY 1")
def m06_hashtags(spark, sf):
    all_ = social(spark, sf)
    return en.popular_hashtags(all_.where("kind IN (1, 7)"), all_)


@query(f"WITH {SO} SELECT pubkey, arg_max(content, created_at * 1000000 + id) AS content, max(created_at) AS last_update, count(*) AS update_count FROM so WHERE kind = 0 GROUP BY 1")
def m07_profiles(spark, sf):
    return en.profiles(social(spark, sf))


@query(f"WITH {EV} SELECT strftime(day, '%Y-%m-%d') AS day, kind, count(*) AS event_count, count(DISTINCT pubkey) AS unique_authors, avg(octet_length(encode(content))) AS avg_content_length FROM ev GROUP BY 1, 2")
def m08_event_stats(spark, sf):
    return ro.event_stats(events(spark, sf)).withColumn("day", tm.shown(F.col("day")))


@query(f"WITH {SO} SELECT name AS tag_name, count(*) AS tag_count, count(DISTINCT id) AS unique_events, count(DISTINCT v) AS unique_values FROM so_tags GROUP BY 1")
def m08_tag_stats(spark, sf):
    return ro.tag_stats(social(spark, sf))


@query(f"WITH {EV} SELECT kind, count(*) AS event_count, count(DISTINCT pubkey) AS unique_authors FROM ev WHERE created_at >= {AS_OF - 3 * DAY} GROUP BY 1")
def m08_activity_by_kind(spark, sf):
    return ro.activity_by_kind(events(spark, sf, since=AS_OF - 3 * DAY), AS_OF, 72)


# Lookups.


@query(f"WITH {EV} SELECT id, pubkey, created_at, kind, content FROM ev WHERE id = 77")
def q28_event_by_id(spark, sf):
    return events(spark, sf).where("id = 77").select("id", "pubkey", "created_at", "kind", "content")


@query(f"WITH {EV} SELECT pubkey, kind, id, created_at, content FROM ev QUALIFY row_number() OVER (PARTITION BY pubkey, kind ORDER BY created_at DESC, id DESC) = 1")
def q29_latest_by_key(spark, sf):
    return en.latest(events(spark, sf).select("id", "pubkey", "created_at", "kind", "content"), "pubkey", "kind")


@query(f"WITH {SO} SELECT id, pubkey, created_at, kind FROM so WHERE kind = 1 AND pubkey = 3 ORDER BY created_at DESC, id DESC LIMIT 1")
def q30_replaceable(spark, sf):
    return en.replaceable(social(spark, sf), 1, 3, "").select("id", "pubkey", "created_at", "kind")


@query(ZAPS + """ SELECT count(*) FILTER (kind = 7) AS reactions, count(*) FILTER (kind = 1) AS replies, count(*) FILTER (kind IN (6, 16)) AS reposts,
count(z.event_id) AS zap_count, CAST(coalesce(sum(amount_msats), 0) // 1000 AS BIGINT) AS zap_sats FROM so LEFT JOIN z ON so.id = z.event_id WHERE so.e = '42'""")
def q31_engagement_of_event(spark, sf):
    all_ = social(spark, sf)
    return en.of_event(all_, amounts.zaps(all_), "42")


@query(f"""WITH {EV} SELECT pubkey, arg_max(content, created_at * 1000000 + id) AS content FROM ev WHERE pubkey IN (1, 2, 3, 5, 8) AND kind < 50 GROUP BY 1""")
def q32_batch_lookup(spark, sf):
    keys = spark.createDataFrame([(k,) for k in (1, 2, 3, 5, 8)], "pubkey long")
    # The keys are a literal list.
    own = events(spark, sf).where("kind < 50").join(F.broadcast(keys), "pubkey", "left_semi")
    return own.groupBy("pubkey").agg(F.max_by("content", F.struct("created_at", "id")).alias("content"))


@query("SELECT c_custkey AS pubkey, c_name AS display_name FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, concat('new ', c_name) FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 = 0")
def q32_display_names(spark, sf):
    """Names of all authors from their newest profiles: customers as profiles, every third with a second one, some of these without a name."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("pubkey"), "c_name", F.lit(0).alias("kind"))
    first = c.select("pubkey", "kind", (F.col("pubkey") * 2).alias("id"), F.lit(1000).alias("created_at"), F.to_json(F.struct(F.col("c_name").alias("name"))).alias("content"))
    name = F.when(F.col("pubkey") % 2 == 0, F.concat(F.lit("new "), "c_name"))
    second = c.where("pubkey % 3 = 0").select("pubkey", "kind", (F.col("pubkey") * 2 + 1).alias("id"), F.lit(2000).alias("created_at"), F.to_json(F.struct(name.alias("display_name"))).alias("content"))
    return en.display_names(first.unionByName(second))
