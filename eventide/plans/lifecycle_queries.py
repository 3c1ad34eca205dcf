"""Named queries of the lifecycle operators over the mapped archive."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.functions import tags as tg
from eventide.functions import text as tx
from eventide.functions import time as tm
from eventide.operators import compact as co
from eventide.operators import engagement as en
from eventide.operators import lifecycle as li
from eventide.operators import reconcile as rc
from eventide.operators import rollups as ro
from eventide.operators import sharded as sh
from eventide.operators import sketches as sk
from eventide.operators import users as us
from eventide.operators.relays import insert_missing, replace_rows
from eventide.plans.mapping import AS_OF, EV, SO, events, social, table
from eventide.schema import DAY
from eventide.session import shared
from eventide.sources import canonical as ca
from eventide.sources import files as fi

QUERIES: dict = {}
SQL: dict[str, str] = {}
#: A moment that cuts the archive into a base and a delta; late events reach back before it.
CUT = AS_OF - 10 * DAY


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _base(spark, sf):
    return events(spark, sf).where((F.col("created_at") < CUT) & (F.col("id") % 17 != 0))


def _delta(spark, sf):
    """Later events, late ones, and some that the base has already."""
    return events(spark, sf).where((F.col("created_at") >= CUT) | (F.col("id") % 17 == 0) | (F.col("id") % 13 == 0))


@query(f"WITH {EV} SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS events, min(created_at) AS first, max(created_at) AS last, count(DISTINCT kind) AS kinds FROM ev GROUP BY 1")
def k01_canonical_files(spark, sf):
    """The archive as canonical files, each row twice on the way in; written by the tasks, held to the format's rules, and read back."""
    hexed = lambda c: F.sha2(F.col(c).cast("string"), 256)
    own = events(spark, sf).select(hexed("id").alias("id"), hexed("pubkey").alias("pubkey"), "created_at", "kind", F.array(F.array(F.lit("t"), "event_type")).alias("tags"), "content", F.repeat(hexed("id"), 2).alias("sig"))
    rows, path = fi.lake_rows(own), shared(spark, "canonical")
    ca.write_canonical(rows.unionAll(rows), path, most_bytes=4 << 20)
    faults = ca.verify(spark, path).limit(5).collect()
    if faults:
        raise ValueError(f"files break the rules: {faults}")
    at = F.col("created_at").cast("bigint")
    back = ca.read_canonical(spark, path).groupBy(tm.shown(tm.day(at)).alias("day"))
    return back.agg(F.count("*").alias("events"), F.min(at).alias("first"), F.max(at).alias("last"), F.count_distinct("kind").alias("kinds"))


@query(f"WITH {EV} SELECT id, created_at, kind FROM ev")
def l01_canonical_dedupe(spark, sf):
    own = events(spark, sf)
    return ro.distinct_events(own.unionByName(own.where("id % 5 = 0")))


@query(f"WITH {EV} SELECT id, 2 AS n_versions FROM ev WHERE id % 100 = 0")
def l02_conflicts(spark, sf):
    own = events(spark, sf)
    return ro.conflicts(own.unionByName(own.where("id % 100 = 0").withColumn("kind", F.col("kind") + 1)))


@query(f"WITH {EV} SELECT strftime(day, '%Y-%m-%d') AS day, kind, count(*) AS event_count FROM ev GROUP BY 1, 2")
def l08_incremental_daily_kind(spark, sf):
    """Base and delta, late and repeated events included, give what the whole gives."""
    made = li.apply_delta(li.build(_base(spark, sf)), _delta(spark, sf))
    return made.daily_kind.withColumn("day", tm.shown(F.col("day")))


@query(f"WITH {EV} SELECT kind, count(*) AS event_count FROM ev GROUP BY 1")
def l08_incremental_kinds(spark, sf):
    made = li.apply_delta(li.build(_base(spark, sf)), _delta(spark, sf))
    return li.apply_delta(made, _delta(spark, sf)).kinds


@query(f"WITH {EV} SELECT pubkey, min(created_at) AS first_seen FROM ev WHERE kind NOT IN (44, 45) GROUP BY 1")
def l09_first_seen_advance(spark, sf):
    seen = lambda df: us.first_seen(df, (44, 45))
    return us.advance(seen(_base(spark, sf)), seen(_delta(spark, sf)))


@query(f"WITH {EV} SELECT count(*) + count(*) FILTER (id % 5 = 0) AS physical, count(*) AS logical, count(*) FILTER (id % 5 = 0) AS duplicate, count(*) AS representable FROM ev")
def l10_accounting(spark, sf):
    own = events(spark, sf)
    made = li.build(own.unionByName(own.where("id % 5 = 0")))
    li.check(made)
    return made.accounting()


_TWO = f"""WITH {EV}, l AS (SELECT day, count(*) AS v FROM ev WHERE kind <> 7 GROUP BY 1), r AS (SELECT day, count(*) AS v FROM ev WHERE kind <> 7 OR day < DATE '2024-01-10' GROUP BY 1 HAVING day > DATE '2024-01-03'),
c AS (SELECT strftime(coalesce(l.day, r.day), '%Y-%m-%d') AS day, l.v AS left_value, r.v AS right_value, CASE WHEN r.day IS NULL THEN 'only_left' WHEN l.day IS NULL THEN 'only_right' WHEN l.v = r.v THEN 'equal' ELSE 'different' END AS class FROM l FULL JOIN r ON l.day = r.day)"""


def _two(spark, sf):
    day = lambda df: ro.daily(ro.distinct_events(df))
    own = events(spark, sf)
    cut = F.lit("2024-01-10").cast("date")
    left = day(own.where("kind <> 7"))
    right = day(own.where((F.col("kind") != 7) | (tm.day("created_at") < cut))).where(F.col("day") > F.lit("2024-01-03").cast("date"))
    return li.compare_series(left, right, ["day"], "event_count")


@query(_TWO + " SELECT * FROM c")
def l12_series_diff(spark, sf):
    return _two(spark, sf).withColumn("day", tm.shown(F.col("day")))


@query(_TWO + " SELECT count(*) AS keys, count(*) FILTER (class = 'equal') AS equal, count(*) FILTER (class = 'different') AS different, count(*) FILTER (class = 'only_left') AS only_left, count(*) FILTER (class = 'only_right') AS only_right FROM c")
def l12_series_summary(spark, sf):
    return li.compare_summary(_two(spark, sf))


@query(_TWO + " SELECT * FROM c WHERE class <> 'equal' ORDER BY day LIMIT 5")
def t11_examples(spark, sf):
    return li.examples(_two(spark, sf), 5).withColumn("day", tm.shown(F.col("day")))


@query(f"WITH {EV}, d AS (SELECT strftime(day, '%Y-%m-%d') AS k, CAST(count(*) AS VARCHAR) AS v FROM ev GROUP BY 1) SELECT sha256(concat(CAST(string_agg(replace(concat(k, '|', v), '|', chr(0)) || chr(10), '' ORDER BY k) AS VARCHAR))) AS digest FROM d")
def a23_series_digest(spark, sf):
    days = ro.daily(ro.distinct_events(events(spark, sf)))
    return li.small_series_digest(days, tm.shown(F.col("day")), F.col("event_count"))


@query(f"WITH {EV} SELECT id, CASE WHEN id % 3 = 0 THEN 'only_right' WHEN id % 7 = 0 THEN 'only_left' ELSE 'both' END AS side FROM ev")
def j12_align_ids(spark, sf):
    own = events(spark, sf)
    return li.align(own.where("id % 3 <> 0"), own.where("id % 7 <> 0 OR id % 3 = 0"))


@query(f"WITH {EV} SELECT lpad(CAST(id % 100 AS VARCHAR), 2, '0') AS shard, count(*) AS left_rows, count(*) FILTER (id <> 7 AND id <> 150) AS right_rows, count(*) FILTER (id = 7 OR id = 150) = 0 AS equal FROM ev GROUP BY 1")
def l13_shard_compare(spark, sf):
    own = events(spark, sf).select("id")
    prefix = F.concat(F.lpad((F.col("id") % 100).cast("string"), 2, "0"), F.col("id").cast("string"))
    return li.shard_compare(own, own.where("id NOT IN (7, 150)"), prefix)


@query(f"WITH {EV} SELECT id, CASE WHEN id % 9 <> 0 THEN concat('object-', CAST(id % 4 AS VARCHAR)) END AS object_key FROM ev WHERE id % 50 = 0 OR id % 45 = 0")
def l14_gap_attribution(spark, sf):
    own = events(spark, sf).select("id")
    lake = own.where("id % 9 <> 0").withColumn("file", F.concat(F.lit("part-"), (F.col("id") % 4).cast("string")))
    catalog = spark.createDataFrame([(f"object-{i}", f"part-{i}") for i in range(4)], "object_key string, file string")
    return li.attribute(own.where("id % 50 = 0 OR id % 45 = 0"), lake, catalog)


@query(f"WITH {EV} SELECT id, kind FROM ev WHERE id % 11 = 0")
def l22_missing_rows(spark, sf):
    own = events(spark, sf).select("id", "kind")
    return li.missing_rows(own, own.where("id % 11 <> 0"))


@query(f"WITH {EV} SELECT count(*) FILTER (id % 11 = 0 AND id % 13 <> 0) AS only_left, count(*) FILTER (id % 13 = 0 AND id % 11 <> 0) AS only_right FROM ev")
def l23_equal_rows(spark, sf):
    own = events(spark, sf).select("id", "kind")
    return li.equal_rows(own, own.where("id % 11 <> 0").unionByName(own.where("id % 13 = 0")))


@query(f"WITH {EV} SELECT id, created_at FROM ev WHERE created_at >= {AS_OF - 14 * DAY} AND id % 4 = 0")
def w09_sync_missing(spark, sf):
    own = events(spark, sf)
    return li.sync_missing(own.where("id % 4 <> 0"), own, AS_OF, 14 * DAY)


@query(f"WITH {EV} SELECT id, created_at FROM ev WHERE created_at >= {AS_OF - 14 * DAY} AND (id % 97 = 0 OR (created_at // 3600) % 50 = 0)")
def w09_reconcile(spark, sf):
    """What we lack of a peer's window, single ids and whole hours, found by fingerprints of ranges."""
    own = events(spark, sf, since=AS_OF - 14 * DAY)
    lost = (F.col("id") % 97 == 0) | (F.floor(F.col("created_at") / 3600) % 50 == 0)
    return rc.reconcile(own.where(~lost), own, shared(spark, "reconcile")).missing


@query(f"WITH {EV} SELECT id, created_at FROM ev WHERE created_at >= {AS_OF - 14 * DAY} AND id % 4 <> 0")
def w09_sync_prune(spark, sf):
    own = events(spark, sf).select("id", "created_at")
    return li.prune_sync(own, own.where("id % 4 <> 0"), AS_OF, 14 * DAY)


@query(f"""WITH {SO}, r AS (SELECT id, v FROM so_tags WHERE name = 'e' AND id % 2 = 0) SELECT count(*) AS referenced, count(*) FILTER (CAST(v AS BIGINT) % 3 <> 1) AS present, count(*) FILTER (CAST(v AS BIGINT) % 3 <> 1) / CAST(count(*) AS DOUBLE) AS coverage FROM r""")
def w10_coverage(spark, sf):
    own = social(spark, sf)
    refs = tg.exploded(own, "e").select("id", F.col("target").alias("reference"))
    return li.coverage(own.where("id % 2 = 0"), own.where("id % 3 <> 1"), refs)


@query(f"WITH {EV} SELECT id FROM ev WHERE id % 16 < 4")
def p15_sample_gate(spark, sf):
    first_byte = F.lpad(F.lower(F.hex(F.col("id") % 16 * 16)), 2, "0")
    return li.sampled(events(spark, sf), first_byte, 0.25).select("id")


@query(f"WITH {EV} SELECT pubkey, max(created_at) AS created_at, arg_max(kind, created_at * 1000000 + id) AS kind FROM ev GROUP BY 1")
def k11_replace_rows(spark, sf):
    own = en.latest(events(spark, sf).select("id", "pubkey", "created_at", "kind"), "pubkey")
    old = en.latest(_base(spark, sf).select("id", "pubkey", "created_at", "kind"), "pubkey")
    return replace_rows(old.drop("id"), own.drop("id"), ["pubkey"], "created_at")


@query(f"WITH {EV} SELECT kind, min(id) FILTER (id < 5000) AS a, min(id) AS b FROM ev GROUP BY 1")
def k12_insert_missing(spark, sf):
    """Kinds of low ids first, then those of all: what is there stays."""
    own = events(spark, sf).select("kind", "id")
    low = own.where("id < 5000").groupBy("kind").agg(F.min("id").alias("id"))
    full = insert_missing(low, own, ["kind"]).withColumnRenamed("id", "a")
    return full.join(own.groupBy("kind").agg(F.min("id").alias("b")), "kind").withColumn("a", F.when(F.col("a") < 5000, F.col("a")))


@query("SELECT o_orderkey AS id, o_custkey AS pubkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40")
def t03_page(spark, sf):
    return table(spark, sf, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(40).limit(20).select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("pubkey"))


@query(f"""WITH {EV}, x AS (SELECT *, lag(kind) OVER (PARTITION BY pubkey ORDER BY id) AS b FROM ev) SELECT id, pubkey FROM x WHERE b >= kind""")
def t09_order_violations(spark, sf):
    rows = events(spark, sf).select("id", "pubkey", "kind").withColumn("row_nr", F.col("id"))
    return li.order_violations(rows, "pubkey", "kind").select("id", "pubkey")


@query("""SELECT doc_id, octet_length(encode(text)) AS n_bytes, length(text) AS n_chars_text,
CASE WHEN octet_length(encode(text)) > 80 THEN concat(substr(text, 1, list_max([k FOR k IN range(81) IF octet_length(encode(substr(text, 1, k))) <= 80])), '...') ELSE text END AS short FROM documents""")
def c13_shortened(spark, sf):
    t = F.col("text")
    return table(spark, sf, "documents").select("doc_id", tx.byte_length(t).alias("n_bytes"), F.char_length(t).alias("n_chars_text"), tx.shortened(t, 80).alias("short"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN s >= 1000 THEN concat(printf('%.1f', s / 1000.0::DOUBLE), 'K sats') ELSE concat(CAST(s AS VARCHAR), ' sats') END AS shown
FROM (SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice) AS BIGINT) AS s FROM lineitem)""")
def c14_short_amounts(spark, sf):
    amount = F.round("l_extendedprice").cast("bigint")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", tx.sats(amount * 1000).alias("shown"))


@query(f"""WITH {EV}, k AS (SELECT DISTINCT kind FROM ev)
SELECT kind, CASE kind WHEN 0 THEN 'Profile' WHEN 1 THEN 'Note' WHEN 3 THEN 'Contacts' WHEN 6 THEN 'Repost' WHEN 7 THEN 'Reaction' WHEN 16 THEN 'Generic Repost' ELSE concat('Kind ', CAST(kind AS VARCHAR)) END AS label FROM k""")
def c17_kind_labels(spark, sf):
    return events(spark, sf).select("kind").distinct().select("kind", tx.kind_label(F.col("kind")).alias("label"))


@query("SELECT conv_id, count(*) AS messages, count(*) FILTER (turn > 0) AS replies, max(turn) AS last_turn FROM conversations GROUP BY 1")
def n16_reply_counts(spark, sf):
    return table(spark, sf, "conversations").groupBy("conv_id").agg(F.count("*").alias("messages"), F.count_if(F.col("turn") > 0).alias("replies"), F.max("turn").alias("last_turn"))


@query()
def a13_sketch_days(spark, sf):
    """Estimates: no equal SQL; held against exact counts in the tests."""
    return sk.estimated(sk.merged(sk.states(events(spark, sf), tm.day("created_at")), tm.monday(F.col("key")))).withColumn("merged_key", tm.shown(F.col("merged_key")))


@query()
def a03_approximate(spark, sf):
    return sk.approximate(events(spark, sf), F.col("kind"))


def _hexed(spark, sf):
    return events(spark, sf).select(F.sha2(F.col("id").cast("string"), 256).alias("id"), F.col("id").alias("nr"))


@query("""SELECT sha256(CAST(event_id AS VARCHAR)) AS id, CASE WHEN event_id % 701 = 0 THEN 'only_right' ELSE 'only_left' END AS side FROM events WHERE (event_id % 701 = 0) <> (event_id % 499 = 0)""")
def l13_resumed_compare(spark, sf):
    """Ids of one side only, by a comparison that is stopped after its first round and goes on."""
    own, work = _hexed(spark, sf), shared(spark, "compare")
    sides = own.where("nr % 701 <> 0").select("id"), own.where("nr % 499 <> 0").select("id")
    sh.compare(*sides, work, few=20_000, rounds=1, at_once=8)
    if not sh.compare(*sides, work, few=20_000):
        raise ValueError("prefixes are open")
    return sh.differences(spark, work)


@query(f"WITH {EV} SELECT kind % 10 AS digit, count(*) AS events, min(created_at) AS first, max(created_at) AS last FROM ev GROUP BY 1")
def l05_compaction(spark, sf):
    """The archive as four additions that overlap, merged by levels, read back."""
    own, base = events(spark, sf), shared(spark, "levels")
    hexed = lambda c: F.sha2(F.col(c).cast("string"), 256)
    rows = fi.lake_rows(own.select(hexed("id").alias("id"), hexed("pubkey").alias("pubkey"), "created_at", "kind", F.array(F.array(F.lit("n"), F.col("id").cast("string"))).alias("tags"), "content", F.repeat(hexed("id"), 2).alias("sig")))
    nr = F.get(F.get("tags", F.lit(0)), F.lit(1)).cast("bigint")
    for i in range(4):
        co.add(spark, base, rows.where((nr % 4 == i) | (nr % 50 == 0)))
    co.compact(spark, base, fan_in=3, most_per_level=1)
    at = F.col("created_at").cast("bigint")
    return co.read(spark, base).groupBy((F.col("kind") % 10).alias("digit")).agg(F.count("*").alias("events"), F.min(at).alias("first"), F.max(at).alias("last"))


@query(f"""WITH {EV}, b AS (SELECT * FROM ev WHERE id % 31 <> 0), t AS (SELECT unnest(['events', 'pubkeys', 'kinds', 'latest']) AS name, unnest([(SELECT count(*) FROM ev), (SELECT count(DISTINCT pubkey) FROM ev), (SELECT count(DISTINCT kind) FROM ev), (SELECT max(created_at) FROM ev)]) AS l,
unnest([(SELECT count(*) FROM b), (SELECT count(DISTINCT pubkey) FROM b), (SELECT count(DISTINCT kind) FROM b), (SELECT max(created_at) FROM b)]) AS r) SELECT name, l AS left_value, r AS right_value, r - l AS difference, CASE WHEN l = r THEN 'equal' ELSE 'different' END AS class FROM t""")
def l12_scalar_diff(spark, sf):
    facts = lambda df: df.agg(F.count("*").alias("events"), F.count_distinct("pubkey").alias("pubkeys"), F.count_distinct("kind").alias("kinds"), F.max("created_at").alias("latest"))
    own = events(spark, sf)
    out = li.compare_scalars(facts(own), facts(own.where("id % 31 <> 0")))
    return out.select("name", *[F.col(c).cast("bigint").alias(c) for c in ("left_value", "right_value", "difference")], "class")


def _classed(spark, sf):
    """Events that a copy lacks; two versions are known of every other one, none of some."""
    own = events(spark, sf)
    versions = own.where("id % 11 <> 0").select("id", "created_at", "kind", (F.col("created_at") + F.col("id") % 1000).alias("indexed_at"), F.col("event_type").alias("source"))
    again = versions.where("id % 2 = 0").withColumn("indexed_at", F.col("indexed_at") + 5000).withColumn("source", F.lit("again"))
    return li.residual(own.where("id % 7 = 0").select("id"), versions.unionByName(again), CUT)


@query(f"""WITH {EV}, m AS (SELECT id, created_at + id % 1000 AS first, created_at, id % 11 = 0 AS lost, id % 2 = 0 AS twice FROM ev WHERE id % 7 = 0), c AS (SELECT *, CASE WHEN lost THEN 'unknown' WHEN first < {CUT} THEN 'before_live' ELSE 'after_live' END AS class FROM m)
SELECT class, count(*) AS ids, CAST(sum(CASE WHEN lost THEN 0 WHEN twice THEN 2 ELSE 1 END) AS BIGINT) AS versions, coalesce(quantile_disc(first - created_at, 0.5) FILTER (NOT lost), -1) AS late_p50, coalesce(max(first - created_at) FILTER (NOT lost), -1) AS late_max, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM m), 6) AS percent FROM c GROUP BY 1""")
def l15_residual(spark, sf):
    late = {c: F.coalesce(F.col(c).cast("bigint"), F.lit(-1)) for c in ("late_p50", "late_max")}
    return li.residual_summary(_classed(spark, sf)).withColumns(late | {"percent": F.round(F.col("percent").cast("double"), 6)})


@query(f"""WITH {EV}, m AS (SELECT id, CASE WHEN id % 11 = 0 THEN 'unknown' WHEN created_at + id % 1000 < {CUT} THEN 'before_live' ELSE 'after_live' END AS class, CASE WHEN id % 11 = 0 THEN NULL WHEN id % 2 = 0 THEN 'again' ELSE event_type END AS value FROM ev WHERE id % 7 = 0) SELECT class, value, count(*) AS ids FROM m GROUP BY 1, 2""")
def l15_attribution(spark, sf):
    return li.attribution(_classed(spark, sf), "source")
