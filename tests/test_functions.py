"""Tags, text, amounts, identifiers, relay URLs."""

import pytest
from pyspark.sql import functions as F

from eventide.functions import amounts, bech32
from eventide.functions import tags as tg
from eventide.functions import text as tx
from eventide.operators import engagement as en
from eventide.operators import relays as re
from eventide.operators import zaps as za

A, B, C = "a" * 64, "b" * 64, "c" * 64
EV = "id string, pubkey string, created_at long, kind int, tags array<array<string>>, content string"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("invoice", "expected"), [("lnbc10m1x", 1_000_000_000), ("lnbc210u1x", 21_000_000), ("lnbc500n1x", 50_000), ("lnbc25p1x", 2), ("lnbc11m1x", 0), ("lnbc21x", 0), ("lnbc99999999999999999999m1x", 0), ("", 0), ("xlnbc1m1", 0)])
def test_amounts(spark, invoice, expected):
    assert one(spark, amounts.msats(F.lit(invoice))) == expected


def test_zaps_without_unit_are_no_rows(spark):
    e = spark.createDataFrame([("1", "z", 5, 9735, [["bolt11", "lnbc500n1q"], ["p", "r"]], ""), ("2", "z", 6, 9735, [["bolt11", "lnbc211q"]], ""), ("3", "z", 7, 9735, [["bolt11"]], ""), ("4", "z", 8, 1, [["bolt11", "lnbc500n1q"]], "")], EV)
    rows = amounts.zaps(e).collect()
    assert [(r.event_id, r.amount_msats, r.recipient_pubkey, r.sender_pubkey) for r in rows] == [("1", 50_000, "r", "")]


def test_histogram_bounds(spark):
    sats = [10, 11, 21, 22, 50, 51, 100, 101, 250, 500, 750, 1000, 2500, 5000, 7500, 10000, 25000, 50000, 75000, 100000, 100001]
    z = spark.createDataFrame([(str(i), "z", 0, s * 1000, "r") for i, s in enumerate(sats)], "event_id string, zapper_pubkey string, created_at long, amount_msats long, recipient_pubkey string")
    rows = {r.bucket: r for r in za.histogram(z, 0).collect()}
    assert len(rows) == 17 and rows["11-21 sats"]["count"] == 2 and rows["100K+ sats"]["count"] == 1 and rows["1-10 sats"].min_sats == 1
    assert abs(sum(r.pct_count for r in rows.values()) - 100) < 0.1 and za.histogram(z.where("amount_msats < 0"), 0).count() == 0


@pytest.mark.parametrize(("url", "expected"), [
    (" WSS://Relay.Example/ ", "wss://relay.example"), ("wss://relay.example:443/", "wss://relay.example"), ("ws://relay.example:80", "ws://relay.example"), ("wss://relay.example:8443/p/", "wss://relay.example:8443/p"),
    ("http://x.example", None), ("wss://foo.local", None), ("wss://a.example wss://b.example", None), ("wss://10.0.0.1", None), ("wss://100.64.1.1", None), ("wss://172.20.0.1", None), ("wss://8.8.8.8", "wss://8.8.8.8"),
    ("wss://[::1]", None), ("wss://[2001:db9::1]:4848", "wss://[2001:db9::1]:4848"), ("wss://x.onion", None), ("wss://localhost", None), ("wss://relay.example:22", None), ("wss://relay.example:99999", None), ("", None), (None, None),
])
def test_relay_urls(spark, url, expected):
    assert one(spark, tx.relay_url(F.lit(url).cast("string"))) == expected


def test_distribution_keeps_the_newest_list(spark):
    row = lambda i, who, at, *tags: (str(i), who, at, 10002, [list(t) for t in tags], "")
    e = spark.createDataFrame([row(1, "a", 1, ("r", "wss://old.example")), row(2, "a", 2, ("r", " WSS://Relay.Example/ ", "read"), ("r", "wss://relay.example:443/")), row(3, "b", 1, ("r", "wss://relay.example"), ("r", "ws://x"), ("r", "wss://foo.local"), ("r",))], EV)
    rows = re.distribution(e, 1).collect()
    assert [tuple(r) for r in rows] == [("wss://relay.example", 3, 3, 2)]


def test_tags(spark):
    e = spark.createDataFrame([("1", "p", 9, 1, [["e", A, "", "root"], ["e", B, "", "reply"], ["p", C], ["d", "x"], ["title"], []], "hi"), ("2", "p", 9, 1, [], "")], EV)
    flat = tg.flat(e).collect()
    assert len(flat) == 6 and flat[0].tag_value_primary == A and flat[0].tag_value_3 == "root" and flat[5].tag_name == ""
    d = tg.derived(e).orderBy("id").first()
    assert (d.d_tag, d.title, d.thumbnail) == ("x", "", "")
    assert [tuple(r) for r in tg.parent(e).collect()] == [("1", B, C)]
    assert one(spark, tg.has_empty(F.array(F.array().cast("array<string>")))) and {r.reference for r in tg.references(e).collect()} == {A, B}


def test_parent_rules(spark):
    def parent(*tags):
        rows = tg.parent(spark.createDataFrame([("1", "p", 1, 1, [list(t) for t in tags], "")], EV)).collect()
        return rows[0].parent if rows else None

    assert parent(("e", A), ("e", B)) == B and parent(("e", A, "", "root"), ("e", B)) == A and parent(("e", "zz")) is None and parent() is None
    assert parent(("e", A, "", "mention"), ("e", B, "", "root")) == B


def test_discovery(spark):
    e = spark.createDataFrame([("1", "m", 5, 30166, [["d", "wss://Relay.Example/"], ["N", "77"], ["N", "1"], ["N", "x"], ["R", "auth"], ["rtt-open", "12"], ["rtt-read", "-1"], ["n", "clearnet"], ["g", "u1"], ["g", "u2"]], ""), ("2", "m", 5, 30166, [], "")], EV)
    (r,) = tg.discovery(e).collect()
    assert (r.relay_id, list(r.supported_nips), list(r.requirements), r.rtt_open, r.rtt_read, r.rtt_write, r.geohash) == ("wss://relay.example", [1, 77], ["auth"], 12, None, None, "u2")


def test_engagement_and_lookups(spark):
    e = spark.createDataFrame([
        ("v", "a", 100, 1, [["t", "x"]], "post"), ("r1", "b", 1, 7, [["e", "v"]], ""), ("c1", "b", 1, 1, [["e", "v"]], ""), ("s1", "b", 1, 6, [["e", "v"]], ""), ("s2", "b", 1, 16, [["e", "v"]], ""), ("d", "a", 7, 5, [["e", "q"]], ""), ("d2", "a", 9, 5, [["e", "q"]], ""),
        ("p1", "a", 1, 0, [], '{"name":"old"}'), ("p2", "a", 2, 0, [], '{"display_name":"  ","name":"new"}'), ("p3", "c", 2, 0, [], "no json"), ("n1", "a", 3, 30023, [["d", "s"]], "x"), ("n2", "a", 3, 30023, [["d", "s"]], "y"), ("z", "k", 5, 9735, [["e", "v"], ["bolt11", "lnbc500n1q"]], ""),
    ], EV)
    s = en.scored(e.where("id = 'v'"), e).first()
    assert (s.reactions, s.comments, s.reposts, s.engagement_score) == (1, 1, 2, 9)
    assert [tuple(r) for r in en.deletions(e).collect()] == [("q", 9)]
    assert {r.pubkey: r.display_name for r in en.display_names(e).collect()} == {"a": "  "}
    assert en.replaceable(e, 30023, "a", "s").first().id == "n2" and en.trending(en.scored(e.where("id = 'v'"), e), 100).first().trending_score == 9.0
    o = en.of_event(e, amounts.zaps(e), "v").first()
    assert (o.reactions, o.replies, o.reposts, o.zap_count, o.zap_sats) == (1, 1, 2, 1, 50)
    assert en.by_ids(e, spark.createDataFrame([("v",), ("v",), ("none",)], "id string")).count() == 1
    assert tg.repost_target(e).count() == 2 and en.profiles(e).where("pubkey = 'a'").first().update_count == 2


def test_bech32(spark):
    # Published example values.
    key = "3bf0c63fcb93463407af97a5e5ee64fa883d107ef9e558472c4eb9aaaefa459d"
    npub = "npub180cvv07tjdrrgpa0j7j7tmnyl2yr6yr7l8j4s3evf6u64th6gkwsyjh6w6"
    assert bech32.encode("npub", bytes.fromhex(key)) == npub and bech32.parse("nostr:" + npub) == {"type": "profile", "hex": key}
    nevent = bech32.compose("nevent", (0, bytes.fromhex(A)), (1, b"wss://r.example"))
    assert bech32.parse(nevent) == {"type": "event", "hex": A}
    naddr = bech32.compose("naddr", (0, b"slug"), (2, bytes.fromhex(key)), (3, (30023).to_bytes(4, "big")))
    assert bech32.parse(naddr) == {"type": "address", "d": "slug", "pubkey": key, "kind": 30023}
    for bad in (npub[:-1] + "q", "npub1", "hello", npub.replace("npub", "Npub"), "nsec1" + npub[5:]):
        with pytest.raises(ValueError):
            bech32.parse(bad)
    df = spark.createDataFrame([(npub,), ("junk",), (None,), (naddr,)], "x string")
    assert [r.h for r in df.select(bech32.to_hex("x").alias("h")).collect()] == [key, None, None, None]
    e = spark.createDataFrame([(A, "k", 1, 1, [], ""), ("p", key, 1, 0, [], "{}"), ("n", key, 1, 30023, [["d", "slug"]], "")], EV)
    assert en.resolve(e, A).first().id == A and en.resolve(e, key).first().id == "p" and en.resolve(e, naddr).first().id == "n" and en.resolve(e, npub).first().id == "p"


def test_text(spark):
    got = one(spark, tx.segments(F.lit("see https://x.example/a.png?q=1 and nostr:npub1qqq done")))
    assert [(s.type, s.value) for s in got] == [("text", "see "), ("url", "https://x.example/a.png?q=1"), ("text", " and "), ("reference", "nostr:npub1qqq"), ("text", " done")]
    assert one(spark, tx.url_class(F.lit("https://x/a.PNG?x=1"))) == "image" and one(spark, tx.url_class(F.lit("https://x/a.mp4"))) == "video" and one(spark, tx.url_class(F.lit("https://x/"))) == "link"
    tags = F.array(F.array(F.lit("p"), F.lit("k")), F.array(F.lit("e"), F.lit("v")), F.array(F.lit("t"), F.lit("z")))
    assert one(spark, tx.resolved(F.lit("a #[0] b #[1]c #[2] #[9] #[x]"), tags)) == "a profile:k b event:vc #[2] #[9] #[x]"
    # Ties go the way of the double: 1.25 is exact (to even), 1.15 lies below its tie, 1.35 above.
    shown = {999: "999", 1_000: "1.0K", 1_150: "1.1K", 1_250: "1.2K", 1_350: "1.4K", 1_750: "1.8K", 999_950: "1000.0K", 1_250_000: "1.2M", 1_260_000: "1.3M", 1_350_000: "1.4M", 2_349_999: "2.3M", 9_876_543_210: "9876.5M"}
    for n, want in shown.items():
        assert one(spark, tx.short_number(F.lit(n))) == want, n
    assert one(spark, tx.sats(F.lit(2_560_999))) == "2.6K sats" and one(spark, tx.sats(F.lit(999_999))) == "999 sats"
    # By bytes: ä and ö are two, € is three.
    assert [one(spark, tx.shortened(F.lit("äö€x"), n)) for n in (8, 7, 6, 5, 4, 3, 2, 1)] == ["äö€x", "äö€...", "äö...", "äö...", "äö...", "ä...", "ä...", "..."]
    assert one(spark, tx.shortened(F.lit("ab  cd"), 4)) == "ab  ..." and one(spark, tx.shortened(F.lit("🦀🦀"), 7)) == "🦀..."
    assert one(spark, tx.short_key(F.lit("0123456789abcdefg"))) == "0123456789ab...defg" and one(spark, tx.short_key(F.lit("0123456789abcdef"))) == "0123456789abcdef"
    assert one(spark, tx.short_npub(F.lit("0123456789abcdef" * 2 + "z"))) == "0123456789abcdef...56789abcdefz"
    assert one(spark, tx.shortened_url(F.lit("https://" + "a" * 51))) == "a" * 47 + "..." and one(spark, tx.shortened_url(F.lit("http://example.com"))) == "example.com"
    labels = {3: "Contacts", 16: "Generic Repost", 1063: "File Metadata", 9735: "Zap Receipt", 30023: "Long-form Article", 30024: "Draft Article", 34236: "Short Video", 4: "Kind 4", 5555: "Kind 5555"}
    for k, want in labels.items():
        assert one(spark, tx.kind_label(F.lit(k))) == want
    assert [one(spark, tx.is_safe_url(F.lit(u))) for u in ("javascript:x", "HTTPS://x", "https://x", "http://x")] == [False, False, True, True]
    assert one(spark, tx.url_class(F.lit("https://x/a.avif"))) == "link" and one(spark, tx.url_class(F.lit("https://x/a.png#f"))) == "link"
    assert [(x.type, x.value) for x in one(spark, tx.segments(F.lit('(https://a/"b) nostr:note1Q nostr:note1bio')))] == [("text", "("), ("url", 'https://a/"b'), ("text", ") nostr:note1Q "), ("reference", "nostr:note1bio")]
    assert one(spark, tx.to_unsigned_or_zero(F.lit("12x"))) == 0 and one(spark, tx.delimited_has(F.lit("1,77,11"), "77")) and not one(spark, tx.delimited_has(F.lit("177"), "77"))
    assert one(spark, tx.profile(F.lit('{"name":"n","about":null}'))["shown"]) == "n" and one(spark, tx.profile(F.lit("x"))["shown"]) == "Anonymous"
    assert one(spark, tx.profile(F.lit('{"display_name":"","name":"n"}'))["shown"]) == "" and one(spark, tx.profile(F.lit('{"name":5,"about":"x"}'))["shown"]) == "Anonymous"


def test_relay_states_and_upserts(spark):
    a = spark.createDataFrame([("r", i, i == 0) for i in range(11)] + [("ok", 1, False), ("ok", 2, True), ("bad", 1, False)], "relay_url string, at long, success boolean")
    s = {r.relay_url: (r.status, r.consecutive_failures) for r in re.connection_states(a).collect()}
    assert s == {"r": ("blocked", 10), "ok": ("active", 0), "bad": ("failing", 1)}
    have, more = spark.createDataFrame([("a", 1, 5)], "k string, v long, n long"), spark.createDataFrame([("a", 2, 1), ("b", 1, 1)], "k string, v long, n long")
    assert sorted(map(tuple, re.merge_counters(have, more, ["k"]).collect())) == [("a", 3, 6), ("b", 1, 1)]
    assert sorted(map(tuple, re.replace_rows(have, more, ["k"], "v").collect())) == [("a", 2, 1), ("b", 1, 1)]
    assert sorted(map(tuple, re.insert_missing(have, more, ["k"]).collect())) == [("a", 1, 5), ("b", 1, 1)]


def test_merge_duplicate_relays(spark):
    r = spark.createDataFrame([("wss://A.example/", 5, 9, "discovered", "idle"), ("wss://a.example", 3, 4, "seed", "active"), ("wss://x.local", 1, 1, "seed", "active")], "url string, first_seen_at long, last_connected_at long, tier string, status string")
    h = spark.createDataFrame([("wss://A.example/", 0, 2, 1), ("wss://a.example", 0, 3, 1)], "relay_url string, hour_start long, events_received long, events_novel long")
    one_, stats = re.merge_duplicates(r, h)
    assert [tuple(x) for x in one_.collect()] == [("wss://a.example", 3, 9, "seed", "active")] and [tuple(x) for x in stats.collect()] == [("wss://a.example", 0, 5, 2)]


def test_import_list(spark, tmp_path):
    (tmp_path / "a.txt").write_text("# list\nwss://a.example\nWSS://A.example/\nhttp://b\n")
    (tmp_path / "b.jsonl").write_text('{"url":"wss://a.example"}\n{"relays":["wss://c.example","wss://d.local"]}\n')
    assert {r.url for r in re.import_list(spark, str(tmp_path / "a.txt")).collect()} == {"wss://a.example"}
    assert {r.url for r in re.import_list(spark, str(tmp_path / "b.jsonl")).collect()} == {"wss://a.example", "wss://c.example"}
