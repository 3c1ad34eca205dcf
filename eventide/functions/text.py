"""Text, URL and display functions, as columns."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of event kinds, patterns, extensions.
KIND_LABELS = {
    0: "Profile", 1: "Note", 3: "Contacts", 6: "Repost", 7: "Reaction", 16: "Generic Repost", 1063: "File Metadata",
    9735: "Zap Receipt", 30023: "Long-form Article", 30024: "Draft Article", 34235: "Video", 34236: "Short Video",
}
IMAGES = r"\.(jpg|jpeg|png|gif|webp|svg)$"
VIDEOS = r"\.(mp4|webm|mov|m4v)$"
URL = r"https?://[^\s<>\)\]]+"
REFERENCE = r"nostr:(?:npub1|nprofile1|note1|nevent1|naddr1)[a-z0-9]+"


def to_unsigned_or_zero(text: Column) -> Column:
    return F.coalesce(F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint")), F.lit(0).cast("bigint"))


def byte_length(text: Column) -> Column:
    return F.octet_length(text)


def plain_relay_url(url: Column) -> Column:
    """Lower case, no blanks around, no slashes at the end, no default port."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(url)), "/+$", ""), ":443$", "")


def plausible_relay_url(url: Column) -> Column:
    """Whether a plain URL looks like one relay on the public net."""
    local = url.contains(".local") | url.contains("localhost") | url.contains("127.0.0.1") | url.contains("0.0.0.0")
    return url.startswith("wss://") & (F.octet_length(url) > 6) & ~url.rlike("[ \n\r\t,]") & ~local & ~url.like("%wss://%wss://%") & ~url.contains("http")


def relay_url(url: Column) -> Column:
    """A relay's URL in one form, null if it must not be connected to.

    Scheme ws or wss, host in lower case; blocked are local names, onion
    services, private, loopback, link-local and carrier-grade addresses,
    IPv6 addresses of such nets, and ports beside 80, 443 and 1024 upwards.
    """
    text = F.trim(url)
    part = lambda i: F.regexp_extract(text, r"(?i)^(wss?)://(\[[0-9a-f:.]+\]|[^/:?#\s@\[\]]+)(?::([0-9]{1,5}))?(/[^\s#]*)?$", i)
    scheme, host, port = F.lower(part(1)), F.regexp_replace(F.lower(part(2)), r"\.$", ""), part(3)
    path = F.regexp_replace(part(4), "/+$", "")
    number = port.try_cast("int")
    octet = lambda i: F.regexp_extract(host, r"^([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)$", i).try_cast("int")
    a, b = octet(1), octet(2)
    private = a.isin(0, 10, 127) | (a >= 224) | ((a == 169) & (b == 254)) | ((a == 172) & b.between(16, 31)) | ((a == 192) & (b == 168)) | ((a == 100) & b.between(64, 127))
    names = host.rlike(r"(^|\.)(localhost|local|internal|lan|onion|home|test|invalid)$") | ~(host.contains(".") | host.startswith("["))
    six = host.rlike(r"^\[(::1?|fe[89ab].*|f[cd].*|::ffff:.*)\]$")
    default = ((scheme == "wss") & (number == 443)) | ((scheme == "ws") & (number == 80))
    allowed = number.isNull() | number.isin(80, 443) | number.between(1024, 65535)
    bad = (scheme == "") | (host == "") | names | F.coalesce(private, F.lit(False)) | six | ~allowed | ((port != "") & number.isNull())
    shown = F.concat(scheme, F.lit("://"), host, F.when((port != "") & ~F.coalesce(default, F.lit(False)), F.concat(F.lit(":"), port)).otherwise(""), path)
    return F.when(~bad, shown)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)", 1))


def url_class(url: Column) -> Column:
    """image or video by the extension before a question mark, else link."""
    path = F.substring_index(F.lower(url), "?", 1)
    return F.when(path.rlike(IMAGES), "image").when(path.rlike(VIDEOS), "video").otherwise("link")


def segments(content: Column) -> Column:
    """Content as an array of (type, value): text, url and reference parts in order; nothing is lost."""
    pattern = F.lit(f"(?s)({REFERENCE})|({URL})|(?:(?!{REFERENCE}|{URL}).)+")
    return F.transform(F.regexp_extract_all(content, pattern, F.lit(0)), lambda s: F.struct(F.when(s.rlike(f"^{REFERENCE}$"), "reference").when(s.rlike(f"^{URL}$"), "url").otherwise("text").alias("type"), s.alias("value")))


def resolved(content: Column, tags: Column) -> Column:
    """Content with each #[n] replaced by the n-th tag's value, as event: or profile: reference; others stay."""

    def one(part: Column, i: Column) -> Column:
        # Parts behind the first begin with the number of a tag.
        n = F.regexp_extract(part, r"^([0-9]{1,9})\]", 1).try_cast("int")
        tag = F.get(tags, n)
        name = F.when(F.get(tag, F.lit(0)) == "p", "profile:").when(F.get(tag, F.lit(0)) == "e", "event:")
        put = F.concat(name, F.get(tag, F.lit(1)), F.regexp_replace(part, r"^[0-9]{1,9}\]", ""))
        return F.when(i == 0, part).otherwise(F.coalesce(put, F.concat(F.lit("#["), part)))

    return F.array_join(F.transform(F.split(content, r"#\["), one), "")


def _prefix(text: Column, most: int) -> Column:
    """The longest prefix of whole characters within so many bytes."""
    raw = F.encode(text, "UTF-8")
    cut = F.hex(F.substring(raw, 1, most))
    # Where the next byte goes on with a character, what is there of it goes.
    inside = F.hex(F.substring(raw, most + 1, 1)).rlike("^[89AB]")
    return F.decode(F.unhex(F.when(inside, F.regexp_replace(cut, "[C-F][0-9A-F](?:[89AB][0-9A-F]){0,2}$", "")).otherwise(cut)), "UTF-8")


def shortened(text: Column, most: int) -> Column:
    """At most so many bytes, with three dots behind where cut; no character is broken."""
    return F.when(F.octet_length(text) > most, F.concat(_prefix(text, most), F.lit("..."))).otherwise(text)


def shortened_url(url: Column) -> Column:
    """A URL without its scheme, of over 50 bytes the first 47 and three dots."""
    plain = F.regexp_replace(url, "^https?://", "")
    return F.when(F.octet_length(plain) > 50, F.concat(_prefix(plain, 47), F.lit("..."))).otherwise(plain)


def _ends(key: Column, most: int, head: int, tail: int) -> Column:
    return F.when(F.octet_length(key) > most, F.concat(F.substring(key, 1, head), F.lit("..."), F.substring(key, -tail, tail))).otherwise(key)


def short_key(key: Column) -> Column:
    """Keys and identifiers (ASCII) of over 16 characters: the first 12, the last 4."""
    return _ends(key, 16, 12, 4)


def short_npub(key: Column) -> Column:
    return _ends(key, 32, 16, 12)


def _tenths(n: Column, unit: int) -> Column:
    """n / unit as a double, to one decimal; a tie goes the way of the double, where that is exact to the even digit."""
    low, rest = F.floor(n / (unit // 10)).cast("bigint"), n.cast("bigint") % (unit // 10)
    # The double's distance from the tie, exactly: below 2**22 it is a whole number of 2**-41, below 2**11 of 2**-52.
    v = n.cast("bigint").cast("double") / F.lit(float(unit))

    def beyond(bits: int) -> Column:
        shown = F.floor(v * float(1 << bits)).cast("decimal(20,0)") * F.lit(unit).cast("decimal(8,0)")
        return F.signum((shown - n.cast("decimal(18,0)") * F.lit(1 << bits).cast("decimal(18,0)")).cast("double"))

    tie = F.when(v < 2048, beyond(52)).when(v < 1 << 22, beyond(41)).otherwise(F.lit(0.0))
    up = F.when(rest * 2 != unit // 10, rest * 2 > unit // 10).otherwise((tie > 0) | ((tie == 0) & (low % 2 == 1)))
    whole = low + up.cast("bigint")
    return F.concat(F.floor(whole / 10).cast("string"), F.lit("."), (whole % 10).cast("string"))


def short_number(n: Column) -> Column:
    return F.when(n >= 1_000_000, F.concat(_tenths(n, 1_000_000), F.lit("M"))).when(n >= 1_000, F.concat(_tenths(n, 1_000), F.lit("K"))).otherwise(n.cast("bigint").cast("string"))


def sats(msats: Column) -> Column:
    return F.concat(short_number(F.floor(msats / 1000)), F.lit(" sats"))


def kind_label(kind: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in KIND_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, kind), F.concat(F.lit("Kind "), kind.cast("string")))


def is_safe_url(url: Column) -> Column:
    return F.coalesce(url.startswith("https://") | url.startswith("http://"), F.lit(False))


def profile(content: Column) -> Column:
    """A profile's JSON as a struct; text that is no object, or has a field that is neither text nor null, gives one of nulls; ``shown`` is never null."""
    names = ["display_name", "name", "about", "picture", "banner", "nip05", "lud16", "website"]
    made = F.try_parse_json(content)
    value = lambda n: F.try_variant_get(made, f"$.{n}", "string")
    typed = [F.coalesce(F.schema_of_variant(F.try_variant_get(made, f"$.{n}", "variant")), F.lit("VOID")).isin("STRING", "VOID") for n in names]
    good = functools.reduce(lambda a, b: a & b, typed)
    field = {n: F.when(good, value(n)) for n in names}
    return F.struct(*[field[n].alias(n) for n in names], F.coalesce(field["display_name"], field["name"], F.lit("Anonymous")).alias("shown"))


def delimited_has(text: Column, member: str) -> Column:
    return F.coalesce(F.array_contains(F.split(text, ","), member), F.lit(False))
