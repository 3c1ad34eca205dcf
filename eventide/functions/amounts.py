"""Amounts of zaps, in millisatoshis, from the prefix of a BOLT 11 invoice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions import tags as tg
from eventide.functions.text import to_unsigned_or_zero
from eventide.schema import ZAP

#: Amounts above are taken as fake and count as 0.
LARGEST = 1_000_000_000
# Millisatoshis of a unit; p is a tenth of one.
UNITS = {"m": 100_000_000, "u": 100_000, "n": 100}
PATTERN = "^lnbc[0-9]+[munp]1"


def _number(invoice: Column) -> Column:
    return to_unsigned_or_zero(F.regexp_extract(invoice, "^lnbc([0-9]+)[munp]1", 1))


def _unit(invoice: Column) -> Column:
    return F.regexp_extract(invoice, "^lnbc[0-9]+([munp])1", 1)


def _amount(number: Column, unit: Column) -> Column:
    amount = F.when(unit == "p", F.call_function("div", number, F.lit(10)).cast("bigint"))
    for u, factor in UNITS.items():
        # More units than the limit holds can't be multiplied without overflow; they are fake.
        amount = amount.when(unit == u, F.when(number > LARGEST // factor, F.lit(LARGEST + 1)).otherwise(number * factor))
    amount = amount.otherwise(F.lit(0).cast("bigint"))
    return F.when(amount > LARGEST, F.lit(0).cast("bigint")).otherwise(amount)


def msats(invoice: Column) -> Column:
    return _amount(_number(invoice), _unit(invoice))


def zaps(events: DataFrame) -> DataFrame:
    """A row for each zap with a readable invoice: event_id, zapper, created_at, amount_msats, recipient, sender.

    Column by column in steps, so that tags are searched and invoices parsed once.
    """
    tags, bolts = F.col("tags"), F.col("_bolts")
    readable = F.exists(bolts, lambda t: (F.size(t) >= 2) & F.get(t, F.lit(1)).rlike(PATTERN))
    own = events.where(F.col("kind") == ZAP).select(
        F.col("id").alias("event_id"), F.col("pubkey").alias("zapper_pubkey"), "created_at", tg.named(tags, "bolt11").alias("_bolts"), tg.first(tags, "p").alias("recipient_pubkey"), tg.first(tags, "P").alias("sender_pubkey")
    )
    own = own.where(readable).withColumn("_invoice", tg.at(F.get(bolts, F.lit(0)), 1))
    own = own.withColumns({"_number": _number(F.col("_invoice")), "_unit": _unit(F.col("_invoice"))})
    return own.select("event_id", "zapper_pubkey", "created_at", _amount(F.col("_number"), F.col("_unit")).alias("amount_msats"), "recipient_pubkey", "sender_pubkey")
