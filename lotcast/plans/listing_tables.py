"""The listing layouts filled from the ``events`` table, so that the listing
jobs can run over the given data: a purchase is a sold listing, ``value`` its
price, ``user_id`` its seller and the ``k`` of ``props`` its activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotcast import schemas as S
from lotcast.functions.codec import encode_messages
from lotcast.sources.readers import read_table


def listing_columns() -> dict[str, Column]:
    """Every column of the batch layout as an expression over ``events``
    (with ``k``)."""
    v, k, u = F.col("value"), F.col("k").cast("double"), F.col("user_id")
    return {
        "EbayID": F.col("event_id"),
        "QuantitySold": (F.col("event_type") == "purchase").cast("double"),
        "Price": v,
        "PricePercent": v / 500,
        "StartingBidPercent": k / 100,
        "SellerName": F.concat(F.lit("seller"), u.cast("string")),
        "SellerClosePercent": (u % 10) / 10,
        "Category": (F.col("k") % 7).cast("int"),
        "PersonID": (u % 1000).cast("int"),
        "StartingBid": v / 2,
        "AvgPrice": v * 1.1,
        "EndDay": F.date_format("ts", "EEEE"),
        "HitCount": (F.col("k") * 4).cast("int"),
        "AuctionAvgHitCount": (F.col("k") * 2).cast("int"),
        "ItemAuctionSellPercent": k / 50,
        "SellerSaleAvgPriceRatio": v / 400,
        "SellerAvg": v / 3,
        "SellerItemAvg": k,
        "AuctionHitCountAvgRatio": k / 4,
        "BestOffer": (u % 2).cast("double"),
        "ReturnsAccepted": (u % 3).cast("int"),
        "IsHOF": (u % 5 == 0).cast("int"),
        "ItemListedCount": F.lit(1),
        "AuctionCount": (u % 50).cast("int"),
        "AuctionSaleCount": (u % 20).cast("int"),
        "SellerAuctionCount": (u % 70).cast("int"),
        "SellerAuctionSaleCount": (u % 30).cast("int"),
        "AuctionMedianPrice": v * 0.9,
    }


def listings(spark: SparkSession, d: str) -> DataFrame:
    """All events as listings in the batch layout (28 columns)."""
    ev = read_table(spark, d, "events").withColumn("k", F.from_json("props", "k int")["k"])
    cols = listing_columns()
    return ev.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in S.LISTING_BATCH.fields])


#: Texts of the awkward messages, by the last digit of the event id. None
#: stands for a NULL message; good ones have awkward seller names instead.
BAD_MESSAGES = {0: None, 1: "", 2: " \t", 3: "not json", 4: '{"EbayID":"3"}{"EbayID":"4"}', 5: '{"EbayID":"5"} x',
                6: '{"EbayID":'}
ODD_SELLERS = {0: "two\nlines", 1: 'say "hi"', 2: "  blank  ", 3: "back\\slash", 4: "tab\tcomma,", 5: "", 6: "\\N", 7: "e\u0301"}


def messages(spark: SparkSession, d: str) -> DataFrame:
    """All events as wire messages of the 33 keys (``event_id``, ``value``):
    one in ten is a bad message, and the good ones' seller names hold line
    feeds, quotes, blanks and backslashes."""
    wire = listings(spark, d)
    for name in S.LISTING_MESSAGE_KEYS:
        if name not in wire.columns:
            wire = wire.withColumn(name, F.lit("1"))
    digit = F.col("EbayID") % 8
    seller = F.col("SellerName")
    for k, text in ODD_SELLERS.items():
        seller = F.when(digit == k, F.lit(text)).otherwise(seller)
    wire = wire.withColumn("SellerName", seller)
    good = encode_messages(wire, S.LISTING_MESSAGE_KEYS, key="EbayID").select(F.col("key").cast("long").alias("event_id"), "value")
    kind = F.floor(F.col("event_id") / 10) % len(BAD_MESSAGES)
    bad = F.lit(None).cast("string")
    for k, text in BAD_MESSAGES.items():
        bad = F.when(kind == k, F.lit(text)).otherwise(bad)
    return good.withColumn("value", F.when(F.col("event_id") % 10 == 0, bad).otherwise(F.col("value")))
