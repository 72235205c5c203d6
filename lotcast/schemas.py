"""Record layouts, feature lists and band presets for auction listings.

Everything here is data, not logic: the operators take column names and
schemas as arguments, so the same code runs on listings and on any other
table that plays the same roles.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# ---------------------------------------------------------------------------
# FIXED VALUES that must equal the reference's: record layouts, feature
# lists, report bands, output names, model and stream settings.
# ---------------------------------------------------------------------------

# Batch listing (training and test CSV), 28 columns, in file order.
# SellerItemAvg and AuctionHitCountAvgRatio are ints in the reference's batch
# layout but doubles in its stream layout; we read both as double.
LISTING_BATCH_FIELDS = [
    ("EbayID", "long"),
    ("QuantitySold", "double"),
    ("Price", "double"),
    ("PricePercent", "double"),
    ("StartingBidPercent", "double"),
    ("SellerName", "string"),
    ("SellerClosePercent", "double"),
    ("Category", "int"),
    ("PersonID", "int"),
    ("StartingBid", "double"),
    ("AvgPrice", "double"),
    ("EndDay", "string"),
    ("HitCount", "int"),
    ("AuctionAvgHitCount", "int"),
    ("ItemAuctionSellPercent", "double"),
    ("SellerSaleAvgPriceRatio", "double"),
    ("SellerAvg", "double"),
    ("SellerItemAvg", "double"),
    ("AuctionHitCountAvgRatio", "double"),
    ("BestOffer", "double"),
    ("ReturnsAccepted", "int"),
    ("IsHOF", "int"),
    ("ItemListedCount", "int"),
    ("AuctionCount", "int"),
    ("AuctionSaleCount", "int"),
    ("SellerAuctionCount", "int"),
    ("SellerAuctionSaleCount", "int"),
    ("AuctionMedianPrice", "double"),
]

# Wire message: 33 keys, every value a string, in message order.
LISTING_MESSAGE_KEYS = [
    "EbayID", "Price", "PricePercent", "StartingBidPercent", "SellerName",
    "SellerClosePercent", "Category", "PersonID", "StartingBid", "AvgPrice",
    "EndDay", "QuantitySold", "HitCount", "AuctionAvgHitCount", "Authenticated",
    "ItemAuctionSellPercent", "SellerSaleAvgPriceRatio", "SellerAvg",
    "SellerItemAvg", "AuctionHitCountAvgRatio", "BestOffer", "ReturnsAccepted",
    "IsHOF", "BidCount", "AuctionCount", "AuctionSaleCount", "SellerAuctionCount",
    "SellerAuctionSaleCount", "PriceBuckets", "AuctionMedianPrice",
    "IsInMedianRatio10Percent", "IsInMedianRatio20Percent",
    "IsInMedianRatio25Percent",
]

# Landed / typed stream record: the message without Authenticated, typed.
LISTING_STREAM_FIELDS = [
    ("EbayID", "long"),
    ("Price", "double"),
    ("PricePercent", "double"),
    ("StartingBidPercent", "double"),
    ("SellerName", "string"),
    ("SellerClosePercent", "double"),
    ("Category", "int"),
    ("PersonID", "int"),
    ("StartingBid", "double"),
    ("AvgPrice", "double"),
    ("EndDay", "string"),
    ("QuantitySold", "double"),
    ("HitCount", "int"),
    ("AuctionAvgHitCount", "int"),
    ("ItemAuctionSellPercent", "double"),
    ("SellerSaleAvgPriceRatio", "double"),
    ("SellerAvg", "double"),
    ("SellerItemAvg", "double"),
    ("AuctionHitCountAvgRatio", "double"),
    ("BestOffer", "double"),
    ("ReturnsAccepted", "int"),
    ("IsHOF", "int"),
    ("BidCount", "int"),
    ("AuctionCount", "int"),
    ("AuctionSaleCount", "int"),
    ("SellerAuctionCount", "int"),
    ("SellerAuctionSaleCount", "int"),
    ("PriceBuckets", "int"),
    ("AuctionMedianPrice", "double"),
    ("IsInMedianRatio10Percent", "int"),
    ("IsInMedianRatio20Percent", "int"),
    ("IsInMedianRatio25Percent", "int"),
]

# Price regression features (23). Note: includes the sold outcome.
PRICE_FEATURES = [
    "QuantitySold", "PricePercent", "StartingBidPercent", "SellerClosePercent",
    "Category", "PersonID", "StartingBid", "AvgPrice", "HitCount",
    "AuctionAvgHitCount", "ItemAuctionSellPercent", "SellerSaleAvgPriceRatio",
    "SellerAvg", "SellerItemAvg", "AuctionHitCountAvgRatio", "BestOffer",
    "ReturnsAccepted", "IsHOF", "AuctionCount", "AuctionSaleCount",
    "SellerAuctionCount", "SellerAuctionSaleCount", "AuctionMedianPrice",
]

# Sold classification features (22): the price features without QuantitySold.
SOLD_FEATURES = [c for c in PRICE_FEATURES if c != "QuantitySold"]

# Report bands: half-open [lo, hi) intervals; everything else (including
# values at or above the last edge, NULL and NaN) takes the else label.
ACTIVITY_BANDS = ([10, 20, 40, 100, 200, 300],
                  ["1-10", "10-20", "20-40", "40-100", "100-200", "200-300"],
                  ">300")
RATIO_BANDS = ([0.2, 0.4, 0.6, 0.8],
               ["0-0.2", "0.2-0.4", "0.4-0.6", "0.6-0.8"],
               "0.8-1.0")
PRICE_BANDS = ([2, 10, 20, 50, 120],
               ["0-2", "2-10", "10-20", "20-50", "50-120"],
               ">120")

# Output column names of the reports and leaderboards.
RANGE_COL = "range_name"
COUNT_COL = "counts"
WEEKDAY_COL = "weeks"
SELLER_COL = "seller_name"
TOP_SELLERS = 10

# Output table names (the misspelt "decision_treer" is written "decision_tree").
TABLE_PRICE_BOARD = "indicators_price"
TABLE_SOLD_BOARD = "indicators_quantity_sold"
TABLE_TRAINING = "training"
REPORT_TABLES = {
    "activity": "task_hit_count",
    "weekday": "task_week",
    "seller": "task_seller_name",
    "ratio": "task_ratio",
    "price": "task_price",
}
SCORE_TABLES = {
    "price_linear": "price_regression_linear",
    "price_random_forest": "price_regression_random_forest",
    "price_gbt": "price_regression_gbt",
    "sold_logistic": "quantity_sold_regression_logistic",
    "sold_random_forest": "quantity_sold_regression_random_forest",
    "sold_decision_tree": "quantity_sold_regression_decision_tree",
}

# Model settings: forests have 10 trees, forests and the decision tree use
# seed 10, everything else is Spark's default (GBT was unseeded; we seed it
# with the same value so runs repeat).
FOREST_TREES = 10
SEED = 10

# Streaming: micro-batch interval of the ingest, pause between scoring
# passes, and the per-partition Kafka fetch ceiling (15 MiB).
INGEST_INTERVAL = "10 seconds"
SCORE_INTERVAL = "30 seconds"
KAFKA_MAX_FETCH_BYTES = 15728640

# ---------------------------------------------------------------------------

_TYPES = {
    "long": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "string": StringType(),
}


def struct(fields) -> StructType:
    """Build a nullable StructType from (name, type-name) pairs."""
    return StructType([StructField(n, _TYPES[t], True) for n, t in fields])


def all_strings(names) -> StructType:
    """A nullable all-string StructType (wire and landed layouts)."""
    return StructType([StructField(n, StringType(), True) for n in names])


LISTING_BATCH = struct(LISTING_BATCH_FIELDS)
LISTING_STREAM = struct(LISTING_STREAM_FIELDS)
LISTING_MESSAGE = all_strings(LISTING_MESSAGE_KEYS)
LISTING_LANDED = all_strings([n for n, _ in LISTING_STREAM_FIELDS])

# FIXED VALUES (continued): leaderboard layouts.
LEADERBOARD_REGRESSION = StructType([
    StructField("id", IntegerType(), True),
    StructField("algorithm_name", StringType(), True),
    StructField("rmse", DoubleType(), True),
    StructField("mse", DoubleType(), True),
    StructField("r2", DoubleType(), True),
    StructField("mae", DoubleType(), True),
])

LEADERBOARD_CLASSIFICATION = StructType([
    StructField("id", IntegerType(), True),
    StructField("algorithm_name", StringType(), True),
    StructField("accurate_rate", DoubleType(), True),
    StructField("recall_rate", DoubleType(), True),
    StructField("f1_score", DoubleType(), True),
])
