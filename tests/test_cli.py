from pyspark.sql import functions as F

from lotcast import schemas as S
from lotcast.cli import main
from lotcast.functions import encode_messages
from lotcast.session import scratch_path
from test_listing_jobs import listings_from_events


def test_cli_batch_ingest_score(spark):
    listings = listings_from_events(spark)
    root = scratch_path(spark, "t_cli")
    train, test = listings.randomSplit([0.7, 0.3], seed=5)
    train.write.option("header", True).csv(f"{root}/train")
    test.write.option("header", True).csv(f"{root}/test")
    out = main(["batch", "--train", f"{root}/train", "--test", f"{root}/test", "--out", f"{root}/out",
                "--models", f"{root}/models"])
    assert len(out["models"]) == 6
    assert spark.read.parquet(f"{root}/out/task_week").count() > 0

    wire = listings
    for name in S.LISTING_MESSAGE_KEYS:
        if name not in wire.columns:
            wire = wire.withColumn(name, F.lit("1"))
    encode_messages(wire, S.LISTING_MESSAGE_KEYS).select("value").write.text(f"{root}/msgs")
    main(["ingest", "--source", f"{root}/msgs", "--landed", f"{root}/landed",
          "--trigger", "availableNow", "--checkpoint", f"{root}/ckpt_ingest"])

    main(["score", "--landed", f"{root}/landed", "--models", f"{root}/models", "--out", f"{root}/scores",
          "--reference-shape"])
    scores = spark.read.parquet(f"{root}/scores/listing_scores")
    assert scores.count() == listings.count()
    assert spark.read.parquet(f"{root}/scores/price_regression_gbt").columns[-1] == "Price"

    main(["score-stream", "--landed", f"{root}/landed", "--models", f"{root}/models",
          "--out", f"{root}/stream_scores", "--trigger", "availableNow", "--checkpoint", f"{root}/ckpt_score",
          "--max-files", "1"])
    assert spark.read.parquet(f"{root}/stream_scores").count() == listings.count()
