import uuid

import pytest
from pyspark.sql import functions as F

from tickloom.__main__ import main, parser
from tickloom.plans.event_feed import read_events, wire_messages
from tickloom.schema import AGGREGATED_LAYOUT, RAW_LAYOUT
from tickloom.sources import read_table


def test_defaults():
    args = parser().parse_args(["stream", "--checkpoints", "/c", "--raw", "a", "--aggregated", "b", "--brokers", "x"])
    assert (args.topic, args.watermark, args.max_offsets, args.starting_offsets) == (
        "stock_trades", "2 minutes", 5000, "latest",
    )


def test_bootstrap_and_stream(spark, small, tmp_path):
    namespace = f"ns_{uuid.uuid4().hex}"
    main(["bootstrap", "--namespace", namespace, "--provider", "parquet"])
    texts = wire_messages(read_events(spark, small)).select(F.col("value").cast("string"))
    texts.write.text(f"{tmp_path}/feed")
    raw, aggregated = f"{namespace}.raw_stream_data", f"{namespace}.aggregated_data"
    main([
        "stream", "--checkpoints", f"{tmp_path}/cp", "--files", f"{tmp_path}/feed", "--once",
        "--raw", raw, "--aggregated", aggregated, "--rejected", f"{namespace}.rejected",
    ])
    assert read_table(spark, raw, RAW_LAYOUT).count() == 745
    assert read_table(spark, aggregated, AGGREGATED_LAYOUT).count() == 744
    assert spark.table(f"{namespace}.rejected").count() == 278


def test_a_source_is_needed(spark, tmp_path):
    with pytest.raises(SystemExit, match="source"):
        main(["stream", "--checkpoints", f"{tmp_path}", "--raw", "a", "--aggregated", "b"])
