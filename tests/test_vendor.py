import json

from helpers import messages, tuples
from pyspark.sql import functions as F

from tickloom.operators import clean_trades
from tickloom.plans import ingest
from tickloom.sources import decode_wire, explode_messages, malformed_messages
from tickloom.streaming import reject_messages, trade_messages


def item(**more):
    return {"s": "A", "p": 1.5, "v": 2, "t": 1715000000000} | more


def message(*items, **more):
    return json.dumps({"type": "trade", "data": list(items)} | more)


def test_items_without_a_field_are_skipped(spark):
    texts = [message(item(), item(s=None), item(p=None), item(v=None), item(t=None), {}, None)]
    assert explode_messages(messages(spark, *texts), "x").count() == 1


def test_other_messages_give_no_rows(spark):
    texts = ['{"type":"ping"}', '{"data":[]}', "{}", "not json", "", None, message(item(), type="news")]
    assert explode_messages(messages(spark, *texts), "x").count() == 0


def test_volume_is_cut_and_extra_keys_are_ignored(spark):
    rows = explode_messages(messages(spark, message(item(v=10.9, c=["x"], extra=1))), "x").collect()
    assert [(r.price, r.volume) for r in rows] == [("1.5", 10)]


def test_malformed_messages(spark):
    bad = [message(item(p=None)), message(), '{"type":"trade"}', '{"type":"trade","data":null}', message(None)]
    good = [message(item()), message(item(p=None), item()), '{"type":"ping"}', "not json", "", None]
    found = malformed_messages(messages(spark, *bad, *good))
    assert sorted(r.value for r in found.collect()) == sorted(bad)
    assert found.columns == ["value"]


def test_ingest_splits_filters_and_keeps_price_digits(spark):
    texts = [
        message(item(p="10.500"), item(s="B"), item(s="C")),
        message(item(p="0.00"), item(v="bad"), item(s="", t="x"), item(t="x"), item(p=None)),
        message(),
    ]
    good, bad, malformed = ingest(messages(spark, *texts), "feed", ["A", "B"])
    assert sorted((r.symbol, r.price) for r in good.collect()) == [("A", "10.500"), ("B", "1.5")]
    found = {(r.reject_reason, r.symbol, r.price, r.volume, r.trade_timestamp) for r in bad.collect()}
    assert "0.00" in {f[2] for f in found if f[0] == "price"}
    assert sorted(f[0] for f in found) == ["price", "price", "symbol", "time", "volume"]
    assert {f[3] for f in found if f[0] == "volume"} == {"bad"} and {f[4] for f in found if f[0] == "time"} == {"x"}
    letters = [json.loads(bytes(r.value)) for r in reject_messages(bad).collect()]
    assert sorted(letter["reject_reason"] for letter in letters) == ["price", "price", "symbol", "time", "volume"]
    assert all("price" in letter for letter in letters)
    assert [r.value for r in malformed.collect()] == [message()]


def test_published_payload_reads_back(spark):
    good, _, _ = ingest(messages(spark, message(item(p=189.42, t=1715000000123), item(s="B", v=7))), "feed")
    sent = trade_messages(good)
    payload = {bytes(r.key).decode(): json.loads(bytes(r.value)) for r in sent.collect()}
    assert list(payload["A"]) == ["symbol", "price", "volume", "trade_timestamp", "ingestion_timestamp", "source"]
    assert payload["A"]["price"] == "189.42" and payload["A"]["volume"] == 2
    assert payload["A"]["trade_timestamp"] == "2024-05-06T12:53:20.123000+00:00"
    assert payload["B"]["trade_timestamp"] == "2024-05-06T12:53:20+00:00"
    back = clean_trades(decode_wire(sent)).select("symbol", "price", "volume", F.unix_millis("trade_timestamp"), "source")
    assert tuples(back) == [("A", 189.42, 2, 1715000000123, "feed"), ("B", 1.5, 7, 1715000000000, "feed")]


def test_decoding_bad_messages_gives_rows_of_nulls(spark):
    rows = decode_wire(messages(spark, "not json", None, "[]", '{"symbol":"A","price":1.50,"volume":3}')).collect()
    assert len(rows) == 4
    assert [r for r in rows if r.symbol][0][:3] == ("A", "1.5", "3")
    assert sum(all(value is None for value in r) for r in rows) == 3
