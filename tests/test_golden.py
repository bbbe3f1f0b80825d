"""Golden rows from the upstream sample payloads (FIXTURES.md section 4)."""

import json

from pyspark.sql import functions as F

from shopstream.functions import masking, parse
from shopstream.operators import kpi, routing

EVENT = ('{"area":"beijing","uid":"456","itemid":43,"npgid":50,"evid":"coupon","os":"andriod",'
         '"pgid":6,"appid":"gmall2019","mid":"mid_156","type":"event"}')
ORDER = ('{"id":"1","total_amount":"682.0","create_time":"2020-07-30 00:42:17",'
         '"consignee_tel":"13506184075","user_id":"7","order_status":"1"}')


def test_event_numbers_become_strings(spark):
    df = spark.createDataFrame([(EVENT,)], "value string")
    r = parse.parse_event(df).first()
    assert (r.mid, r.uid, r.evid, r.itemid, r.pgid, r.npgid) == ("mid_156", "456", "coupon", "43", "6", "50")
    assert r.area == "beijing" and r.os == "andriod" and r.appid == "gmall2019"


def test_order_quoted_amount_date_hour_and_masks(spark):
    df = spark.createDataFrame([(ORDER,)], "value string")
    r = parse.parse_order(df).first()
    assert r.total_amount == 682.0
    assert (r.create_date, r.create_hour) == ("2020-07-30", "00")
    assert r.consignee_tel == "*******4075"
    head = parse.parse_order(df, mask=masking.mask_tel_head).first()
    assert head.consignee_tel == "1350*******"


def test_malformed_json_gives_null_record(spark):
    df = spark.createDataFrame([("not json",), (EVENT,)], "value string")
    out = parse.parse_event(df)
    assert out.filter(parse.valid_record("mid")).count() == 1
    assert out.count() == 2


def test_short_phone_does_not_fail(spark):
    df = spark.createDataFrame([("123",), ("13506184075",), (None,)], "tel string")
    got = [tuple(r) for r in df.select(masking.mask_tel_tail("tel"), masking.mask_tel_head("tel")).collect()]
    assert got == [("*******", "123*******"), ("*******4075", "1350*******"), (None, None)]


def test_kpi_document_shape(spark):
    dau = spark.createDataFrame([("m1", "2020-08-01"), ("m2", "2020-08-01"), ("m3", "2020-07-31")],
                                "mid string, log_date string")
    orders = spark.createDataFrame([("2020-08-01", 52489.0), ("2020-07-31", 1.5)],
                                   "create_date string, total_amount double")
    doc = kpi.kpi_total_json(kpi.kpi_total(dau, orders, "2020-08-01")).first().doc
    items = json.loads(doc)
    assert [i["id"] for i in items] == ["dau", "new_mid", "order_amount"]
    assert [i["value"] for i in items] == [2, 233, 52489.0]
    assert items[0]["name"] == "新增日活"


def test_kpi_amount_null_when_no_orders(spark):
    dau = spark.createDataFrame([("m1", "2020-08-01")], "mid string, log_date string")
    orders = spark.createDataFrame([("2020-07-31", 1.5)], "create_date string, total_amount double")
    rows = kpi.kpi_total(dau, orders, "2020-08-01").orderBy("ord").collect()
    assert rows[2].value is None
    assert "value" not in json.loads(kpi.kpi_total_json(kpi.kpi_total(dau, orders, "2020-08-01")).first().doc)[2]


def test_hour_document_today_and_yesterday(spark):
    dau = spark.createDataFrame(
        [("a", "2020-08-01", "12"), ("b", "2020-08-01", "12"), ("c", "2020-08-01", "13"),
         ("a", "2020-07-31", "11"), ("x", "2020-07-30", "11")],
        "mid string, log_date string, log_hour string")
    doc = json.loads(kpi.hourly_compare_json(kpi.dau_hourly_compare(dau, "2020-08-01")).first().doc)
    assert doc == {"today": {"12": 2, "13": 1}, "yesterday": {"11": 1}}
    assert kpi.metric_hourly_compare("other", dau, None, "2020-08-01") is None


def test_log_stamp_overwrites_client_ts_and_routes(spark):
    df = spark.createDataFrame([('{"type":"startup","mid":"m","ts":5}', 1000),
                                ('{"mid":"m2"}', 2000),
                                ('{"type":"event","mid":"m3"}', 3000)], "value string, arrival long")
    out = routing.route_logs(routing.stamp_logs(df, F.col("arrival"))).orderBy("ts").collect()
    assert [json.loads(r.value)["ts"] for r in out] == [1000, 2000, 3000]
    assert [r.topic for r in out] == ["CAT_STARTUP", "CAT_EVENT", "CAT_EVENT"]
    assert out[0].log_date == "1970-01-01"


def test_hour_document_for_a_day_without_rows(spark):
    dau = spark.createDataFrame([("a", "2020-08-01", "12")], "mid string, log_date string, log_hour string")
    doc = kpi.hourly_compare_json(kpi.dau_hourly_compare(dau, "2021-01-01")).first().doc
    assert json.loads(doc) == {"today": {}, "yesterday": {}}
    orders = spark.createDataFrame([("2020-08-01", "01", 5.0)],
                                   "create_date string, create_hour string, total_amount double")
    doc = kpi.hourly_compare_json(kpi.order_hourly_compare(orders, "2020-08-02"), "decimal(20,2)").first().doc
    assert json.loads(doc) == {"today": {}, "yesterday": {"01": 5.0}}
