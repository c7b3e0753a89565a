from __future__ import annotations

import pytest

from rillrank import schemas
from rillrank.functions import json_records
from rillrank.plans import jobs


def lines(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "seq bigint, value string")


FULL = ('{"client_ip":"10.0.0.1","session_num":3,"c2s_pkt_num":4,"s2c_pkt_num":5,'
        '"c2s_byte_num":6,"s2c_byte_num":7,"recv_time":1700000000123}')


def test_absent_fields_are_zero(spark):
    row = json_records.parse_traffic(lines(spark, '{"client_ip":"192.168.1.1"}')).rows.collect()[0]
    assert row.client_ip == "192.168.1.1"
    assert [row[c] for c in [*schemas.TRAFFIC_NUMBERS, "recv_time"]] == [0] * 6


def test_full_record_and_event_time(spark):
    row = jobs.traffic_of_lines(lines(spark, FULL)).rows.selectExpr("*", "unix_millis(event_time) AS ms").collect()[0]
    assert [row[c] for c in schemas.TRAFFIC_NUMBERS] == [3, 4, 5, 6, 7]
    assert row.ms == row.recv_time == 1700000000123


def test_field_names_match_by_case(spark):
    row = json_records.parse_traffic(lines(spark, '{"client_ip":"x","S2C_PKT_NUM":9}')).rows.collect()[0]
    assert row.s2c_pkt_num == 0


@pytest.mark.parametrize("bad", ["bad", "", "  ", None, '{"client_ip":"x","session_num":"many"}', '{"client_ip"'])
def test_bad_lines(spark, bad):
    parsed = json_records.parse_traffic(lines(spark, FULL, bad))
    assert [r.seq for r in parsed.rows.collect()] == [0]
    assert [(r.seq, r.value) for r in parsed.rejects.collect()] == [(1, bad)]
    with pytest.raises(Exception, match="unreadable line"):
        json_records.parse_traffic(lines(spark, FULL, bad), mode="failfast").rows.collect()


def test_failfast_fails_even_for_a_count(spark):
    with pytest.raises(Exception, match="unreadable line"):
        json_records.parse_traffic(lines(spark, "bad"), mode="failfast").rows.count()


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        json_records.parse_traffic(lines(spark, FULL), mode="other")


def test_keyless_rows_are_dropped_and_counted(spark):
    from pyspark.sql import Observation

    seen = Observation("keyless")
    rows = json_records.parse_traffic(lines(spark, '{"session_num":1}', FULL)).rows
    assert json_records.drop_keyless(rows, observe=seen).count() == 1
    assert seen.get["dropped"] == 1


def test_students(spark):
    rows = json_records.parse_students(lines(spark, '{"name": "com","age": 2}', '{"name":"x"}')).rows.collect()
    assert [(r.name, r.age) for r in rows] == [("com", 2), ("x", 0)]


def test_rename(spark):
    assert {"source", "__time"} <= set(json_records.rename_traffic(json_records.parse_traffic(lines(spark, FULL)).rows).columns)


def test_a_line_is_parsed_once(spark, capsys):
    jobs.traffic_of_lines(lines(spark, FULL)).rows.explain("formatted")
    assert capsys.readouterr().out.count("from_json(") == 1
