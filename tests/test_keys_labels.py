import pytest
from pyspark.sql import functions as F

from flowguard.functions.cleaning import clean_numeric, port_text
from flowguard.functions.labels import canonical_class, class_of_path, normalize_labels
from flowguard.operators.keys import MissingColumnError, ensure_flow_id, rename_ids, trim_headers, union_by_name


def test_flow_id_is_direction_free(spark):
    rows = [("1.1.1.1", "80.0", "2.2.2.2", "443"), ("2.2.2.2", "443", " 1.1.1.1 ", "80"),
            (None, "x", "9.9.9.9", None), ("9.9.9.9", None, None, None)]
    df = spark.createDataFrame(rows, "`Src IP` string, sport string, `dest-ip` string, `Dst_Port` string")
    got = [r["flow_id"] for r in ensure_flow_id(df).collect()]
    assert got == ["1.1.1.1:80-2.2.2.2:443"] * 2 + ["9.9.9.9:-1-na:-1"] * 2


def test_existing_flow_id_is_rebuilt_or_kept(spark):
    df = spark.createDataFrame([("x-6", "a", 1, "b", 2)], "`Flow ID` string, src_ip string, src_port int, dst_ip string, dst_port int")
    assert ensure_flow_id(df).first()["flow_id"] == "a:1-b:2"
    assert ensure_flow_id(df.select("Flow ID")).first()["flow_id"] == "x-6"
    with pytest.raises(MissingColumnError):
        ensure_flow_id(df.select("src_ip"))


def test_canonical_name_wins_over_alias(spark):
    df = spark.createDataFrame([("keep", "alias")], "src_ip string, saddr string")
    assert rename_ids(df).columns == ["src_ip", "saddr"]
    assert trim_headers(spark.createDataFrame([(1,)], "` a ` int")).columns == ["a"]


@pytest.mark.parametrize("text,port", [("80.0", "80"), ("443", "443"), ("x", "-1"), (None, "-1"), ("inf", "-1"), ("8.9", "8")])
def test_port_text(spark, text, port):
    df = spark.createDataFrame([(text,)], "p string")
    assert df.select(port_text(F.col("p"))).first()[0] == port


LABELS = [
    ("Benign/BenignTraffic.csv", "Benign"), ("NormalDay", "Benign"), ("DDoS/DDoS-HTTP_Flood.csv", "DDoS-HTTP_Flood"),
    ("DoS-HTTP", "DoS-HTTP_Flood"), ("Spoofing/DNS.csv", "DNS_Spoofing"), ("dnsspoof", "DNS_Spoofing"),
    ("Web-Based/XSS", "XSS"), ("BruteForce", "Brute_Force"), ("Mirai/x.csv", None), ("abnormal", None),
    ("DDoS-UDP", None), ("", None), (None, None)]


def test_canonical_class_column_and_path_agree(spark):
    df = spark.createDataFrame([(t,) for t, _ in LABELS], "t string")
    got = [r[0] for r in df.select(canonical_class(F.col("t"))).collect()]
    assert got == [c for _, c in LABELS]
    assert [class_of_path(t or "") for t, _ in LABELS] == [c for _, c in LABELS]


def test_legacy_substring_rule(spark):
    df = spark.createDataFrame([("abnormal",)], "t string")
    assert df.select(canonical_class(F.col("t"), legacy=True)).first()[0] == "Benign"
    assert class_of_path("abnormal", legacy=True) == "Benign"


def test_normalize_labels(spark):
    df = spark.createDataFrame([("BENIGN",), ("weird",), (None,), ("xss",)], "`La_bel` string")
    got = [(r["attack_type"], r["Label"]) for r in normalize_labels(df).collect()]
    assert got == [("Benign", 0), ("weird", 1), (None, None), ("XSS", 1)]
    legacy = [(r["attack_type"], r["Label"]) for r in normalize_labels(df, legacy=True).collect()]
    assert legacy[2] == ("nan", 1)
    with pytest.raises(ValueError):
        normalize_labels(spark.createDataFrame([(1,)], "x int"))


def test_labels_already_there_are_left_alone(spark):
    df = spark.createDataFrame([("odd", 7)], "attack_type string, Label int")
    assert normalize_labels(df).first() == ("odd", 7)


def test_clean_numeric(spark):
    values = [(float("nan"), "1"), (float("inf"), "x"), (float("-inf"), "inf"), (2.5, None)]
    df = clean_numeric(spark.createDataFrame(values, "a double, b string"), ["a", "b"])
    assert [tuple(r) for r in df.collect()] == [(None, 1.0), (None, None), (None, None), (2.5, None)]


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2.0)], "s string, d double")
    assert sorted(union_by_name([a, b]).collect(), key=str) == [(1, "x", None), (None, "y", 2.0)]
