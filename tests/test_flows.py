import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from flowguard.operators.flows import infer_policy, majority_class, segment_stats, unify_flows
from flowguard.operators.heavy import key_salts, key_sketch, merged_sketch, salts_from
from flowguard.operators.joins import flagged_lookup, lookup_flows, unmatched, without_test_flows

SCHEMA = ("flow_id string, src_ip string, src_port long, segment_index int, flow_duration double, pkt_len_max double, "
          "pkt_len_min double, iat_mean double, protocol int, note string, Label int, attack_type string")
ROWS = [
    ("f", None, 80, 1, 120.0, 9.0, 1.0, 4.0, 17, "a", 0, "Benign"),
    ("f", "ip2", 81, 2, 30.0, 5.0, 2.0, 2.0, 6, "b", 1, "XSS"),
    ("f", "ip1", 79, 0, 60.0, 7.0, None, None, 6, "c", 0, "Benign"),
    ("g", "ip3", 1, 0, 1.0, 1.0, 1.0, 1.0, 1, "d", 1, "XSS"),
]


def unified(spark, **options):
    rows = unify_flows(spark.createDataFrame(ROWS, SCHEMA), **options).collect()
    return {r["flow_id"]: r for r in rows}


def test_one_record_per_flow_with_policy(spark):
    got = unified(spark, order="segment_index")
    assert set(got) == {"f", "g"}
    f = got["f"]
    assert (f["flow_duration"], f["pkt_len_max"], f["pkt_len_min"], f["iat_mean"]) == (210.0, 9.0, 1.0, 3.0)
    assert (f["src_ip"], f["src_port"], f["protocol"], f["n_segments"]) == ("ip1", 79, 6, 3)
    assert (f["Label"], f["attack_type"], f["label_conflict"]) == (1, "Benign", 1)
    assert (got["g"]["Label"], got["g"]["attack_type"], got["g"]["label_conflict"]) == (1, "XSS", 0)
    assert "note" not in f.asDict() and "segment_index" not in f.asDict()


def test_first_skips_nulls_and_no_order_takes_smallest(spark):
    assert unified(spark)["f"]["src_ip"] == "ip1"
    df = spark.createDataFrame([r for r in ROWS if r[1] != "ip1"], SCHEMA)
    row = unify_flows(df, order="segment_index").where("flow_id = 'f'").first()
    assert row["src_ip"] == "ip2"


def test_class_outside_the_list_is_an_error(spark):
    with pytest.raises(PySparkException):
        unified(spark, classes=["Benign"])


def test_majority_tie_goes_to_lowest_name(spark):
    df = spark.createDataFrame([("f", "b"), ("f", "a"), ("f", "b"), ("f", "a"), ("g", None), ("g", "z")],
                               "flow_id string, attack_type string")
    want = {("f", "a"), ("g", "z")}
    assert {tuple(r) for r in majority_class(df).collect()} == want
    assert {tuple(r) for r in majority_class(df, classes=["b", "a", "z"]).collect()} == want


def test_many_classes(spark):
    df = spark.range(0, 400).select(
        (F.col("id") % 3).alias("flow_id"), F.concat(F.lit("c"), F.col("id") % 100).alias("attack_type"),
        F.lit(1).alias("Label"), F.col("id").alias("total_packets"))
    rows = unify_flows(df).collect()
    assert len(rows) == 3 and sum(r["n_segments"] for r in rows) == 400
    assert all(r["attack_type"] for r in rows)


@pytest.mark.parametrize("column,policy", [
    ("Flow Duration", "sum"), ("Average Packet Size", "mean"), ("Flow Bytes/s", "mean"),
    ("Fwd Packet Length Max", "max"), ("Min_len", "min"), ("Tot Fwd Pkts", "sum"), ("Down/Up Ratio", "mean"),
    ("Idle Std", "mean"), ("FIN Flag Cnt", "sum"), ("Init Win", "mean"), ("Packet Length Variance", "mean"),
    ("iteration_count", "sum"), ("separate_bytes", "sum"), ("FlowBytes/s", "mean"), ("totalPackets", "sum")])
def test_inferred_policy(column, policy):
    assert infer_policy(column) == policy


def test_short_policy_rules():
    assert infer_policy("fwd_maximal_len", "short") == "max"
    assert infer_policy("header_len", "short") == "sum"
    assert infer_policy("header_len") == "mean"


def test_wide_schema_stays_a_hash_aggregation(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    plan = unify_flows(df, order="segment_index", classes=["Benign", "XSS"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_policy_names_in_any_case(spark):
    df = spark.createDataFrame([("f", 6, 0, "Benign"), ("f", 17, 0, "Benign")], "flow_id string, Protocol int, Label int, attack_type string")
    assert unify_flows(df).first()["Protocol"] == 6


def test_segment_stats(spark):
    row = segment_stats(unify_flows(spark.createDataFrame(ROWS, SCHEMA))).first()
    assert tuple(row) == (2, 1)


def test_lookup_keeps_every_packet_of_a_hot_flow(spark):
    packets = spark.range(0, 3_000).select(
        F.col("id").alias("packet_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("flow_id"))
    flows = spark.range(0, 400).select(F.col("id").alias("flow_id"), (F.col("id") * 10).alias("n_segments"))
    assert key_salts(packets, "flow_id", 8).keys() == {7}
    plain = packets.join(flows, "flow_id", "left").select("packet_id", "n_segments").collect()
    for salts, spread_by in (({}, None), (None, None), ({7: 5, 450: 2}, "packet_id")):
        got = lookup_flows(packets, flows, salts=salts, spread_by=spread_by)
        assert sorted(got.select("packet_id", "n_segments").collect()) == sorted(plain)
        assert got.where("have_flow <> (n_segments is not null)").count() == 0
    assert tuple(unmatched(lookup_flows(packets, flows)).first()) == (3_000, sum(r[1] is None for r in plain))


def test_heavy_keys_are_spread_in_proportion(spark):
    """A key with a third of all rows and one with a tenth: no task reads twice the median."""
    n, parts = 60_000, 16
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, 8).otherwise(F.col("id") + 1_000)
    packets = spark.range(0, n, 1, 4).select(F.col("id").alias("packet_id"), key.alias("flow_id"))
    flows = spark.range(0, 2_000).select(F.col("id").alias("flow_id"))
    salts = key_salts(packets, "flow_id", parts)
    assert salts.keys() == {7, 8} and salts[7] == pytest.approx(2 * parts / 3, abs=1) and salts[7] > 3 * salts[8]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(before, (str(parts), "false", "-1")):
            spark.conf.set(k, v)
        sizes = lookup_flows(packets, flows, salts=salts, spread_by="packet_id").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = sorted(r["count"] for r in sizes)
    assert sum(sizes) == n and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_sketches_merge(spark):
    def table(low, high):
        return spark.range(low, high).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))

    both = merged_sketch(key_sketch(table(0, 500), "k", 8).unionByName(key_sketch(table(500, 4_000), "k", 8)), 8)
    assert both.first()["rows"] == 4_000 and salts_from(both, 8) == {"hot": 8}
    assert salts_from(key_sketch(table(0, 0), "k", 8), 8) == {}


def test_lookup_renames_clashing_columns(spark):
    packets = spark.createDataFrame([("f", 1), (None, 0)], "flow_id string, Label int")
    flows = spark.createDataFrame([("f", 0)], "flow_id string, Label int")
    rows = {r["flow_id"]: r for r in lookup_flows(packets, flows, salts={}).collect()}
    assert (rows["f"]["Label"], rows["f"]["flow_Label"], rows["f"]["have_flow"]) == (1, 0, True)
    assert rows[None]["have_flow"] is False


def test_flagged_lookup_and_leakage_guard(spark):
    packets = spark.createDataFrame([("f", 1), ("g", 0)], "flow_id string, alert int")
    flows = spark.createDataFrame([("f",), ("h",)], "flow_id string")
    assert [r["flow_id"] for r in flagged_lookup(packets, flows).collect()] == ["f"]
    assert [r[0] for r in without_test_flows(flows, packets).collect()] == ["h"]
