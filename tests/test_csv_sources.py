import os

import pytest
from pyspark.sql import functions as F

from flowguard.sources.csv_dirs import (SourceError, first_rows, header_columns, load_populations, load_source,
                                        scan_csv, scan_labelled_dir, typed)

HEADER = "Src IP, Src Port ,Dst IP,Dst Port,v\n"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.fixture
def folder(tmp_path):
    root = str(tmp_path / "flow")
    write(f"{root}/Benign/a.csv", HEADER + "1.1.1.1,80.0,2.2.2.2,443,1\n1,2\n1,2,3,4,5,6\n1,2,3,4,5,\n\"x,y\",7,3,4,inf\n")
    write(f"{root}/Web XSS/b.csv", "v,Src IP, Src Port ,Dst IP,Dst Port,extra\n7,2.2.2.2,443,1.1.1.1,80,\"q \"\"r\"\", s\"\n")
    write(f"{root}/Mirai/c.csv", "v\n1\n")
    return root


def test_labelled_folder(spark, folder):
    df = scan_labelled_dir(spark, folder)
    rows = {(r["src_ip"], r["attack_type"], r["Label"], r["v"], r["extra"], r["flow_id"]) for r in df.collect()}
    assert rows == {("1.1.1.1", "Benign", 0, "1", None, "1.1.1.1:80-2.2.2.2:443"),
                    ("1", "Benign", 0, None, None, "1:2-na:-1"),
                    ("x,y", "Benign", 0, "inf", None, "3:4-x,y:7"),
                    ("2.2.2.2", "XSS", 1, "7", 'q "r", s', "1.1.1.1:80-2.2.2.2:443")}


def test_long_lines_are_left_out_of_every_query(spark, folder):
    df = scan_labelled_dir(spark, folder)
    assert df.count() == 4
    assert df.select("v").count() == 4
    assert df.select("attack_type").groupBy("attack_type").count().where("attack_type = 'Benign'").first()[1] == 3


def test_typed_columns(spark, folder):
    t = typed(scan_labelled_dir(spark, folder))
    kinds = dict(t.dtypes)
    assert kinds["v"] == "double" and kinds["src_port"] == "double" and kinds["src_ip"] == "string"
    assert t.where("v = double('infinity')").count() == 0


def test_row_cap_over_splits(spark, tmp_path):
    root = str(tmp_path / "big")
    write(f"{root}/Benign/a.csv", "v\n" + "".join(f"{i}\n" for i in range(3_000)))
    write(f"{root}/Benign/b.csv", "v\n" + "".join(f"{i}\n" for i in range(700)))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 1_500)
        spark.conf.set("spark.sql.files.openCostInBytes", 10)
        for n in (1, 999, 2_500, 9_999):
            df = scan_labelled_dir(spark, root, max_rows=n, with_key=False, keep_source=True)
            got = {r[0].rsplit("/", 1)[1]: r[1:] for r in df.groupBy("_file").agg(
                F.count("v"), F.max(F.col("v").cast("int"))).collect()}
            assert got == {"a.csv": (min(n, 3_000), min(n, 3_000) - 1), "b.csv": (min(n, 700), min(n, 700) - 1)}
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_source_errors_and_precedence(spark, folder, tmp_path):
    with pytest.raises(SourceError):
        scan_labelled_dir(spark, str(tmp_path / "none"))
    write(str(tmp_path / "other/Mirai/x.csv"), "v\n1\n")
    with pytest.raises(SourceError):
        scan_labelled_dir(spark, str(tmp_path / "other"))
    single = str(tmp_path / "one.csv")
    write(single, "flow id,Category\nf1,dos http\nf2,Benign\n")
    df = load_source(spark, single, folder)
    assert [(r["flow_id"], r["Label"]) for r in df.collect()] == [("f1", 1), ("f2", 0)]
    packets, flows = load_populations(spark, None, folder, single, None)
    assert packets.count() == 4 and flows.count() == 2
    ids = [r[0] for r in packets.select("packet_id").collect()]
    assert len(set(ids)) == 4 and ids == [r[0] for r in packets.select("packet_id", "attack_type").collect()]
    with pytest.raises(SourceError):
        load_populations(spark, None, folder, None, str(tmp_path / "none"))


def test_header_names(spark):
    assert header_columns(spark, ' a ,"b, c",a,') == ["a", "b, c", "a.1"]
    assert first_rows is not None


def test_scan_csv(spark, folder):
    df = scan_csv(spark, f"{folder}/Benign/a.csv", max_rows=2)
    assert df.columns == ["Src IP", "Src Port", "Dst IP", "Dst Port", "v"] and df.count() == 2
