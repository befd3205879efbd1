"""Reports are decoded by many tasks also where the table is one row group, and an address is matched once."""

from pyspark.sql import functions as F

from tidewire import storage
from tidewire.functions import addresses
from tidewire.operators import reports
from tidewire.plans import streams, views


def table(spark, folder):
    """1,000 events in one file of one row group."""
    rows = spark.range(1000).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.col("id") * 600).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 37).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.lit(1.5).alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 100).alias("props"),
    )
    rows.coalesce(1).write.parquet(f"{folder}/events.parquet")
    return rows


def test_deliveries_of_one_row_group_are_spread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(views, "PART_ROWS", 50, raising=False)
    whole = table(spark, tmp_path)
    with storage.recorded() as made:
        list(streams._deliveries(spark, str(tmp_path), 2))
    written = spark.read.parquet(made[0])
    files = written.select("part", F.input_file_name().alias("file")).distinct().groupBy("part").count().collect()
    assert len(files) == 2 and all(r["count"] > 4 for r in files)
    assert sorted(written.drop("part").collect()) == sorted(whole.collect())


def test_reports_of_one_row_group_are_decoded_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(views, "PART_ROWS", 50, raising=False)
    table(spark, tmp_path)
    ev = views.events(spark, str(tmp_path))
    tasks = []
    decode = reports.decode

    def watched(rows):
        tasks.append(rows.select(F.spark_partition_id().alias("p")).distinct().count())
        return decode(rows)

    monkeypatch.setattr(reports, "decode", watched)
    got = views.node_reports(ev)
    assert tasks[0] > 4
    plain = reports.with_history(decode(views.mesh_reports(ev)), stale=views.STALE)
    assert sorted(got.collect(), key=str) == sorted(plain.collect(), key=str)


def test_an_address_is_matched_once(spark, capsys):
    texts = ["fe80::1:7fffffffffffffff:7fffffffffffffff:7fffffffffffffff", "fe80::1:8000000000000000:8000000000000000:8000000000000000",
             "fe80::1:0:0:0", f"::1:{'0' * 20}Ab:{'0' * 20}aB:{'0' * 20}ab", "fe80::1:0a:a:a", None]
    rows = spark.createDataFrame([(t,) for t in texts], "a string").select(addresses.node_id_from_address(F.col("a")).alias("n"))
    assert [r["n"] for r in rows.collect()] == [2**63 - 1, None, 0, 171, None, None]
    capsys.readouterr()
    rows.explain()
    assert capsys.readouterr().out.lower().count("regexp_extract") == 1


def test_an_address_is_written_as_before(spark):
    n = F.col("n")
    rows = spark.createDataFrame([(x,) for x in (None, 0, 1, 2, 512, 700, -1, 2**63 - 1)], "n long")
    asked = F.format_string("fe80::%x:%x:%x:%x", n.bitwiseXOR(F.lit(512)), n, n, n)
    assert rows.filter(~views.address(n).eqNullSafe(asked)).isEmpty()
