from datetime import date

from pyspark.sql import functions as F

from subtide.operators.upsert import duplicate_keys, upsert_snapshots
from subtide.schemas import RAW_SNAPSHOT, SUBSCRIPTION_SNAPSHOT
from subtide.sources.landing import normalize_raw, read_raw_snapshots, rejected_raw

HEADER = ",".join(RAW_SNAPSHOT.names) + "\n"


def landing(spark, tmp_path, *lines):
    (tmp_path / "a.csv").write_text(HEADER + "\n".join(lines) + "\n")
    return read_raw_snapshots(spark, f"{tmp_path}/*.csv")


def test_csv_is_read_as_strings(spark, tmp_path):
    raw = landing(spark, tmp_path, '4/1/2024,i1,"A, ""B""",s1,3/1/2024,5/1/2024,1.005', "4/1/2024,i2,P,s2,,,")
    assert raw.schema == RAW_SNAPSHOT
    rows = raw.orderBy("subscription_id").collect()
    assert rows[0]["subscription_name"] == 'A, "B"'
    assert rows[1]["minutes_of_usage"] is None and rows[1]["subscription_start_date"] is None


def test_normalize_types_dates_and_minutes(spark, tmp_path):
    raw = landing(
        spark, tmp_path,
        "4/1/2024,i1,P,s1,3/31/2024,12/5/2024,2.345", "2024-04-02,i2,P,s2,,,", "4/3/2024,i3,P,s3,,,-2.345",
    )
    rows = normalize_raw(raw, "OPX").orderBy("snapshot_date").collect()
    assert [r["snapshot_date"].day for r in rows] == [1, 2, 3]
    assert rows[0]["subscription_end_date"] == date(2024, 12, 5) and rows[0]["opco_code"] == "OPX"
    assert [r["minutes_of_usage"] for r in rows] == [2.35, 0.0, -2.35]
    assert normalize_raw(raw, "OPX").columns == SUBSCRIPTION_SNAPSHOT.names


def test_unreadable_rows_are_reported_not_lost(spark, tmp_path):
    raw = landing(
        spark, tmp_path,
        "4/1/2024,i1,P,s1,,,1", "yesterday,i2,P,s2,,,1", ",i3,P,s3,,,1", "4/1/2024,i4,P,s4,never,,1",
        "4/1/2024,i5,P,s5,,31/31/2024,1", "4/1/2024,i6,P,s6,,,many", "4/1/2024,,P,,,,3",
    )
    reasons = {r["subscription_id"]: r["reject_reason"] for r in rejected_raw(raw).collect()}
    assert reasons == {
        "i2": "snapshot_date", "i3": "snapshot_date", "i4": "subscription_start_date",
        "i5": "subscription_end_date", "i6": "minutes_of_usage",
    }
    # Missing ids are not unreadable: the row stays, as in the snapshot table.
    assert normalize_raw(raw, "X").count() + len(reasons) == raw.count()


def snapshot(spark, *rows):
    return spark.createDataFrame(
        [("X", sub, name, sid, None, None, float(m), date(2024, 4, d)) for sub, name, sid, m, d in rows],
        SUBSCRIPTION_SNAPSHOT,
    )


def test_upsert_updates_inserts_and_keeps(spark):
    bronze = snapshot(spark, ("s1", "P", "i1", 1, 1), ("s2", "P", "i2", 2, 1), ("s1", "P", "i1", 3, 2))
    source = snapshot(spark, ("s1", "Q", "i1", 9, 1), ("s3", "P", "i3", 4, 1))
    merged = upsert_snapshots(bronze, source.select(*reversed(source.columns)))
    columns = ["subscriber_id", "subscription_name", "minutes_of_usage", F.dayofmonth("snapshot_date")]
    got = sorted(tuple(r) for r in merged.select(*columns).collect())
    assert got == [("s1", "P", 3.0, 2), ("s1", "Q", 9.0, 1), ("s2", "P", 2.0, 1), ("s3", "P", 4.0, 1)]


def test_upsert_twice_changes_nothing_even_with_missing_ids(spark):
    source = snapshot(spark, ("s1", "P", None, 1, 1), (None, "P", "i2", 2, 1))
    once = upsert_snapshots(snapshot(spark), source)
    twice = upsert_snapshots(once, source)
    assert sorted(twice.collect(), key=str) == sorted(once.collect(), key=str) and once.count() == 2


def test_duplicate_keys_are_found(spark):
    assert duplicate_keys(snapshot(spark, ("s1", "P", "i1", 1, 1), ("s1", "Q", "i1", 1, 1))).count() == 1


def test_jagged_lines_are_rejected(spark, tmp_path):
    header = ",".join(RAW_SNAPSHOT.names)
    good = "4/1/2024,1,REC,7,4/1/2024,4/9/2024,5.5"
    folder = tmp_path / "jagged"
    folder.mkdir()
    (folder / "a.csv").write_text(f"{header}\n{good}\n4/1/2024,1,REC,7\n{good},8\n")
    raw = read_raw_snapshots(spark, str(folder))
    assert normalize_raw(raw, "OPX").count() == 1
    assert {r["reject_reason"] for r in rejected_raw(raw).collect()} == {"columns"}
    assert rejected_raw(raw).count() == 2


def test_minutes_beyond_the_limit_are_rejected(spark, tmp_path):
    raw = landing(spark, tmp_path, "4/1/2024,i1,P,s1,,,1e9", "4/1/2024,i2,P,s2,,,1000000000.01", "4/1/2024,i3,P,s3,,,-1e20")
    assert [r["minutes_of_usage"] for r in normalize_raw(raw, "X").collect()] == [1e9]
    assert sorted((r["subscription_id"], r["reject_reason"]) for r in rejected_raw(raw).collect()) == [("i2", "minutes_of_usage"), ("i3", "minutes_of_usage")]
