import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace import catalog as C
from millrace.operators import repair as R
from millrace.operators import repairs
from millrace.operators.quality import audit_rows, quarantine_rows, split_quality
from millrace.operators.validate import validate
from verification import queries

AS_OF = "2025-11-21"


def apply(spark, function, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r.out for r in df.withColumn("out", function(F.col("v"))).orderBy("i").collect()]


def test_name(spark):
    a, space = "Ã", " "
    out = apply(spark, repairs.repair_name, ["  an   t  binh ", None, "", "t le", "LE v HUY", f"{a}¡n b", f"{a}{space}nam", "xÄy z"])
    assert out == [
        "An Thị Binh", None, None, "T Le", "Le Văn Huy", "án B", "àNam", "Xäy Z",
    ]


def test_lonely_name_gets_a_surname(spark):
    df = spark.createDataFrame([("an",), ("an b",)], "ho_ten string")
    out = R.repair(validate(df, as_of=AS_OF)).orderBy("ho_ten").collect()
    assert {r.ho_ten for r in out} == {"Không Rõ An", "An B"}


def test_email(spark):
    out = apply(spark, repairs.repair_email, ["A b@gmial.com", "x@yaho.com.yaho.com", None, "", "a@outloook.com", "a@gmai.com"])
    assert out == ["ab@gmail.com", "x@yahoo.com.yaho.com", None, None, "a@outlook.com", "a@gmail.com"]


def test_birth_date(spark):
    default = C.DEFAULT_BIRTH_DATE
    values = ["05/06/2000", "02/13/2000", "5/6/2000", "31/02/2000", "1990-01-01", None, "", "01-02-1999", "1999/02/01",
              "2000-05-06T10:00:00", "1999-02-29", "2000-05-06T25:00:00", "+12000-01-01"]
    expected = ["2000-06-05", "2000-02-13", default, default, "1990-01-01", default, default, "1999-02-01", "1999-02-01",
                "2000-05-06", default, default, default]
    assert apply(spark, repairs.repair_birth_date, values) == expected


def test_birth_date_by_age(spark):
    context = repairs.RepairContext(F.lit(AS_OF).cast("date"))
    out = apply(
        spark,
        lambda v: repairs.repair_birth_date_by_age(v, None, context),
        ["20000506", "2020-01-01", "1890-01-01", "2030-01-01", "1990-01-01", None, "2012-11-21", "2012-11-22"],
    )
    default = C.DEFAULT_BIRTH_DATE
    assert out == ["2000-05-06", default, default, default, "1990-01-01", default, "2012-11-21", default]


def test_customer_type_and_status(spark):
    assert apply(spark, repairs.repair_customer_type, [None, "vip", "unknown", " ", " DOANH NGHIỆP "]) == [
        "Thường", "VIP", "Thường", "Thường", "Doanh nghiệp",
    ]
    assert apply(spark, repairs.repair_status, [None, "", "đã giao", "x"]) == [None, "", "Đã giao", "X"]


CUSTOMERS = [
    ("KH1", "an t binh", "A@x.vn", "0912345678", dt.date(1990, 1, 1), dt.date(2024, 1, 1), None),
    ("KH2", "An Binh", "bad", "1", None, None, "vip"),
    ("KH3", "An 1", "c@x.vn", None, dt.date(2020, 1, 1), None, "x"),
]
SCHEMA = (
    "ma_khach_hang string, ho_ten string, email string, so_dien_thoai string, ngay_sinh date, ngay_dang_ky date, "
    "loai_khach_hang string"
)


def test_repair_record(spark):
    first = validate(spark.createDataFrame(CUSTOMERS, SCHEMA), as_of=AS_OF)
    repaired = R.repair(first, as_of=AS_OF)
    rows = {r.ma_khach_hang: r for r in repaired.collect()}
    assert rows["KH1"].ho_ten == "An Thị Binh" and rows["KH1"].ngay_sinh == "1990-01-01"
    assert rows["KH2"].email == "bad" and rows["KH2"].so_dien_thoai == "1"  # neither has a repair that applies
    assert rows["KH2"].ngay_sinh == C.DEFAULT_BIRTH_DATE and rows["KH2"].loai_khach_hang == "VIP"
    assert rows["KH3"].ngay_sinh == "2020-01-01" and not rows["KH3"]._ngay_sinh_is_text  # too young: beyond repair
    assert rows["KH3"].loai_khach_hang == "Thường"
    log = {(c.field, c.original, c.transformed, c.action) for c in rows["KH2"]._changes}
    assert log == {
        ("loai_khach_hang", "vip", "VIP", "normalize"),
        ("ngay_sinh", "null", C.DEFAULT_BIRTH_DATE, "set_default_date"),
    }
    assert R.repair_summary(repaired).first().asDict() == {"total": 3, "transformed": 3, "skipped": 0}

    checked = validate(repaired, as_of=AS_OF)
    clean, failing = split_quality(checked)
    assert [r.ma_khach_hang for r in clean.collect()] == ["KH1"]
    assert {r.ma_khach_hang for r in failing.collect()} == {"KH2", "KH3"}
    assert {e.rule for r in failing.collect() if r.ma_khach_hang == "KH3" for e in r._errors} == {
        "name_digits", "dob_too_young", "dob_format",
    }
    # Checking clean rows again finds nothing; repairing them again changes nothing.
    again = validate(clean.withColumn("_ngay_sinh_is_text", F.lit(True)), as_of=AS_OF)
    assert again.where("not _is_valid").count() == 0
    assert R.repair(again).where("_changed").count() == 0

    table = C.DEFAULT_CATALOG["khach_hang"]
    assert {r.record_key for r in quarantine_rows(checked, table).collect()} == {"KH2", "KH3"}
    audit = {r.record_key: r for r in audit_rows(checked, table).collect()}
    assert '"ho_ten":"an t binh"' in audit["KH1"].original and '"ho_ten":"An Thị Binh"' in audit["KH1"].transformed


def test_type_is_left_alone_without_registration_column(spark):
    df = spark.createDataFrame([("KH1", "vip")], "ma_khach_hang string, loai_khach_hang string")
    assert R.repair(validate(df, as_of=AS_OF)).first().loai_khach_hang == "vip"


def test_tables_without_repairs_pass(spark):
    df = spark.createDataFrame([("DM1", "x")], "ma_danh_muc string, ten_danh_muc string")
    out = R.repair(validate(df, as_of=AS_OF)).first()
    assert not out._changed and out._changes == []


def test_strategy_sequence_conditional(spark):
    df = spark.createDataFrame([("an", "A@X.vn"), ("Bo", "b@x.vn")], "ho_ten string, email string")
    strategy = R.apply_strategy(df, "email", F.lower).orderBy("email").collect()
    assert [(r.email, r._changed) for r in strategy] == [("a@x.vn", True), ("b@x.vn", False)]
    sequence = R.apply_sequence(df, ["email", "nope", "ho_ten"]).orderBy("email").collect()
    assert [(r.ho_ten, r.email) for r in sequence] == [("An", "a@x.vn"), ("Bo", "b@x.vn")]
    # The condition of one column sees the input, not what another repair made of it.
    conditional = R.apply_conditional(df, {"email": F.col("ho_ten") == "an", "ho_ten": F.col("email") == "A@X.vn"})
    assert {(r.ho_ten, r.email) for r in conditional.collect()} == {("An", "a@x.vn"), ("Bo", "b@x.vn")}


def test_registry(spark):
    registry = repairs.default_repairs()
    assert set(registry.fields()) == {"email", "ho_ten", "loai_khach_hang", "ngay_sinh", "trang_thai"}
    registry.add("so_dien_thoai", lambda c: F.concat(F.lit("0"), c))
    df = spark.createDataFrame([("912345678",)], "so_dien_thoai string")
    out = R.repair(validate(df, as_of=AS_OF), registry).first()
    assert out.so_dien_thoai == "0912345678" and out._changes[0].action == "custom"


@pytest.mark.parametrize("parts", [1, 7])
def test_partitioning_does_not_matter(spark, parts):
    df = spark.createDataFrame(CUSTOMERS, SCHEMA).repartition(parts)
    out = R.repair(validate(df, as_of=AS_OF)).select("ma_khach_hang", "ho_ten", "ngay_sinh").collect()
    assert {tuple(r) for r in out} == {("KH1", "An Thị Binh", "1990-01-01"), ("KH2", "An Binh", "2004-05-29"), ("KH3", "An 1", "2020-01-01")}


def test_one_row_group_is_judged_in_many_tasks(spark, tmp_path):
    """Both runs of quality_drift and all that is repaired: a file that one task reads is dealt out before the rules."""
    customers = spark.range(4000).select(
        F.col("id").alias("c_custkey"), F.concat(F.lit("Customer"), "id").alias("c_name"), F.lit(1).alias("c_nationkey"),
        F.lit(1.5).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment"),
    )
    customers.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        repaired = queries._repaired(spark, str(tmp_path), "khach_hang")
        filled = repaired.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in filled) == 8000 and max(r["count"] for r in filled) < 3000
    drift = queries.quality_drift(spark, str(tmp_path))
    assert drift.count() > 0 and drift.select("record_key").distinct().count() == drift.count()
