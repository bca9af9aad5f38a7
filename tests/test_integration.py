"""The whole way from two sources to a star schema, on small made-up sources."""

import csv

import pytest
from pyspark.sql import functions as F

from millrace import catalog as C
from millrace.operators.load import integrity_audit, read_star
from millrace.plans.integration import Options, run
from millrace.session import scratch_path
from millrace.sources.tables import Relational
from millrace.streaming.ingest import StagingArea, read_staged

AS_OF = "2025-11-21"

RELATIONAL = {
    "khach_hang": (
        "ma_khach_hang string, ho_ten string, email string, so_dien_thoai string, dia_chi string, ngay_sinh date, "
        "ngay_dang_ky date, gioi_tinh string, loai_khach_hang string",
        [
            ("KH1", "nguyen van an", "an@x.vn", "0912345678", "HN", None, None, "Nam", None),
            ("KH2", "Le Thi Hoa", None, "0912345678", None, None, None, None, "VIP"),
            ("KH3", None, None, None, "HCM", None, None, None, None),
            ("KH4", "Bo 4", "bo@x.vn", None, None, None, None, None, "?"),
            ("KH5", "Tran Van Ba", "ba@x.vn", "123", None, None, None, None, None),
        ],
    ),
    "danh_muc": ("ma_danh_muc string, ten_danh_muc string", [("DM1", "Sach"), ("DM2", "But")]),
    "san_pham": (
        "ma_san_pham string, ten_san_pham string, mo_ta string, ma_danh_muc string, don_gia decimal(12,2), ton_kho int",
        [("SP1", "a", None, "DM1", 5, 1), ("SP2", "b", None, "DM9", 5, 1), ("SP3", "c", None, None, -5, 1)],
    ),
    "don_hang": (
        "ma_don_hang string, ma_khach_hang string, ngay_dat string, tong_tien int, trang_thai string",
        [
            ("DH1", "KH1", "2025-01-01", 10, "đã giao"),
            ("DH2", "KH4", "2025-01-01", 10, "Đã giao"),
            ("DH3", None, "2025-01-01", 10, "Hủy"),
            ("DH4", "KH1", "2025-01-01", 10, "???"),
            ("DH1", "KH1", "2025-01-02", 99, "Đã giao"),
        ],
    ),
    "chi_tiet_don_hang": (
        "ma_don_hang string, ma_san_pham string, so_luong int, don_gia int",
        [("DH1", "SP1", 0, 5), ("DH1", "SP1", 3, 6), ("DH1", "SP2", 1, 5), ("DH9", "SP1", 1, 5)],
    ),
    "thanh_toan": (
        "ma_thanh_toan string, ma_don_hang string, ngay_thanh_toan string, so_tien int, trang_thai string, phuong_thuc string",
        [("TT1", "DH1", "2025-01-03", 10, "Thành công", "COD"), ("TT2", "DH1", "2025-01-03", 10, "Đang xử lý", "COD")],
    ),
}
CSV_FILES = {
    "khach_hang": [
        ["ma_khach_hang", "ho_ten", "email", "so_dien_thoai", "loai_khach_hang"],
        ["KH1", "Pham Van Nam", " AN@x.vn ", "0987654321", "vip"],
        ["KH7", "Vu Thi Lan", "lan@x.vn", "0987654321", "mới"],
    ],
    "nhanvien_cskh": [
        ["ma_nhan_vien", "ho_ten", "email", "so_dien_thoai", "chuc_vu", "phong_ban", "ngay_tuyen_dung", "trang_thai"],
        ["NV1", "Le Van Tam", "tam@x.vn", "", "Nhân viên", "CSKH", "2024-01-01", "Đang lam"],
        ["NV2", "Le Van Tu", "tam@x.vn", "", "Nhân viên", "CSKH", "2024-01-01", "Đang làm"],
    ],
    "phieu_ho_tro": [
        ["ma_phieu_ho_tro", "ma_khach_hang", "loai_van_de", "mo_ta", "ngay_tao", "trang_thai", "do_uu_tien"],
        ["PHT1", "KH7", "a", 'with "quotes", and comma', "2025-11-01 09:30:00.000000", "Mới", "Cao"],
        ["PHT2", "KH1", "a", "b", "2025-11-01 09:30:00.000000", "Mới", "Cao"],
    ],
    "danh_gia": [
        ["ma_danh_gia", "ma_khach_hang", "diem_danh_gia", "nhan_xet", "ngay_danh_gia"],
        ["DG1", "KH7", "5", "tốt", "2025-11-02"],
        ["DG2", "KH7", "five", "?", "2025-11-02"],
    ],
    "phieu_xu_ly": [
        ["ma_phieu_xu_ly", "ma_phieu_ho_tro", "ma_nhan_vien", "ngay_xu_ly", "hanh_dong", "ket_qua", "ghi_chu"],
        ["PXL1", "PHT1", "NV1", "2025-11-01 10:00:00.000000", "x", "Thành công", ""],
        ["PXL2", "PHT1", "NV2", "2025-11-01 10:00:00.000000", "x", "Thành công", ""],
    ],
}


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sources")
    for name, (schema, rows) in RELATIONAL.items():
        text = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows],
                                     ", ".join(f"{p.split()[0]} string" for p in schema.replace("(12,2)", "").split(",")))
        types = dict(p.strip().split(" ", 1) for p in schema.replace("decimal(12,2)", "decimal(12;2)").split(","))
        text.select(*[F.col(c).cast(t.replace(";", ",")).alias(c) for c, t in types.items()]).write.parquet(f"{folder}/{name}.parquet")
    for name, rows in CSV_FILES.items():
        with open(folder / f"{name}.csv", "w", encoding="utf8", newline="") as f:
            csv.writer(f).writerows(rows)
    root = scratch_path(spark, "run")
    return run(spark, root, Relational("parquet", str(folder)), str(folder), options=Options(as_of=AS_OF), chunk=2)


def test_star(spark, finished):
    star = read_star(spark, f"{finished.root}/warehouse")
    ids = {n: {r[0] for r in df.collect()} for n, df in star.items()}
    # KH1 of both sources are one person by mail; the other source's children of KH1 lose their parent.
    assert ids["khach_hang"] == {"PG_KH1", "CSV_KH7"}
    assert ids["danh_muc"] == {"PG_DM1", "PG_DM2"}
    assert ids["san_pham"] == {"PG_SP1"}
    assert ids["nhanvien_cskh"] == {"CSV_NV1"}  # the second agent has the same mail address
    assert ids["don_hang"] == {"PG_DH1", "PG_DH3"}
    assert ids["thanh_toan"] == {"PG_TT2"}
    assert ids["phieu_ho_tro"] == {"CSV_PHT1"} and ids["danh_gia"] == {"CSV_DG1"} and ids["phieu_xu_ly"] == {"CSV_PXL1"}
    customer = star["khach_hang"].where("ma_khach_hang = 'PG_KH1'").first()
    assert (customer.ho_ten, customer.email, customer.loai_khach_hang) == ("Nguyen Van An", "an@x.vn", "VIP")
    assert str(customer.ngay_sinh) == C.DEFAULT_BIRTH_DATE
    order = star["don_hang"].where("ma_don_hang = 'PG_DH1'").first()
    assert order.trang_thai == "Đã giao" and int(order.tong_tien) == 10
    item = star["chi_tiet_don_hang"].collect()
    assert [(r.ma_don_hang, r.ma_san_pham, r.so_luong) for r in item] == [("PG_DH1", "PG_SP1", 3)]
    assert star["phieu_ho_tro"].first().mo_ta == 'with "quotes", and comma'
    assert integrity_audit(star).where("n > 0").count() == 0


def test_counts(spark, finished):
    report = {(r.phase, r.table_name, r.metric): r.value for r in finished.report.collect()}
    assert report["ingest", "postgresql/khach_hang", "processed_messages"] == 3
    assert report["dedup", "khach_hang", "original"] == 7 and report["dedup", "khach_hang", "after"] == 5
    assert report["validate", "khach_hang", "valid"] == 0
    assert report["final", "khach_hang", "clean"] == 2 and report["final", "khach_hang", "still_invalid"] == 3
    assert report["load", "don_hang", "skipped"] == 1 and report["load", "don_hang", "loaded"] == 2
    assert report["load", "nhanvien_cskh", "offered"] == 2 and report["load", "nhanvien_cskh", "loaded"] == 1
    for name in RELATIONAL | CSV_FILES:
        assert report["final", name, "clean"] + report["final", name, "still_invalid"] == report["dedup", name, "after"]
        assert report["load", name, "offered"] == report["final", name, "clean"]


def test_staging_and_side_tables(spark, finished):
    staged = read_staged(spark, StagingArea(f"{finished.root}/staging"))
    assert staged["danh_gia"].count() == 1  # "five" is no rating
    assert [r._seq for r in staged["khach_hang"].orderBy("_seq").collect()][0] == 0
    quarantine = spark.read.parquet(finished.quarantine)
    assert quarantine.where("table_name = 'khach_hang'").count() == 3
    audit = spark.read.parquet(finished.audit)
    assert {r.record_key for r in audit.where("table_name = 'don_hang'").collect()} == {"PG_DH1"}


def test_options(spark, finished):
    from millrace.plans.integration import plan_quality

    staged = read_staged(spark, StagingArea(f"{finished.root}/staging"))
    payments = C.DEFAULT_CATALOG["thanh_toan"]
    by_table = plan_quality(staged["thanh_toan"], payments, Options(as_of=AS_OF, status_context="table")).checked
    assert by_table.where("_is_valid").count() == 2
    customers = C.DEFAULT_CATALOG["khach_hang"]
    kept = plan_quality(staged["khach_hang"], customers, Options(as_of=AS_OF, null_keys="keep")).merged
    assert kept.count() == 6
