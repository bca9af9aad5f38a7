"""Records with flaws, derived from the given tables by SQL that both engines read alike.

The tables are clean and have no names, mail addresses or phones, so these texts derive them from the
keys. Every text covers the whole of its table. Tables stand in braces: see :func:`for_spark` and
:func:`for_oracle`.
"""

from __future__ import annotations

import string
from functools import cache

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2025-11-21"
# The second source comes after every row of the first.
SECOND = 1 << 56

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_NAME = """CASE {k} % 13
    WHEN 0 THEN NULL
    WHEN 1 THEN 'nguyen van an'
    WHEN 2 THEN 'An'
    WHEN 3 THEN '  le   t nga '
    WHEN 4 THEN 'Tran 1 B'
    WHEN 5 THEN 'Tran @ Binh'
    WHEN 6 THEN 'Nguyen Thi Thanh Huong T'
    WHEN 7 THEN 'LE VAN'
    WHEN 8 THEN 'ly'
    WHEN 9 THEN 'tran v ' || lower({word})
    WHEN 10 THEN repeat('Nguyen Van ', 12) || {word}
    WHEN 11 THEN 'Hoang Minh ' || {word}
    ELSE 'Pham ' || {word} END"""

_EMAIL = """CASE {k} % 11
    WHEN 0 THEN NULL
    WHEN 1 THEN ''
    WHEN 2 THEN ' User' || CAST({k} AS STRING) || '@Mail.VN '
    WHEN 3 THEN 'us er' || CAST({k} AS STRING) || '@gmial.com'
    WHEN 4 THEN 'user' || CAST({k} AS STRING) || '@mail'
    WHEN 5 THEN 'u' || CAST({k} AS STRING) || '@@mail.vn'
    WHEN 6 THEN 'user<' || CAST({k} AS STRING) || '>@mail.vn'
    ELSE 'user' || CAST({k} AS STRING) || '@mail.vn' END"""

_PHONE = """CASE {k} % 7
    WHEN 0 THEN NULL
    WHEN 1 THEN '9' || lpad(CAST({k} AS STRING), 8, '0')
    WHEN 2 THEN '+84' || lpad(CAST({k} AS STRING), 9, '0')
    WHEN 3 THEN ''
    ELSE '0' || lpad(CAST({k} AS STRING), 9, '0') END"""

_BIRTH = """CASE {k} % 9
    WHEN 0 THEN CAST(NULL AS DATE)
    WHEN 1 THEN DATE '2015-01-01' + CAST({k} % 300 AS INT)
    WHEN 2 THEN DATE '1895-05-05' + CAST({k} % 300 AS INT)
    WHEN 3 THEN DATE '2030-01-01' + CAST({k} % 300 AS INT)
    WHEN 4 THEN DATE '2012-11-10' + CAST({k} % 23 AS INT)
    ELSE DATE '1960-01-01' + CAST({k} % 15000 AS INT) END"""

_TYPE = """CASE {k} % 7
    WHEN 0 THEN NULL
    WHEN 1 THEN 'vip'
    WHEN 2 THEN 'unknown'
    WHEN 3 THEN ' '
    WHEN 4 THEN ' doanh nghiệp'
    WHEN 5 THEN 'Mới'
    ELSE 'VIP' END"""

_ORDER_STATUS = """CASE {k} % 9
    WHEN 0 THEN 'Chờ xử lý'
    WHEN 1 THEN 'đang giao'
    WHEN 2 THEN 'Đã giaoo'
    WHEN 3 THEN 'Đã giao'
    WHEN 4 THEN 'shipped somewhere'
    WHEN 5 THEN ' '
    WHEN 6 THEN 'dang chuẩn bị'
    WHEN 7 THEN 'Hủy'
    ELSE 'Trả hàng' END"""

_PAYMENT_STATUS = """CASE {k} % 6
    WHEN 0 THEN 'Đang xử lý'
    WHEN 1 THEN 'Đã thanh toán'
    WHEN 2 THEN 'Thành công'
    WHEN 3 THEN 'đang xử lý'
    WHEN 4 THEN NULL
    ELSE 'Hoàn tiền' END"""

_TICKET_STATUS = """CASE {k} % 6
    WHEN 0 THEN 'Mới'
    WHEN 1 THEN 'Đang xử lý'
    WHEN 2 THEN 'Hoàn thành'
    WHEN 3 THEN 'đóng'
    WHEN 4 THEN 'Đã giải quyet'
    ELSE 'Chờ phản hồi' END"""


def _fill(text: str, **values: str) -> str:
    for name, value in values.items():
        text = text.replace("{" + name + "}", value)
    return text


_CUSTOMER_COLUMNS = """
    CAST({k} AS BIGINT) + {base} AS _seq,
    'KH' || CAST({k} AS STRING) AS ma_khach_hang,
    {name} AS ho_ten,
    {email} AS email,
    {phone} AS so_dien_thoai,
    {address} AS dia_chi,
    {birth} AS ngay_sinh,
    {registered} AS ngay_dang_ky,
    {gender} AS gioi_tinh,
    {kind} AS loai_khach_hang,
    '{source}' AS source"""

RELATIONAL_CUSTOMERS = "SELECT" + _fill(
    _CUSTOMER_COLUMNS,
    base="0",
    name=_NAME,
    email=_EMAIL,
    phone=_PHONE,
    address="c_mktsegment",
    birth=_BIRTH,
    registered="DATE '2020-01-01' + CAST({k} % 1000 AS INT)",
    gender="CASE {k} % 3 WHEN 0 THEN 'Nam' WHEN 1 THEN 'Nữ' ELSE NULL END",
    kind=_TYPE,
    source="postgresql",
).replace("{k}", "c_custkey").replace("{word}", "c_mktsegment") + " FROM {customer}"

# Every customer once more, half of them under the mail address of another.
CSV_CUSTOMERS = "SELECT" + _fill(
    _CUSTOMER_COLUMNS,
    base=str(SECOND),
    name="CASE c_custkey % 5 WHEN 0 THEN NULL ELSE 'Vu Thi ' || c_mktsegment END",
    email="'USER' || CAST(c_custkey * 2 AS STRING) || '@mail.vn'",
    phone=_PHONE,
    address="CAST(NULL AS STRING)",
    birth="CAST(NULL AS DATE)",
    registered="CAST(NULL AS DATE)",
    gender="CAST(NULL AS STRING)",
    kind=_TYPE,
    source="csv",
).replace("{k}", "c_custkey").replace("{word}", "c_mktsegment") + " FROM {customer}"

CUSTOMERS = f"{RELATIONAL_CUSTOMERS} UNION ALL {CSV_CUSTOMERS}"

CATEGORIES = """SELECT CAST(n_nationkey AS BIGINT) AS _seq, 'DM' || CAST(n_nationkey AS STRING) AS ma_danh_muc,
    n_name AS ten_danh_muc, 'postgresql' AS source FROM {nation}"""

PRODUCTS = """SELECT CAST(p_partkey AS BIGINT) AS _seq, 'SP' || CAST(p_partkey AS STRING) AS ma_san_pham,
    p_name AS ten_san_pham, p_type AS mo_ta, 'DM' || CAST(p_size % 30 AS STRING) AS ma_danh_muc,
    CAST(CASE WHEN p_partkey % 17 = 0 THEN -1 WHEN p_partkey % 17 = 1 THEN 1000000000
         WHEN p_partkey % 17 = 2 THEN NULL ELSE floor(p_retailprice) END AS DECIMAL(12, 2)) AS don_gia,
    CAST(p_size AS INT) AS ton_kho, 'postgresql' AS source FROM {part}"""

AGENTS = _fill(
    """SELECT CAST(s_suppkey AS BIGINT) + {base} AS _seq, 'NV' || CAST(s_suppkey AS STRING) AS ma_nhan_vien,
    'Le Van ' || CASE s_suppkey % 4 WHEN 0 THEN 'Minh' WHEN 1 THEN 'hai' ELSE 'Hoa' END AS ho_ten,
    CASE WHEN s_suppkey % 20 = 0 THEN 'no mail' ELSE 'agent' || CAST(s_suppkey % 60 AS STRING) || '@cskh.vn' END AS email,
    CAST(NULL AS STRING) AS so_dien_thoai,
    'Nhân viên' AS chuc_vu, 'CSKH' AS phong_ban, DATE '2022-01-01' + CAST(s_suppkey % 700 AS INT) AS ngay_tuyen_dung,
    CASE s_suppkey % 4 WHEN 0 THEN 'Đang làm' WHEN 1 THEN 'nghỉ phép' WHEN 2 THEN 'Đã nghỉ' ELSE 'Đang lam' END AS trang_thai,
    'csv' AS source FROM {supplier}""",
    base=str(SECOND),
)

ORDERS = """SELECT CAST(o_orderkey AS BIGINT) AS _seq, 'DH' || CAST(o_orderkey AS STRING) AS ma_don_hang,
    CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN ''
         ELSE 'KH' || CAST(o_custkey AS STRING) END AS ma_khach_hang,
    CAST(o_orderdate AS DATE) AS ngay_dat, CAST(floor(o_totalprice) AS DECIMAL(12, 2)) AS tong_tien,
    {status} AS trang_thai, 'postgresql' AS source FROM {orders}""".replace(
    "{status}", _ORDER_STATUS.replace("{k}", "o_orderkey")
)

# Line numbers repeat within an order, so the position counts the price of the line too.
ITEMS = """SELECT CAST((l_orderkey * 8 + l_linenumber) * 1000000 + floor(l_extendedprice) AS BIGINT) AS _seq,
    'DH' || CAST(l_orderkey AS STRING) AS ma_don_hang,
    'SP' || CAST(l_partkey AS STRING) AS ma_san_pham,
    CAST(CASE l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE l_quantity END AS INT) AS so_luong,
    CAST(floor(l_extendedprice) AS DECIMAL(12, 2)) AS don_gia, 'postgresql' AS source FROM {lineitem}"""

PAYMENTS = """SELECT CAST(o_orderkey AS BIGINT) AS _seq, 'TT' || CAST(o_orderkey AS STRING) AS ma_thanh_toan,
    'DH' || CAST(o_orderkey AS STRING) AS ma_don_hang, CAST(o_orderdate AS DATE) AS ngay_thanh_toan,
    CAST(floor(o_totalprice) AS DECIMAL(12, 2)) AS so_tien, {status} AS trang_thai, o_orderpriority AS phuong_thuc,
    'postgresql' AS source FROM {orders}""".replace("{status}", _PAYMENT_STATUS.replace("{k}", "o_orderkey"))

TICKETS = """SELECT CAST(event_id AS BIGINT) + {base} AS _seq, 'PHT' || CAST(event_id AS STRING) AS ma_phieu_ho_tro,
    'KH' || CAST(user_id AS STRING) AS ma_khach_hang, event_type AS loai_van_de, props AS mo_ta,
    CAST(ts AS TIMESTAMP) AS ngay_tao, {status} AS trang_thai, 'Cao' AS do_uu_tien, 'csv' AS source
    FROM {events}""".replace("{status}", _TICKET_STATUS.replace("{k}", "event_id")).replace("{base}", str(SECOND))

RATINGS = """SELECT CAST(event_id AS BIGINT) + {base} AS _seq, 'DG' || CAST(event_id AS STRING) AS ma_danh_gia,
    'KH' || CAST(user_id AS STRING) AS ma_khach_hang, CAST(event_id % 5 + 1 AS INT) AS diem_danh_gia,
    event_type AS nhan_xet, CAST(ts AS DATE) AS ngay_danh_gia, 'csv' AS source
    FROM {events}""".replace("{base}", str(SECOND))

ACTIONS = """SELECT CAST(event_id AS BIGINT) + {base} AS _seq, 'PXL' || CAST(event_id AS STRING) AS ma_phieu_xu_ly,
    'PHT' || CAST(event_id AS STRING) AS ma_phieu_ho_tro, 'NV' || CAST(user_id % 90 AS STRING) AS ma_nhan_vien,
    CAST(ts AS TIMESTAMP) AS ngay_xu_ly, event_type AS hanh_dong, 'Thành công' AS ket_qua, props AS ghi_chu,
    'csv' AS source FROM {events}""".replace("{base}", str(SECOND))

STAR = {
    "khach_hang": CUSTOMERS,
    "danh_muc": CATEGORIES,
    "san_pham": PRODUCTS,
    "nhanvien_cskh": AGENTS,
    "don_hang": ORDERS,
    "chi_tiet_don_hang": ITEMS,
    "thanh_toan": PAYMENTS,
    "phieu_ho_tro": TICKETS,
    "danh_gia": RATINGS,
    "phieu_xu_ly": ACTIONS,
}

# Ids as they may arrive: plain, missing, empty, already prefixed, of an unknown source.
IDS = """SELECT CAST(o_orderkey AS BIGINT) AS _seq,
    CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'PG_DH' || CAST(o_orderkey AS STRING)
         WHEN 3 THEN 'CSV_PG_DH' || CAST(o_orderkey AS STRING) ELSE 'DH' || CAST(o_orderkey AS STRING) END AS ma_don_hang,
    'KH' || CAST(o_custkey AS STRING) AS ma_khach_hang,
    CASE o_orderkey % 4 WHEN 0 THEN 'postgresql' WHEN 1 THEN 'csv' WHEN 2 THEN 'other' ELSE NULL END AS source
    FROM {orders}"""

# Birth dates as text in many layouts.
BIRTH_TEXTS = """SELECT CAST(o_orderkey AS BIGINT) AS _seq, CAST(CASE o_orderkey % 11
    WHEN 0 THEN NULL WHEN 1 THEN ''
    WHEN 2 THEN lpad(CAST(o_orderkey % 31 + 1 AS STRING), 2, '0') || '/0' || CAST(o_orderkey % 9 + 1 AS STRING) || '/1990'
    WHEN 3 THEN '0' || CAST(o_orderkey % 9 + 1 AS STRING) || '/' || lpad(CAST(o_orderkey % 18 + 13 AS STRING), 2, '0') || '/1985'
    WHEN 4 THEN lpad(CAST(o_orderkey % 31 + 1 AS STRING), 2, '0') || '-12-2001'
    WHEN 5 THEN '1979/11/' || lpad(CAST(o_orderkey % 32 AS STRING), 2, '0')
    WHEN 6 THEN '5/6/2000' WHEN 7 THEN 'soon'
    WHEN 8 THEN CAST(1880 + o_orderkey % 160 AS STRING) || '-02-28'
    WHEN 9 THEN '1999-04-' || lpad(CAST(o_orderkey % 33 AS STRING), 2, '0')
    ELSE '20' || lpad(CAST(o_orderkey % 30 AS STRING), 2, '0') || '-06-15' END AS STRING) AS ngay_sinh
    FROM {orders}"""

PRICE_TEXTS = """SELECT CAST(p_partkey AS BIGINT) AS _seq, CAST(CASE p_partkey % 10
    WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '12abc' WHEN 3 THEN '-1' WHEN 4 THEN '999999999'
    WHEN 5 THEN '1000000000' WHEN 6 THEN 'abc' WHEN 7 THEN ' 7.5 ' WHEN 8 THEN '.5e1x'
    ELSE CAST(p_partkey AS STRING) END AS STRING) AS don_gia FROM {part}"""

# Rows that repeat in full: the kinds of events of each user.
REPEATED = "SELECT user_id, event_type FROM {events}"


def tables_of(text: str) -> list[str]:
    return [name for _, name, _, _ in string.Formatter().parse(text) if name]


def for_oracle(text: str) -> str:
    return text.format(**{t: t for t in TABLES})


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def for_spark(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    frames = {t: read(spark, sf_dir, t) for t in dict.fromkeys(tables_of(text))}
    return spark.sql(text, **frames)


@cache
def ctes(*names: str) -> str:
    """The inputs as leading parts of a WITH clause, named by their logical tables."""
    return ", ".join(f"{n} AS ({for_oracle(STAR[n])})" for n in names)
