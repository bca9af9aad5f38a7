"""Schemas, keys, reference graph, value domains and limits of the integrated model.

Everything here is plain data. Operators take what they need as arguments and use this catalogue
only for defaults, so another model can be integrated by building another :class:`Catalog`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --------------------------------------------------------------------------------------------
# They must equal the known ones for results to be right.
# --------------------------------------------------------------------------------------------

ORDER_STATUSES = (
    "Chờ xử lý",
    "Đang chuẩn bị",
    "Đang giao",
    "Đã giao",
    "Hủy",
    "Trả hàng",
    "Đang xử lý",
)
PAYMENT_STATUSES = (
    "Chưa thanh toán",
    "Đã thanh toán",
    "Hoàn tiền",
    "Thất bại",
    "Thành công",
    "Đang xử lý",
)
TICKET_STATUSES = (
    "Mới",
    "Đang xử lý",
    "Chờ phản hồi",
    "Đã giải quyết",
    "Đóng",
    "Hủy",
)
AGENT_STATUSES = ("Đang làm", "Nghỉ phép", "Đã nghỉ")
CUSTOMER_TYPES = ("Thường", "VIP", "Doanh nghiệp", "Mới")

# Domains and patterns that are declared but enforced by no default rule; see rules.domain_rule,
# rules.pattern_rule and rules.range_rule for opting in.
PAYMENT_METHODS = ("Tiền mặt", "Chuyển khoản", "Thẻ tín dụng", "Ví điện tử", "COD")
GENDERS = ("Nam", "Nữ", "Khác")
PRIORITIES = ("Thấp", "Trung bình", "Cao", "Khẩn cấp")
POSITIONS = ("Nhân viên", "Trưởng nhóm", "Quản lý", "Giám đốc")
OUTCOMES = ("Thành công", "Thất bại", "Đang xử lý")
ID_PATTERNS = {
    "ma_khach_hang": r"^KH\d{4}\z",
    "ma_don_hang": r"^DH\d{4}\z",
    "ma_san_pham": r"^SP\d{4}\z",
    "ma_danh_muc": r"^DM\d{4}\z",
    "ma_thanh_toan": r"^TT\d{4}\z",
    "ma_phieu_ho_tro": r"^PHT\d{4}\z",
    "ma_danh_gia": r"^DG\d{4}\z",
    "ma_nhan_vien": r"^NV\d{4}\z",
    "ma_phieu_xu_ly": r"^PXL\d{4}\z",
}

# "\z" and not "$": a Java "$" would also match before a trailing newline.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\z"
PHONE_PATTERN = r"^(0|\+84)[0-9]{9,10}\z"

MIN_AGE, MAX_AGE = 13, 120
MIN_PRICE, MAX_PRICE = 0, 999999999
MIN_QUANTITY, MAX_QUANTITY = 1, 10000
MIN_RATING, MAX_RATING = 1, 5
MAX_NAME_LENGTH = 100
MAX_EMAIL_LENGTH = 100
MAX_PHONE_LENGTH = 20
MIN_BIRTH_YEAR = 1900

INVALID_FORMAT = "E001"
NULL_VALUE = "E002"
OUT_OF_RANGE = "E003"
DUPLICATE = "E004"
INVALID_REFERENCE = "E005"
INVALID_DATE = "E006"
INVALID_STATUS = "E007"

DEFAULT_BIRTH_DATE = "2004-05-29"
DEFAULT_CUSTOMER_TYPE = "Thường"
DEFAULT_SURNAME = "Không Rõ"
STATUS_SIMILARITY = 0.3

NAME_ABBREVIATIONS = {
    "v": "Văn",
    "t": "Thị",
    "h": "Hữu",
    "d": "Đức",
    "k": "Kim",
    "m": "Minh",
    "n": "Ngọc",
}
# Wrongly decoded letters, replaced one after the other in this order.
NAME_MOJIBAKE = {
    "Ã¡": "á",
    "Ã ": "à",
    "áº¡": "ạ",
    "áº£": "ả",
    "Ã£": "ã",
    "Ä": "đ",
}
# Wrong mail domains, the first occurrence of each replaced in this order.
EMAIL_TYPOS = {
    "gmial.com": "gmail.com",
    "gmai.com": "gmail.com",
    "yahooo.com": "yahoo.com",
    "yaho.com": "yahoo.com",
    "hotmial.com": "hotmail.com",
    "outloook.com": "outlook.com",
}

# Error messages, by rule.
MESSAGES = {
    "name_blank": "Họ tên không được để trống",
    "name_digits": "Họ tên không được chứa số",
    "name_special": "Họ tên không được chứa ký tự đặc biệt",
    "name_length": "Họ tên không được vượt quá 100 ký tự",
    "name_min_words": "Họ tên phải có ít nhất 2 từ (họ và tên)",
    "name_abbreviated": "Họ tên quá dài và có viết tắt",
    "name_capitals": "Chữ cái đầu của mỗi từ cần viết hoa",
    "email_blank": "Email không được để trống",
    "email_pattern": "Email không đúng định dạng",
    "email_length": "Email không được vượt quá 100 ký tự",
    "email_space": "Email không được chứa khoảng trắng",
    "email_sides": "Email thiếu phần trước hoặc sau @",
    "email_domain": "Domain email không hợp lệ (thiếu .)",
    "email_chars": "Email chứa ký tự đặc biệt không hợp lệ",
    "phone_pattern": "Số điện thoại không hợp lệ. Phải bắt đầu bằng 0 hoặc +84 và có 9-10 số theo sau.",
    "dob_null": "Ngày sinh bị null, sẽ được gán giá trị mặc định",
    "dob_parse": "Ngày sinh không đúng định dạng",
    "dob_future": "Ngày sinh không được là ngày trong tương lai",
    "dob_too_young": "Tuổi phải từ 13 trở lên",
    "dob_too_old": "Tuổi không được vượt quá 120",
    "dob_year": "Năm sinh phải sau năm 1900",
    "dob_format": "Định dạng ngày sinh nên là YYYY-MM-DD",
    "status_blank": "Trạng thái không được để trống",
    "status_unknown": "Trạng thái không hợp lệ",
    "status_case": "Trạng thái cần chuẩn hóa chữ hoa/thường",
    "price_number": "Đơn giá phải là một con số.",
    "price_range": "Đơn giá phải nằm trong khoảng từ 0 đến 999999999.",
}
SUGGESTIONS = {
    "name_min_words": 'Thêm "Không rõ" vào cuối nếu chỉ có 1 từ',
    "name_capitals": "Chuyển chữ cái đầu mỗi từ thành chữ hoa",
    "email_space": "Xóa tất cả khoảng trắng",
    "phone_pattern": "Chuẩn hóa về định dạng 0xxxxxxxxx",
    "dob_null": "Gán ngày sinh mặc định: 2004-05-29",
    "dob_parse": "Thử parse với các format khác nhau",
    "dob_format": "Chuyển thành ",
    "status_unknown": "Có thể là: ",
    "status_case": "Chuyển thành: ",
}

# --------------------------------------------------------------------------------------------
# Sources
# --------------------------------------------------------------------------------------------

RELATIONAL = "postgresql"
CSV = "csv"
ID_PREFIXES = {RELATIONAL: "PG_", CSV: "CSV_"}
# Arrival order of the sources: a lower rank wins wherever "the first row" decides.
SOURCE_RANKS = {RELATIONAL: 0, CSV: 1}
ID_COLUMNS = tuple(ID_PATTERNS)

# Lineage columns that staging adds and loading drops.
SOURCE_COLUMN = "source"
INSERTED_AT_COLUMN = "inserted_at"
ORDER_COLUMN = "_seq"
CREATED_AT_COLUMN = "created_at"

STATUS_DOMAINS = {
    "don_hang": ORDER_STATUSES,
    "thanh_toan": PAYMENT_STATUSES,
    "phieu_ho_tro": TICKET_STATUSES,
    "nhanvien_cskh": AGENT_STATUSES,
}
# The first of these columns that a row fills decides which status domain judges it.
STATUS_CONTEXT_COLUMNS = {
    "ma_don_hang": "don_hang",
    "ma_thanh_toan": "thanh_toan",
    "ma_phieu_ho_tro": "phieu_ho_tro",
    "ma_nhan_vien": "nhanvien_cskh",
}

# --------------------------------------------------------------------------------------------
# Tables
# --------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Column:
    name: str
    dtype: T.DataType
    max_length: int | None = None
    not_null: bool = False
    minimum: float | None = None
    maximum: float | None = None
    default: str | None = None


@dataclass(frozen=True)
class Table:
    """One logical table over its three layers: raw, staging and warehouse."""

    name: str
    warehouse_name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...]
    dedup_key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: dict[str, str] = field(default_factory=dict)
    sources: tuple[str, ...] = (RELATIONAL,)
    has_created_at: bool = True

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def id_columns(self) -> list[str]:
        """The columns that hold ids: those of the primary key and references."""
        return [c.name for c in self.columns if c.name in self.primary_key or c.name in self.foreign_keys]

    @property
    def staging_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype) for c in self.columns])

    @property
    def is_dimension(self) -> bool:
        return self.warehouse_name.startswith("dim_")


def _text(name: str, length: int | None = None, **kw) -> Column:
    return Column(name, T.StringType(), length, **kw)


def _id(name: str) -> Column:
    return _text(name, 20)


def _money(name: str) -> Column:
    return Column(name, T.DecimalType(12, 2))


def _int(name: str, **kw) -> Column:
    return Column(name, T.IntegerType(), **kw)


def _date(name: str, **kw) -> Column:
    return Column(name, T.DateType(), **kw)


def _timestamp(name: str) -> Column:
    return Column(name, T.TimestampNTZType())


@dataclass(frozen=True)
class Catalog:
    """Tables in load order: parents stand before their children."""

    tables: dict[str, Table]

    def __getitem__(self, name: str) -> Table:
        return self.tables[name]

    def __iter__(self):
        return iter(self.tables.values())

    def by_source(self, source: str) -> list[str]:
        return [t.name for t in self if source in t.sources]

    @property
    def wide_columns(self) -> dict[str, T.DataType]:
        """Every column of every table; a name has one type throughout."""
        wide: dict[str, T.DataType] = {}
        for table in self:
            for column in table.columns:
                if wide.setdefault(column.name, column.dtype) != column.dtype:
                    raise ValueError(f"column {column.name} has more than one type in the catalogue")
        return wide


def _catalog(*tables: Table) -> Catalog:
    return Catalog({t.name: t for t in tables})


DEFAULT_CATALOG = _catalog(
    Table(
        "khach_hang",
        "dim_khach_hang",
        (
            _id("ma_khach_hang"),
            _text("ho_ten", 100, not_null=True),
            _text("email", 100, not_null=True),
            _text("so_dien_thoai", 20),
            _text("dia_chi", 255),
            _date("ngay_sinh"),
            _date("ngay_dang_ky"),
            _text("gioi_tinh", 10),
            _text("loai_khach_hang", 50, default=DEFAULT_CUSTOMER_TYPE),
        ),
        primary_key=("ma_khach_hang",),
        dedup_key=("email",),
        unique=(("email",),),
        sources=(RELATIONAL, CSV),
    ),
    Table(
        "danh_muc",
        "dim_danh_muc",
        (_id("ma_danh_muc"), _text("ten_danh_muc", 100, not_null=True)),
        primary_key=("ma_danh_muc",),
        dedup_key=("ma_danh_muc",),
    ),
    Table(
        "san_pham",
        "dim_san_pham",
        (
            _id("ma_san_pham"),
            _text("ten_san_pham", 150, not_null=True),
            _text("mo_ta"),
            _id("ma_danh_muc"),
            _money("don_gia"),
            _int("ton_kho"),
        ),
        primary_key=("ma_san_pham",),
        dedup_key=("ma_san_pham",),
        foreign_keys={"ma_danh_muc": "danh_muc"},
    ),
    Table(
        "nhanvien_cskh",
        "dim_nhanvien_cskh",
        (
            _id("ma_nhan_vien"),
            _text("ho_ten", 100, not_null=True),
            _text("email", 100),
            _text("so_dien_thoai", 20),
            _text("chuc_vu", 50),
            _text("phong_ban", 50),
            _date("ngay_tuyen_dung"),
            _text("trang_thai", 20),
        ),
        primary_key=("ma_nhan_vien",),
        dedup_key=("ma_nhan_vien",),
        unique=(("email",),),
        sources=(CSV,),
    ),
    Table(
        "don_hang",
        "fact_don_hang",
        (
            _id("ma_don_hang"),
            _id("ma_khach_hang"),
            _date("ngay_dat", not_null=True),
            _money("tong_tien"),
            _text("trang_thai", 50),
        ),
        primary_key=("ma_don_hang",),
        dedup_key=("ma_don_hang",),
        foreign_keys={"ma_khach_hang": "khach_hang"},
    ),
    Table(
        "chi_tiet_don_hang",
        "fact_chi_tiet_don_hang",
        (_id("ma_don_hang"), _id("ma_san_pham"), _int("so_luong"), _money("don_gia")),
        primary_key=("ma_don_hang", "ma_san_pham"),
        dedup_key=("ma_don_hang", "ma_san_pham"),
        foreign_keys={"ma_don_hang": "don_hang", "ma_san_pham": "san_pham"},
        has_created_at=False,
    ),
    Table(
        "thanh_toan",
        "fact_thanh_toan",
        (
            _id("ma_thanh_toan"),
            _id("ma_don_hang"),
            _date("ngay_thanh_toan"),
            _money("so_tien"),
            _text("trang_thai", 50),
            _text("phuong_thuc", 50),
        ),
        primary_key=("ma_thanh_toan",),
        dedup_key=("ma_thanh_toan",),
        foreign_keys={"ma_don_hang": "don_hang"},
    ),
    Table(
        "phieu_ho_tro",
        "fact_phieu_ho_tro",
        (
            _id("ma_phieu_ho_tro"),
            _id("ma_khach_hang"),
            _text("loai_van_de", 100),
            _text("mo_ta"),
            _timestamp("ngay_tao"),
            _text("trang_thai", 50),
            _text("do_uu_tien", 20),
        ),
        primary_key=("ma_phieu_ho_tro",),
        dedup_key=("ma_phieu_ho_tro",),
        foreign_keys={"ma_khach_hang": "khach_hang"},
        sources=(CSV,),
    ),
    Table(
        "danh_gia",
        "fact_danh_gia",
        (
            _id("ma_danh_gia"),
            _id("ma_khach_hang"),
            _int("diem_danh_gia", minimum=MIN_RATING, maximum=MAX_RATING),
            _text("nhan_xet"),
            _date("ngay_danh_gia"),
        ),
        primary_key=("ma_danh_gia",),
        dedup_key=("ma_danh_gia",),
        foreign_keys={"ma_khach_hang": "khach_hang"},
        sources=(CSV,),
    ),
    Table(
        "phieu_xu_ly",
        "fact_phieu_xu_ly",
        (
            _id("ma_phieu_xu_ly"),
            _id("ma_phieu_ho_tro"),
            _id("ma_nhan_vien"),
            _timestamp("ngay_xu_ly"),
            _text("hanh_dong", 100),
            _text("ket_qua", 50),
            _text("ghi_chu"),
        ),
        primary_key=("ma_phieu_xu_ly",),
        dedup_key=("ma_phieu_xu_ly",),
        foreign_keys={"ma_phieu_ho_tro": "phieu_ho_tro", "ma_nhan_vien": "nhanvien_cskh"},
        sources=(CSV,),
    ),
)

# Staging ids are narrower than warehouse ids, which have grown by a source prefix.
STAGING_ID_LENGTH = 10
