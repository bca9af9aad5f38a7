"""SQL for DuckDB that must give the same rows as the registered queries.

Written on its own, in SQL terms; it shares only the texts that derive the flawed inputs.
"""

from __future__ import annotations

from verification import inputs as I

DAY = f"DATE '{I.AS_OF}'"
WS = r"\s"

ORDER_DOMAIN = ["Chờ xử lý", "Đang chuẩn bị", "Đang giao", "Đã giao", "Hủy", "Trả hàng", "Đang xử lý"]
PAYMENT_DOMAIN = ["Chưa thanh toán", "Đã thanh toán", "Hoàn tiền", "Thất bại", "Thành công", "Đang xử lý"]
TICKET_DOMAIN = ["Mới", "Đang xử lý", "Chờ phản hồi", "Đã giải quyết", "Đóng", "Hủy"]
AGENT_DOMAIN = ["Đang làm", "Nghỉ phép", "Đã nghỉ"]
ALL_DOMAINS = ORDER_DOMAIN + PAYMENT_DOMAIN + TICKET_DOMAIN + AGENT_DOMAIN


def increments() -> str:
    """Two loads of five tables, one after the other; the first offers two rows of three, the second all."""
    first = "_seq % 3 <> 0"
    parts = [src("danh_muc", "san_pham", "khach_hang", "don_hang", "chi_tiet_don_hang")]
    parts.append(f"l_danh_muc AS (SELECT *, CASE WHEN {first} THEN 1 ELSE 2 END AS n_load FROM danh_muc)")
    parts.append(f"""l_san_pham AS (SELECT s.*, CASE WHEN {first.replace('_seq', 's._seq')} AND d.n_load = 1 THEN 1 ELSE 2 END AS n_load
        FROM san_pham s JOIN l_danh_muc d USING (ma_danh_muc))""")
    # Customers have two unique keys. Ids are distinct within a source, so each load and source in turn adds the first of each mail.
    parts.append("""kh AS (SELECT * FROM khach_hang WHERE ho_ten IS NOT NULL AND length(ho_ten) <= 100 AND email IS NOT NULL AND length(email) <= 100
        AND coalesce(length(so_dien_thoai) <= 20, true))""")
    accepted: list[str] = []
    for n_load, offered in ((1, first), (2, "true")):
        for source in ("postgresql", "csv"):
            taken = " ".join(f"AND NOT EXISTS (SELECT 1 FROM {a} x WHERE x.ma_khach_hang = k.ma_khach_hang OR x.email = k.email)" for a in accepted)
            name = f"kh_{n_load}_{source}"
            parts.append(f"""{name} AS (SELECT k.*, {n_load} AS n_load FROM kh k WHERE source = '{source}' AND {offered} {taken}
                QUALIFY row_number() OVER (PARTITION BY email ORDER BY _seq) = 1)""")
            accepted.append(name)
    parts.append("l_khach_hang AS (" + " UNION ALL ".join(f"SELECT * FROM {a}" for a in accepted) + ")")
    parts.append(f"""l_don_hang AS (SELECT o.*, CASE WHEN {first.replace('_seq', 'o._seq')} AND coalesce(k.n_load, 1) = 1 THEN 1 ELSE 2 END AS n_load
        FROM don_hang o LEFT JOIN l_khach_hang k USING (ma_khach_hang) WHERE o.ma_khach_hang IS NULL OR o.ma_khach_hang = '' OR k._seq IS NOT NULL)""")
    parts.append(f"""l_chi_tiet_don_hang AS (SELECT * FROM (
            SELECT c.*, CASE WHEN {first.replace('_seq', 'c._seq')} AND o.n_load = 1 AND s.n_load = 1 THEN 1 ELSE 2 END AS n_load
            FROM chi_tiet_don_hang c JOIN l_don_hang o USING (ma_don_hang) JOIN l_san_pham s USING (ma_san_pham))
        QUALIFY row_number() OVER (PARTITION BY ma_don_hang, ma_san_pham ORDER BY n_load, _seq) = 1)""")

    columns = {
        "dim_danh_muc": "ma_danh_muc ten_danh_muc",
        "dim_san_pham": "ma_san_pham ten_san_pham mo_ta ma_danh_muc don_gia ton_kho",
        "dim_khach_hang": "ma_khach_hang ho_ten email so_dien_thoai dia_chi ngay_sinh ngay_dang_ky gioi_tinh loai_khach_hang",
        "fact_don_hang": "ma_don_hang ma_khach_hang ngay_dat tong_tien trang_thai",
        "fact_chi_tiet_don_hang": "ma_don_hang ma_san_pham so_luong don_gia",
    }

    def content(name: str) -> str:
        values = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns[name].split())
        return f"SELECT '{name}' AS table_name, concat_ws('|', {values}) AS content, CAST(n_load AS INTEGER) AS n_load FROM l_{name.split('_', 1)[1]}"

    return with_(*parts) + " " + " UNION ALL ".join(content(n) for n in columns)


def src(*names: str) -> str:
    return I.ctes(*names)


def with_(*parts: str) -> str:
    return "WITH " + ", ".join(parts)


def joined(*conditions: tuple[str, str]) -> str:
    """The labels whose condition holds, in order, by comma."""
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{label}' END" for label, c in conditions) + ")"


class Findings:
    """What can be wrong with one column: (rule, code, condition, fixable condition)."""

    def __init__(self, *items: tuple[str, str, str, str]):
        self.items = items

    def any(self) -> str:
        return "(" + " OR ".join(f"coalesce({c}, false)" for _, _, c, _ in self.items) + ")"

    def blocked(self) -> str:
        return "(" + " OR ".join(f"(coalesce({c}, false) AND NOT ({f}))" for _, _, c, f in self.items) + ")"

    def verdict(self) -> str:
        return ", ".join(
            [
                joined(*[(r, c) for r, _, c, _ in self.items]) + " AS rules",
                joined(*[(code, c) for _, code, c, _ in self.items]) + " AS codes",
                "concat_ws(',', "
                + ", ".join(f"CASE WHEN {c} THEN CASE WHEN {f} THEN '1' ELSE '0' END END" for _, _, c, f in self.items)
                + ") AS fixes",
                f"NOT {self.any()} AS is_valid",
                f"NOT {self.blocked()} AS can_fix",
            ]
        )


def merged_verdict(*columns: Findings) -> str:
    everything = Findings(*[i for c in columns for i in c.items])
    text = everything.verdict().rsplit(", NOT ", 2)[0]
    fails = " OR ".join(c.any() for c in columns)
    blocked = " OR ".join(c.blocked() for c in columns)
    return f"{text}, NOT ({fails}) AS is_valid, NOT ({blocked}) AS can_fix"


def name_findings(c: str = "ho_ten") -> Findings:
    t = f"nullif(trim({c}), '')"
    words = f"string_split_regex({t}, '{WS}+')"
    return Findings(
        ("name_blank", "E002", f"{t} IS NULL", "false"),
        ("name_digits", "E001", f"regexp_matches({t}, '[0-9]')", "false"),
        ("name_special", "E001", f"len(regexp_replace({t}, '[-!@#$%^&*()_+=\\[\\]{{}};'':\"\\\\|,.<>?]', '', 'g')) < len(regexp_replace({t}, '-', '', 'g'))", "false"),
        ("name_length", "E003", f"length({t}) > 100", "false"),
        ("name_min_words", "E001", f"len({words}) < 2", "true"),
        ("name_abbreviated", "E001", f"length({t}) > 20 AND len(list_filter({words}, lambda w: length(w) = 1)) > 0", "false"),
        ("name_capitals", "E001", f"len(list_filter({words}, lambda w: substr(w, 1, 1) <> upper(substr(w, 1, 1)))) > 0", "true"),
    )


def email_findings(c: str = "email") -> Findings:
    t = f"nullif(lower(trim({c})), '')"
    parts = f"string_split({t}, '@')"
    at = f"contains({t}, '@')"
    return Findings(
        ("email_blank", "E002", f"{t} IS NULL", "false"),
        ("email_pattern", "E001", rf"NOT regexp_full_match({t}, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{{2,}}')", "false"),
        ("email_length", "E003", f"length({t}) > 100", "false"),
        ("email_space", "E001", f"regexp_matches({t}, '{WS}')", "true"),
        ("email_sides", "E001", f"{at} AND (len({parts}) <> 2 OR {parts}[1] = '' OR {parts}[2] = '')", "false"),
        ("email_domain", "E001", f"{at} AND {parts}[2] <> '' AND NOT contains({parts}[2], '.')", "false"),
        ("email_chars", "E001", f"""regexp_matches({t}, '[<>()\\[\\]\\\\,;:"]')""", "false"),
    )


def phone_findings(c: str = "so_dien_thoai") -> Findings:
    return Findings(
        ("phone_pattern", "E001", rf"{c} <> '' AND NOT regexp_full_match({c}, '(0|\+84)[0-9]{{9,10}}')", "true")
    )


def age(day: str) -> str:
    return f"date_sub('year', {day}, {DAY})"


def dob_findings(day: str, missing: str, unreadable: str, nonstandard: str) -> Findings:
    return Findings(
        ("dob_null", "E002", missing, "true"),
        ("dob_parse", "E006", unreadable, "true"),
        ("dob_future", "E006", f"{day} > {DAY}", "false"),
        ("dob_too_young", "E003", f"{age(day)} < 13", "false"),
        ("dob_too_old", "E003", f"{age(day)} > 120", "false"),
        ("dob_year", "E006", f"year({day}) < 1900", "false"),
        ("dob_format", "E001", nonstandard, "true"),
    )


def dated_dob() -> Findings:
    return dob_findings("ngay_sinh", "ngay_sinh IS NULL", "false", "ngay_sinh IS NOT NULL")


def price_findings(number: str, missing: str = "false") -> Findings:
    return Findings(
        ("price_number", "E001", missing, "false"),
        ("price_range", "E003", f"({number} < 0 OR {number} > 999999999)", "false"),
    )


# Edit distance counts bytes here, so every letter becomes one byte first.
_LETTERS = "".join(sorted({ch for v in ALL_DOMAINS for ch in v.lower() if ord(ch) > 127}))
_BYTES = "".join(chr(c) for c in [*range(65, 91), *range(48, 58), *b"!#$%&()*+,-./:;<=>?"])[: len(_LETTERS)]


def folded(c: str) -> str:
    return f"translate(regexp_replace(lower(trim({c})), '{WS}+', '', 'g'), '{_LETTERS}', '{_BYTES}')"


def domain_rows() -> str:
    """Domain values by kind and place."""
    rows = []
    kinds = {"don_hang": ORDER_DOMAIN, "thanh_toan": PAYMENT_DOMAIN, "phieu_ho_tro": TICKET_DOMAIN, "nhanvien_cskh": AGENT_DOMAIN, "all": ALL_DOMAINS}
    for kind, values in kinds.items():
        rows += [f"('{kind}', {i}, '{v}')" for i, v in enumerate(values)]
    return f"domains(kind, place, v) AS (VALUES {', '.join(rows)})"


def status_lookup(rows: str) -> str:
    """For ``(id, kind, trang_thai)`` rows: the listed spelling and the closest value of the domain."""
    return f"""{domain_rows()},
    status_known AS (
      SELECT s.id, min_by(d.v, d.place) AS known FROM ({rows}) s JOIN domains d
        ON d.kind = s.kind AND lower(d.v) = lower(trim(s.trang_thai)) GROUP BY s.id),
    status_near AS (
      SELECT id, min_by(v, (distance, place)) AS near FROM (
        SELECT s.id, d.v, d.place, levenshtein({folded('s.trang_thai')}, {folded('d.v')}) AS distance,
               length({folded('d.v')}) AS size
        FROM ({rows}) s JOIN domains d ON d.kind = s.kind WHERE trim(s.trang_thai) <> '')
      WHERE distance <= size * 0.3 GROUP BY id),
    judged AS (
      SELECT s.id, s.kind, s.trang_thai, nullif(trim(s.trang_thai), '') AS t, k.known,
             CASE WHEN k.known IS NULL THEN n.near END AS near
      FROM ({rows}) s LEFT JOIN status_known k ON k.id = s.id LEFT JOIN status_near n ON n.id = s.id)"""


STATUS = Findings(
    ("status_blank", "E002", "t IS NULL", "false"),
    ("status_unknown", "E007", "t IS NOT NULL AND known IS NULL", "near IS NOT NULL"),
    ("status_case", "E001", "known <> t", "true"),
)

_ABBREVIATIONS = "map {'v': 'Văn', 't': 'Thị', 'h': 'Hữu', 'd': 'Đức', 'k': 'Kim', 'm': 'Minh', 'n': 'Ngọc'}"


def tidy_name(c: str) -> str:
    text = f"trim(regexp_replace({c}, '{WS}+', ' ', 'g'))"
    word = (
        f"coalesce(CASE WHEN i > 1 AND length(w) = 1 THEN {_ABBREVIATIONS}[lower(w)] END,"
        " upper(substr(w, 1, 1)) || lower(substr(w, 2)))"
    )
    name = f"array_to_string(list_transform(string_split({text}, ' '), lambda w, i: {word}), ' ')"
    for wrong, right in (("Ã¡", "á"), ("Ã ", "à"), ("áº¡", "ạ"), ("áº£", "ả"), ("Ã£", "ã"), ("Ä", "đ")):
        name = f"replace({name}, '{wrong}', '{right}')"
    return f"CASE WHEN {c} <> '' THEN {name} END"


def tidy_email(c: str) -> str:
    email = f"lower(regexp_replace({c}, '{WS}+', '', 'g'))"
    for wrong, right in (
        ("gmial.com", "gmail.com"), ("gmai.com", "gmail.com"), ("yahooo.com", "yahoo.com"),
        ("yaho.com", "yahoo.com"), ("hotmial.com", "hotmail.com"), ("outloook.com", "outlook.com"),
    ):
        email = f"regexp_replace({email}, '{wrong.replace('.', chr(92) + '.')}', '{right}')"
    return f"CASE WHEN {c} <> '' THEN {email} END"


def tidy_type(c: str) -> str:
    return (
        f"CASE lower(trim({c})) WHEN 'vip' THEN 'VIP' WHEN 'doanh nghiệp' THEN 'Doanh nghiệp' "
        f"WHEN 'mới' THEN 'Mới' ELSE 'Thường' END"
    )


def parsed_day(c: str) -> str:
    def at(shape: str, layout: str) -> str:
        return f"CASE WHEN regexp_full_match({c}, '{shape}') THEN CAST(try_strptime({c}, '{layout}') AS DATE) END"

    d2, d4 = "[0-9]{2}", "[0-9]{4}"
    return (
        f"coalesce({at(f'{d4}-{d2}-{d2}', '%Y-%m-%d')}, {at(f'{d2}/{d2}/{d4}', '%d/%m/%Y')}, "
        f"{at(f'{d2}/{d2}/{d4}', '%m/%d/%Y')}, {at(f'{d2}-{d2}-{d4}', '%d-%m-%Y')}, {at(f'{d4}/{d2}/{d2}', '%Y/%m/%d')})"
    )


def source_prefixed(c: str, source: str = "source") -> str:
    return (
        f"CASE WHEN {c} IS NULL OR {c} = '' OR starts_with({c}, 'PG_') OR starts_with({c}, 'CSV_') THEN {c} "
        f"WHEN {source} = 'postgresql' THEN 'PG_' || {c} WHEN {source} = 'csv' THEN 'CSV_' || {c} ELSE {c} END"
    )


EMAIL_KEY = "coalesce(lower(trim(email)), 'null')"


def first_text(c: str) -> str:
    return f"coalesce(first({c} ORDER BY _seq) FILTER (WHERE {c} <> ''), first({c} ORDER BY _seq)) AS {c}"


def first_value(c: str) -> str:
    return f"first({c} ORDER BY _seq) FILTER (WHERE {c} IS NOT NULL) AS {c}"


CUSTOMER_TEXTS = ["source", "ma_khach_hang", "ho_ten", "email", "so_dien_thoai", "dia_chi", "gioi_tinh", "loai_khach_hang"]


def merged_customers(rows: str = "khach_hang", key: str = EMAIL_KEY) -> str:
    texts = ", ".join(first_text(c) for c in CUSTOMER_TEXTS)
    return f"""SELECT min(_seq) AS _seq, {texts}, {first_value('ngay_sinh')}, {first_value('ngay_dang_ky')},
        count(*) AS group_size,
        min(_seq) FILTER (WHERE source = 'postgresql') AS first_pg, min(_seq) FILTER (WHERE source = 'csv') AS first_csv
      FROM {rows} GROUP BY {key}"""


SOURCES = """CASE WHEN group_size = 1 THEN NULL WHEN first_pg IS NULL THEN 'csv' WHEN first_csv IS NULL THEN 'postgresql'
    WHEN first_pg < first_csv THEN 'postgresql,csv' ELSE 'csv,postgresql' END"""

MERGE_COLUMNS = "_seq, source, ma_khach_hang, ho_ten, email, so_dien_thoai, dia_chi, ngay_sinh, ngay_dang_ky, gioi_tinh, loai_khach_hang"

# Repaired customers: text of the birth date, tidied names where their rule can be fixed.
_NAME = name_findings()
_LONELY = "(contains(trim(ho_ten), ' ') = false)"
REPAIRED_NAME = (
    f"CASE WHEN {_NAME.any()} AND NOT {_NAME.blocked()} THEN CASE WHEN {_LONELY} THEN 'Không Rõ ' || {tidy_name('ho_ten')} "
    f"ELSE {tidy_name('ho_ten')} END ELSE ho_ten END"
)
_DOB = dated_dob()
DOB_FIXABLE = f"(NOT {_DOB.blocked()})"
REPAIRED_DOB = f"CASE WHEN {DOB_FIXABLE} THEN coalesce(strftime(ngay_sinh, '%Y-%m-%d'), '2004-05-29') ELSE strftime(ngay_sinh, '%Y-%m-%d') END"


def repaired_customers(rows: str) -> str:
    return f"""SELECT _seq, ma_khach_hang, ho_ten AS old_name, {REPAIRED_NAME} AS ho_ten, email, so_dien_thoai,
        ngay_sinh AS old_day, CAST({REPAIRED_DOB} AS DATE) AS ngay_sinh, {DOB_FIXABLE} AS day_is_text,
        loai_khach_hang AS old_type, {tidy_type('loai_khach_hang')} AS loai_khach_hang, dia_chi, ngay_dang_ky, gioi_tinh, source
      FROM {rows}"""


AGAIN_DOB = dob_findings("ngay_sinh", "ngay_sinh IS NULL", "false", "ngay_sinh IS NOT NULL AND NOT day_is_text")


def customer_checks(dob: Findings) -> list[Findings]:
    return [name_findings(), email_findings(), phone_findings(), dob]


def valid(*columns: Findings) -> str:
    return "NOT (" + " OR ".join(c.any() for c in columns) + ")"


def order_status_rows(rows: str = "don_hang", kind: str = "'don_hang'") -> str:
    return f"SELECT _seq AS id, {kind} AS kind, trang_thai FROM {rows}"


def repaired_status() -> str:
    return (
        f"CASE WHEN {STATUS.any()} AND NOT {STATUS.blocked()} THEN coalesce(CASE WHEN known IS NULL THEN near ELSE known END, trang_thai) "
        "ELSE trang_thai END"
    )


STATUS_ROWS = """SELECT _seq, 'don_hang' AS kind, 'don_hang' AS domain, trang_thai FROM don_hang
  UNION ALL SELECT _seq, 'thanh_toan', 'don_hang', trang_thai FROM thanh_toan
  UNION ALL SELECT _seq, 'phieu_ho_tro', 'phieu_ho_tro', trang_thai FROM phieu_ho_tro
  UNION ALL SELECT _seq, 'nhanvien_cskh', 'nhanvien_cskh', trang_thai FROM nhanvien_cskh
  UNION ALL SELECT _seq, 'none', 'all', trang_thai FROM phieu_ho_tro"""


def all_statuses() -> str:
    sources = src("don_hang", "thanh_toan", "phieu_ho_tro", "nhanvien_cskh")
    # Texts repeat, so they are judged once per domain.
    texts = f"texts AS (SELECT DISTINCT domain AS kind, trang_thai, domain || ':' || coalesce(trang_thai, '?') AS id FROM ({STATUS_ROWS}))"
    return f"""WITH {sources}, {texts}, {status_lookup('SELECT id, kind, trang_thai FROM texts')},
    rows AS (SELECT s._seq, s.kind, s.trang_thai, j.t, j.known, j.near FROM ({STATUS_ROWS}) s
      JOIN judged j ON j.id = s.domain || ':' || coalesce(s.trang_thai, '?'))"""


def judged_by(domain: str, rows: str, name: str) -> str:
    """CTEs that judge the statuses of one table by one domain; texts are judged once."""
    texts = f"SELECT DISTINCT '{domain}' AS kind, trang_thai, coalesce(trang_thai, '?') AS id FROM {rows}"
    return f"""{status_lookup(texts)},
    {name} AS (SELECT r.*, j.t, j.known, j.near FROM {rows} r JOIN judged j ON j.id = coalesce(r.trang_thai, '?'))"""


def counts(valid_condition: str, can_fix: str) -> str:
    return (
        f"count(*) AS total, count(*) FILTER (WHERE {valid_condition}) AS valid, count(*) FILTER (WHERE NOT ({valid_condition})) AS invalid, "
        f"count(*) FILTER (WHERE NOT ({valid_condition}) AND {can_fix}) AS fixable, "
        f"count(*) FILTER (WHERE NOT ({valid_condition}) AND NOT ({can_fix})) AS unfixable"
    )


def _customer_valid(dob: Findings) -> tuple[str, str]:
    checks = customer_checks(dob)
    return valid(*checks), "NOT (" + " OR ".join(c.blocked() for c in checks) + ")"


# ---- the star -----------------------------------------------------------------------------------


def _fixed(c: str, domain: list[str]) -> str:
    """Whether a status ends up valid: it is listed in some case, or close to a listed one."""
    listed = ", ".join(f"'{v.lower()}'" for v in dict.fromkeys(domain))
    near = " OR ".join(
        f"levenshtein({folded(c)}, {folded(chr(39) + v + chr(39))}) <= {len(v.replace(' ', '')) * 0.3}" for v in dict.fromkeys(domain)
    )
    return f"({c} IS NOT NULL AND trim({c}) <> '' AND (lower(trim({c})) IN ({listed}) OR {near}))"


def star_ctes() -> str:
    """Loaded rows of every table under ``dw_<table>``, rows that failed a reference under ``skip_<table>``."""
    pre = source_prefixed
    valid_customer, _ = _customer_valid(AGAIN_DOB)

    def unmatched(parent: str, column: str, key: str) -> str:
        return f"({column} IS NOT NULL AND {column} <> '' AND NOT EXISTS (SELECT 1 FROM dw_{parent} p WHERE p.{key} = c.{column}))"

    def child(name: str, clean: str, *refs: str) -> str:
        bad = " OR ".join(refs)
        return f"skip_{name} AS (SELECT * FROM ({clean}) c WHERE {bad}), dw_{name} AS (SELECT * FROM ({clean}) c WHERE NOT ({bad}))"

    agent_name_fixable = f"({name_findings().any()} AND NOT {name_findings().blocked()})"
    parts = [
        src(*I.STAR),
        # customers: the merged row keeps the id of its first source
        f"mc AS ({merged_customers('khach_hang')})",
        f"rc AS ({repaired_customers('mc')})",
        f"dw_khach_hang AS (SELECT {pre('ma_khach_hang')} AS ma_khach_hang FROM rc WHERE {valid_customer} "
        f"QUALIFY row_number() OVER (PARTITION BY {pre('ma_khach_hang')} ORDER BY _seq) = 1)",
        "dw_danh_muc AS (SELECT 'PG_' || ma_danh_muc AS ma_danh_muc FROM danh_muc)",
        child(
            "san_pham",
            "SELECT 'PG_' || ma_san_pham AS ma_san_pham, 'PG_' || ma_danh_muc AS ma_danh_muc FROM san_pham WHERE don_gia IS NULL OR don_gia BETWEEN 0 AND 999999999",
            unmatched("danh_muc", "ma_danh_muc", "ma_danh_muc"),
        ),
        f"""dw_nhanvien_cskh AS (SELECT 'CSV_' || ma_nhan_vien AS ma_nhan_vien FROM (
            SELECT *, CASE WHEN {agent_name_fixable} THEN {tidy_name('ho_ten')} ELSE ho_ten END AS coalesced FROM nhanvien_cskh)
            WHERE NOT {name_findings('coalesced').any()} AND NOT {email_findings().any()} AND {_fixed('trang_thai', AGENT_DOMAIN)}
            QUALIFY row_number() OVER (PARTITION BY email ORDER BY _seq) = 1)""",
        child(
            "don_hang",
            f"SELECT 'PG_' || ma_don_hang AS ma_don_hang, {pre('ma_khach_hang')} AS ma_khach_hang FROM don_hang WHERE {_fixed('trang_thai', ORDER_DOMAIN)}",
            unmatched("khach_hang", "ma_khach_hang", "ma_khach_hang"),
        ),
        child(
            "chi_tiet_don_hang",
            "SELECT DISTINCT 'PG_' || ma_don_hang AS ma_don_hang, 'PG_' || ma_san_pham AS ma_san_pham FROM chi_tiet_don_hang",
            unmatched("don_hang", "ma_don_hang", "ma_don_hang"),
            unmatched("san_pham", "ma_san_pham", "ma_san_pham"),
        ),
        child(
            "thanh_toan",
            f"SELECT 'PG_' || ma_thanh_toan AS ma_thanh_toan, 'PG_' || ma_don_hang AS ma_don_hang FROM thanh_toan WHERE {_fixed('trang_thai', ORDER_DOMAIN)}",
            unmatched("don_hang", "ma_don_hang", "ma_don_hang"),
        ),
        child(
            "phieu_ho_tro",
            f"SELECT 'CSV_' || ma_phieu_ho_tro AS ma_phieu_ho_tro, 'CSV_' || ma_khach_hang AS ma_khach_hang FROM phieu_ho_tro WHERE {_fixed('trang_thai', TICKET_DOMAIN)}",
            unmatched("khach_hang", "ma_khach_hang", "ma_khach_hang"),
        ),
        child(
            "danh_gia",
            "SELECT 'CSV_' || ma_danh_gia AS ma_danh_gia, 'CSV_' || ma_khach_hang AS ma_khach_hang FROM danh_gia",
            unmatched("khach_hang", "ma_khach_hang", "ma_khach_hang"),
        ),
        child(
            "phieu_xu_ly",
            "SELECT 'CSV_' || ma_phieu_xu_ly AS ma_phieu_xu_ly, 'CSV_' || ma_phieu_ho_tro AS ma_phieu_ho_tro, 'CSV_' || ma_nhan_vien AS ma_nhan_vien FROM phieu_xu_ly",
            unmatched("phieu_ho_tro", "ma_phieu_ho_tro", "ma_phieu_ho_tro"),
            unmatched("nhanvien_cskh", "ma_nhan_vien", "ma_nhan_vien"),
        ),
    ]
    return with_(*parts)


STAR_KEYS = {
    "khach_hang": ("dim_khach_hang", "ma_khach_hang"),
    "danh_muc": ("dim_danh_muc", "ma_danh_muc"),
    "san_pham": ("dim_san_pham", "ma_san_pham"),
    "nhanvien_cskh": ("dim_nhanvien_cskh", "ma_nhan_vien"),
    "don_hang": ("fact_don_hang", "ma_don_hang"),
    "chi_tiet_don_hang": ("fact_chi_tiet_don_hang", "ma_don_hang || '|' || ma_san_pham"),
    "thanh_toan": ("fact_thanh_toan", "ma_thanh_toan"),
    "phieu_ho_tro": ("fact_phieu_ho_tro", "ma_phieu_ho_tro"),
    "danh_gia": ("fact_danh_gia", "ma_danh_gia"),
    "phieu_xu_ly": ("fact_phieu_xu_ly", "ma_phieu_xu_ly"),
}
WITH_REFERENCES = [n for n in STAR_KEYS if n not in ("khach_hang", "danh_muc", "nhanvien_cskh")]


def star_counts() -> str:
    rows = []
    for name, (warehouse, _) in STAR_KEYS.items():
        kind = "dimension" if warehouse.startswith("dim_") else "fact"
        skipped = f"(SELECT count(*) FROM skip_{name})" if name in WITH_REFERENCES else "0"
        rows.append(f"SELECT '{kind}' AS kind, '{warehouse}' AS table_name, (SELECT count(*) FROM dw_{name}) AS loaded, {skipped} AS skipped")
    return " UNION ALL ".join(rows)


# ---- the registered texts -------------------------------------------------------------------------


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    customers = src("khach_hang")
    o = I.for_oracle

    q["scan_table"] = "SELECT * FROM nation"
    q["extract_counts"] = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in I.TABLES)
    q["source_presence"] = q["extract_counts"]
    q["scan_filter"] = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 100000"
    q["scan_splits"] = "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem"
    q["scan_page"] = "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 1000 OFFSET 700"
    q["scan_page_deep"] = """SELECT l_orderkey, l_linenumber, l_extendedprice,
        row_number() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_shipdate) - 1 AS row_number FROM lineitem"""
    q["scan_page_ties"] = "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders"
    ordered = "SELECT o_orderkey, o_custkey, o_orderpriority, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) - 1 AS row_number FROM orders"
    q["scan_page_directory"] = f"""WITH o AS ({ordered}), n AS (SELECT count(*) AS n FROM orders),
        behind AS (SELECT count(*) AS n FROM orders WHERE o_orderpriority < '2-HIGH' OR (o_orderpriority = '2-HIGH' AND o_orderkey <= 700))
        SELECT 'first' AS page, o.* FROM o WHERE row_number < 700
        UNION ALL SELECT 'middle', o.* FROM o, n WHERE row_number >= n // 2 AND row_number < n // 2 + 1500
        UNION ALL SELECT 'last', o.* FROM o, n WHERE row_number >= n - 300
        UNION ALL SELECT 'behind', o.* FROM o, behind WHERE row_number >= n AND row_number < n + 500"""
    q["scan_count"] = "SELECT count(*) AS total FROM lineitem"
    q["raw_sql"] = """SELECT n_name, count(*) AS n_orders, count(DISTINCT c_custkey) AS n_customers FROM orders
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus <> 'P' GROUP BY n_name"""
    q["csv_scan"] = f"WITH {src('phieu_ho_tro')} SELECT ma_phieu_ho_tro, ma_khach_hang, loai_van_de, mo_ta, trim(trang_thai) AS trang_thai FROM phieu_ho_tro"
    q["csv_extract_counts"] = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in ("nation", "supplier", "customer"))
    q["csv_filter"] = "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'"
    q["csv_filter_counts"] = "SELECT count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS kept, count(*) AS total FROM customer"
    q["csv_typed"] = """SELECT CAST(event_id AS VARCHAR) AS event_id, event_id + 0.5e0 AS number, user_id AS whole,
        CASE WHEN event_type = 'click' THEN true WHEN event_type = 'error' THEN NULL ELSE false END AS flag, CAST(ts AS DATE) AS day FROM events"""

    ratings = src("danh_gia")
    chunked = "SELECT *, row_number() OVER (ORDER BY _seq) - 1 AS r, count(*) OVER () AS n FROM danh_gia"
    q["envelope_chunks"] = f"""WITH {ratings} SELECT CAST(r // 1000 + 1 AS BIGINT) AS batch, CAST(ceil(any_value(n) / 1000) AS BIGINT) AS total_batches,
        count(*) AS n_records, min_by(ma_danh_gia, r) AS first_id, max_by(ma_danh_gia, r) AS last_id FROM ({chunked}) GROUP BY r // 1000"""
    q["envelope_publish"] = f"""WITH {ratings} SELECT 'csv' AS source, 'danh_gia' AS table_name, CAST(r // 500 + 1 AS BIGINT) AS batch,
        count(*) AS record_count, count(*) AS n_records, true AS sound FROM ({chunked}) GROUP BY r // 500"""
    q["ingest_callback"] = f"""WITH {ratings} SELECT 'csv' AS source, 'danh_gia' AS table_name, CAST(r // 1000 + 1 AS BIGINT) AS batch,
        count(*) AS n FROM ({chunked}) GROUP BY r // 1000"""
    q["envelope_ingest"] = f"""WITH {src('danh_gia', 'don_hang')} SELECT ma_danh_gia AS id, ma_khach_hang, ngay_danh_gia AS day,
        CAST(diem_danh_gia AS VARCHAR) AS amount, source FROM danh_gia UNION ALL
        SELECT ma_don_hang, ma_khach_hang, ngay_dat, CAST(CAST(tong_tien AS BIGINT) AS VARCHAR), source FROM don_hang"""
    q["envelope_order"] = f"WITH {ratings} SELECT ma_danh_gia, row_number() OVER (ORDER BY _seq) - 1 AS row_number FROM danh_gia"
    q["ingest_once"] = f"WITH {ratings} SELECT ma_danh_gia, ma_khach_hang, diem_danh_gia, nhan_xet, ngay_danh_gia FROM danh_gia"
    q["ingest_progress"] = f"""WITH {src('danh_gia', 'don_hang')}
        SELECT 'csv' AS source, 'danh_gia' AS table_name, CAST(ceil(count(*) / 200) AS BIGINT) AS messages, count(*) AS records FROM danh_gia
        UNION ALL SELECT 'postgresql', 'don_hang', CAST(ceil(count(*) / 500) AS BIGINT), count(*) FROM don_hang"""
    q["ingest_positions"] = "SELECT 2 * count(*) AS n, 2 * count(*) AS positions FROM events"
    q["ingest_counters"] = f"""SELECT 'csv' AS source, 'danh_gia' AS table_name, CAST(ceil(count(*) / 1000) AS BIGINT) AS processed_messages,
        count(*) AS total_records, CAST(0 AS BIGINT) AS rejected_messages FROM events
        UNION ALL SELECT 'postgresql', 'don_hang', CAST(ceil(count(*) / 1000) AS BIGINT), count(*), 0 FROM orders
        UNION ALL SELECT 'unknown', 'unknown', 0, 0, count(*) FROM pages"""
    q["ingest_dead_letters"] = "SELECT url AS value, 'not an envelope' AS reason FROM pages"
    q["ingest_rejects"] = f"WITH {ratings} SELECT 'danh_gia' AS table_name, 'csv' AS source, 'diem_danh_gia' AS columns, ma_danh_gia FROM danh_gia WHERE diem_danh_gia = 3"

    products = """SELECT CASE WHEN p_partkey % 50 = 0 THEN 'SP-OVERLONG-' ELSE 'SP' END || CAST(p_partkey AS VARCHAR) AS ma_san_pham,
        p_name AS ten_san_pham, p_partkey, p_size FROM part"""
    q["staging_append"] = f"""SELECT ma_san_pham, ten_san_pham, CAST(NULL AS VARCHAR) AS mo_ta, CAST(NULL AS VARCHAR) AS ma_danh_muc,
        p_partkey % 1000 AS don_gia, CAST(p_size AS INT) AS ton_kho, 'postgresql' AS source, p_partkey AS _seq, true AS has_time
        FROM ({products}) WHERE p_partkey % 10 <> 0 AND length(ma_san_pham) <= 10"""
    q["staging_rejects"] = f"""SELECT ma_san_pham, concat_ws(',', CASE WHEN length(ma_san_pham) > 10 THEN 'ma_san_pham' END,
        CASE WHEN p_partkey % 10 = 0 THEN 'don_gia' END) AS columns FROM ({products}) WHERE p_partkey % 10 = 0 OR length(ma_san_pham) > 10"""
    fits = "length(ma_khach_hang) <= 10 AND coalesce(length(ho_ten), 0) <= 100 AND coalesce(length(email), 0) <= 100"
    q["staging_union"] = f"WITH {customers} SELECT _seq, source, ma_khach_hang, email, dia_chi, ngay_sinh FROM khach_hang WHERE {fits}"
    q["staging_stats"] = f"""WITH {src(*I.STAR)}, n AS ({' UNION ALL '.join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in I.STAR)})
        SELECT * FROM n UNION ALL SELECT 'total', CAST(sum(n) AS BIGINT) FROM n"""

    ids = o(I.IDS)
    q["id_prefix"] = f"SELECT _seq, {source_prefixed('ma_don_hang')} AS ma_don_hang, {source_prefixed('ma_khach_hang')} AS ma_khach_hang, source FROM ({ids})"
    q["id_unprefix"] = f"SELECT _seq, regexp_replace(ma_don_hang, '^(PG_|CSV_)', '') AS plain, source FROM ({ids})"
    q["id_round_trip"] = f"WITH {customers} SELECT _seq, ma_khach_hang FROM khach_hang"
    q["source_prefix"] = f"""SELECT CASE source WHEN 'postgresql' THEN 'PG_' WHEN 'csv' THEN 'CSV_' ELSE '' END AS prefix, count(*) AS n
        FROM ({ids}) GROUP BY 1"""

    q["composite_key"] = f"WITH {customers} SELECT _seq, {EMAIL_KEY} || '|' || lower(trim(ma_khach_hang)) AS key FROM khach_hang"
    q["dedup_merge"] = f"WITH {customers} SELECT {MERGE_COLUMNS}, group_size FROM ({merged_customers()})"
    q["dedup_merge_keep_nulls"] = f"""WITH {customers} SELECT _seq, email, ho_ten, group_size FROM (
        {merged_customers(key=f"CASE WHEN email IS NULL THEN 'row ' || CAST(_seq AS VARCHAR) ELSE 'mail ' || {EMAIL_KEY} END")})"""
    q["dedup_merge_numbers"] = f"""WITH {src('chi_tiet_don_hang')} SELECT min(_seq) AS _seq, ma_don_hang, ma_san_pham,
        coalesce(first(so_luong ORDER BY _seq) FILTER (WHERE so_luong <> 0), first(so_luong ORDER BY _seq) FILTER (WHERE so_luong IS NOT NULL)) AS so_luong,
        CAST(first(don_gia ORDER BY _seq) FILTER (WHERE don_gia IS NOT NULL) AS BIGINT) AS don_gia, count(*) AS group_size
        FROM chi_tiet_don_hang GROUP BY ma_don_hang, ma_san_pham"""
    q["dedup_sources"] = f"WITH {customers} SELECT _seq, {SOURCES} AS sources FROM ({merged_customers()})"
    q["dedup_sources_any"] = f"WITH {customers} SELECT {MERGE_COLUMNS}, {SOURCES} AS sources, group_size FROM ({merged_customers()})"
    q["dedup_merge_batches"] = q["dedup_sources_any"]
    keys = {"khach_hang": EMAIL_KEY, "san_pham": "ma_san_pham", "don_hang": "ma_don_hang", "chi_tiet_don_hang": "ma_don_hang || ma_san_pham"}
    per_table = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS original, count(DISTINCT {k}) AS after FROM {t}" for t, k in keys.items())
    q["dedup_report"] = f"""WITH {src(*keys)}, n AS ({per_table}) SELECT table_name, original, after, original - after AS removed FROM n
        UNION ALL SELECT 'total', CAST(sum(original) AS BIGINT), CAST(sum(after) AS BIGINT), CAST(sum(original - after) AS BIGINT) FROM n"""
    q["dedup_report_keep_nulls"] = f"""WITH {customers}, n AS (SELECT count(*) AS original,
        count(DISTINCT CASE WHEN email IS NOT NULL THEN {EMAIL_KEY} END) + count(*) FILTER (WHERE email IS NULL) AS after FROM khach_hang)
        SELECT t AS table_name, original, after, original - after AS removed FROM n, (VALUES ('khach_hang'), ('total')) v(t)"""
    numbered = f"""SELECT *, {EMAIL_KEY} AS key, row_number() OVER w AS place, first_value(_seq) OVER w AS existing_seq,
        first_value(ma_khach_hang) OVER w AS existing_id FROM khach_hang WINDOW w AS (PARTITION BY {EMAIL_KEY} ORDER BY _seq)"""
    q["dedup_first"] = f"WITH {customers} SELECT {MERGE_COLUMNS} FROM ({numbered}) WHERE place = 1"
    q["find_duplicates"] = f"""WITH {customers} SELECT key, existing_seq, existing_id, _seq AS duplicate_seq, email AS duplicate_email
        FROM ({numbered}) WHERE place > 1"""

    def analysis(t: str, key: str, columns: str) -> str:
        return f"""SELECT '{t}' AS table_name, count(*) AS total_records, count(*) FILTER (WHERE place > 1) AS duplicate_count,
            printf('%.2f%%', 100.0 * count(*) FILTER (WHERE place > 1) / count(*)) AS duplicate_percentage, '{columns}' AS deduplication_key,
            coalesce(array_to_string(list(key || '@' || CAST(_seq AS VARCHAR) ORDER BY _seq) FILTER (WHERE place > 1 AND nth <= 3), ','), '') AS samples
            FROM (SELECT *, sum(CASE WHEN place > 1 THEN 1 ELSE 0 END) OVER (ORDER BY _seq) AS nth FROM (
              SELECT _seq, {key} AS key, row_number() OVER (PARTITION BY {key} ORDER BY _seq) AS place FROM {t}))"""

    q["duplicate_analysis"] = f"WITH {src('khach_hang', 'chi_tiet_don_hang', 'danh_muc')} " + " UNION ALL ".join(
        [
            analysis("khach_hang", EMAIL_KEY, "email"),
            analysis("chi_tiet_don_hang", "lower(ma_don_hang || '|' || ma_san_pham)", "ma_don_hang,ma_san_pham"),
            analysis("danh_muc", "lower(ma_danh_muc)", "ma_danh_muc"),
        ]
    )
    q["exact_dedup"] = "SELECT DISTINCT user_id, event_type FROM events"

    def two(c: str, present: str) -> str:
        base = f"last({c} ORDER BY _seq) FILTER (WHERE side = 1)"
        fill = f"first({c} ORDER BY _seq) FILTER (WHERE side = 2 AND {present})"
        alone = f"first({c} ORDER BY _seq) FILTER (WHERE side = 2)"
        good = f"last({c} ORDER BY _seq) FILTER (WHERE side = 1) "
        absent = present.replace(c, f"({good})")
        return f"CASE WHEN count(*) FILTER (WHERE side = 1) = 0 THEN coalesce({fill}, {alone}) WHEN {absent} THEN {base} ELSE coalesce({fill}, {base}) END AS {c}"

    texts = ["ma_khach_hang", "ho_ten", "email", "so_dien_thoai", "dia_chi", "loai_khach_hang"]
    q["two_source_merge"] = f"""WITH both_sides AS (SELECT *, 1 AS side FROM ({o(I.RELATIONAL_CUSTOMERS)}) UNION ALL SELECT *, 2 FROM ({o(I.CSV_CUSTOMERS)}))
        SELECT {', '.join(two(c, f"{c} <> ''") for c in texts)}, {two('ngay_sinh', 'ngay_sinh IS NOT NULL')},
        concat_ws(',', CASE WHEN count(*) FILTER (WHERE side = 1) > 0 THEN 'ds1' END, CASE WHEN count(*) FILTER (WHERE side = 2) > 0 THEN 'ds2' END) AS sources
        FROM both_sides WHERE email IS NOT NULL GROUP BY lower(trim(email))"""

    q["validate_name"] = f"WITH {customers} SELECT _seq, {name_findings().verdict()} FROM khach_hang"
    q["validate_email"] = f"WITH {customers} SELECT _seq, {email_findings().verdict()} FROM khach_hang"
    q["validate_phone"] = f"WITH {customers} SELECT _seq, {phone_findings().verdict()} FROM khach_hang"
    q["validate_birthdate"] = f"WITH {customers} SELECT _seq, {dated_dob().verdict()} FROM khach_hang"
    iso = "CASE WHEN regexp_full_match(ngay_sinh, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN CAST(try_strptime(ngay_sinh, '%Y-%m-%d') AS DATE) END"
    q["validate_birthdate_text"] = f"""SELECT _seq, {dob_findings('day', "ngay_sinh IS NULL OR ngay_sinh = ''", "ngay_sinh <> '' AND day IS NULL", 'false').verdict()}
        FROM (SELECT *, {iso} AS day FROM ({o(I.BIRTH_TEXTS)}))"""
    q["validate_price"] = f"WITH {src('san_pham')} SELECT _seq, {price_findings('don_gia').verdict()} FROM san_pham"
    number = r"TRY_CAST(nullif(regexp_extract(trim(don_gia), '^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)', 1), '') AS DOUBLE)"
    q["validate_price_text"] = f"""SELECT _seq, {price_findings('number', 'don_gia IS NOT NULL AND number IS NULL').verdict()}
        FROM (SELECT *, {number} AS number FROM ({o(I.PRICE_TEXTS)}))"""
    suggested = """concat_ws(',', CASE WHEN t IS NULL THEN '-' END, CASE WHEN t IS NOT NULL AND known IS NULL THEN coalesce(near, '-') END,
        CASE WHEN known <> t THEN known END)"""
    q["validate_status"] = f"{all_statuses()} SELECT _seq, kind, {STATUS.verdict()}, {suggested} AS suggested FROM rows"
    q["validate_status_by_table"] = f"WITH {src('thanh_toan')}, {judged_by('thanh_toan', 'thanh_toan', 'r')} SELECT _seq, {STATUS.verdict()} FROM r"
    checks = customer_checks(dated_dob())
    q["validate_record"] = f"WITH {customers} SELECT _seq, {merged_verdict(*checks)} FROM khach_hang"

    def number_of(columns: list[Findings], when: str) -> str:
        terms = []
        for c in columns:
            gate = {"all": "true", "fixable": f"NOT {c.blocked()}", "unfixable": c.blocked()}[when]
            terms += [f"CASE WHEN coalesce({cond}, false) AND {gate} THEN 1 ELSE 0 END" for _, _, cond, _ in c.items]
        return "CAST(" + " + ".join(terms) + " AS BIGINT)"

    q["validate_split"] = f"""WITH {customers} SELECT _seq, {number_of(checks, 'all')} AS n_errors, {number_of(checks, 'fixable')} AS n_fixable,
        {number_of(checks, 'unfixable')} AS n_unfixable, 'ho_ten,email,so_dien_thoai,ngay_sinh' AS fields FROM khach_hang"""
    ok, fixable = _customer_valid(dated_dob())
    status_sources = src("khach_hang", "san_pham", "don_hang", "thanh_toan", "danh_muc")
    both = "both_rows AS (SELECT 'don_hang' AS table_name, trang_thai FROM don_hang UNION ALL SELECT 'thanh_toan', trang_thai FROM thanh_toan)"
    q["validate_summary"] = f"""WITH {status_sources}, {both}, {judged_by('don_hang', 'both_rows', 'r')}
        SELECT {counts(ok, fixable)}, 'khach_hang' AS table_name FROM khach_hang
        UNION ALL SELECT {counts(valid(price_findings('don_gia')), 'false')}, 'san_pham' FROM san_pham
        UNION ALL SELECT {counts(valid(STATUS), f'NOT {STATUS.blocked()}')}, table_name FROM r GROUP BY table_name
        UNION ALL SELECT {counts('true', 'true')}, 'danh_muc' FROM danh_muc"""
    order = [("so_dien_thoai", phone_findings()), ("ho_ten", name_findings()), ("email", email_findings()), ("ngay_sinh", dated_dob())]
    stops = "CASE " + " ".join(f"WHEN {f.blocked()} THEN '{n}'" for n, f in order) + " END"
    chain_rules, before = [], "false"
    for _, f in order:
        chain_rules += [(r, f"NOT ({before}) AND coalesce({c}, false)") for r, _, c, _ in f.items]
        before = f"{before} OR {f.blocked()}"
    q["validate_chain"] = f"WITH {customers} SELECT _seq, {valid(*[f for _, f in order])} AS is_valid, {stops} AS stopped_at, {joined(*chain_rules)} AS rules FROM khach_hang"
    declared = [
        Findings(("ma_khach_hang_pattern", "E001", r"NOT regexp_full_match(ma_khach_hang, 'KH\d{4}')", "false")),
        Findings(("email_length", "E003", "length(email) > 16", "false")),
        Findings(
            ("dia_chi_required", "E002", "dia_chi IS NULL", "false"),
            ("dia_chi_domain", "E001", "dia_chi NOT IN ('BUILDING', 'MACHINERY')", "false"),
        ),
        Findings(("gioi_tinh_domain", "E001", "gioi_tinh NOT IN ('Nam', 'Nữ', 'Khác')", "false")),
    ]
    q["validate_declared"] = f"WITH {customers} SELECT _seq, {merged_verdict(*declared)} FROM khach_hang"
    q["validate_range"] = f"WITH {src('chi_tiet_don_hang')} SELECT _seq, {Findings(('so_luong_range', 'E003', 'so_luong NOT BETWEEN 1 AND 10000', 'false')).verdict()} FROM chi_tiet_don_hang"
    q["validate_custom_rule"] = f"WITH {src('san_pham')} SELECT _seq, {Findings(('odd_stock', 'E003', 'ton_kho % 2 = 1', 'true')).verdict()} FROM san_pham"

    q["validate_python_rule"] = q["validate_custom_rule"]
    q["domain_closest"] = """WITH words AS (
            SELECT DISTINCT lower(string_split(line, ' ')[1]) AS word FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
        ), asked AS (
            SELECT DISTINCT substr(w, 1, 1) || 'q' || substr(w, 3) AS text
            FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM benchmark) WHERE length(w) > 2
        ), near AS (
            SELECT text, word, levenshtein(text, word) AS distance FROM asked
            JOIN (SELECT word FROM words WHERE regexp_matches(word, '^[a-z]+$')) ON abs(length(text) - length(word)) <= floor(length(word) * 0.3::DOUBLE)
        )
        SELECT text, (SELECT arg_min(word, (distance, word)) FROM near n WHERE n.text = a.text AND distance <= floor(length(word) * 0.3::DOUBLE)) AS closest
        FROM asked a"""
    q["repair_python"] = f"WITH {customers} SELECT _seq, reverse(lower(trim(email, ' '))) AS email FROM khach_hang"
    q["repair_name"] = f"WITH {customers} SELECT _seq, {tidy_name('ho_ten')} AS ho_ten FROM khach_hang"
    q["repair_email"] = f"WITH {customers} SELECT _seq, {tidy_email('email')} AS email FROM khach_hang"
    q["repair_type"] = f"WITH {customers} SELECT _seq, {tidy_type('loai_khach_hang')} AS loai_khach_hang FROM khach_hang"
    q["repair_dob"] = f"SELECT _seq, coalesce(strftime({parsed_day('ngay_sinh')}, '%Y-%m-%d'), '2004-05-29') AS ngay_sinh FROM ({o(I.BIRTH_TEXTS)})"
    q["repair_dob_age_aware"] = f"""SELECT _seq, CASE WHEN {age('day')} BETWEEN 13 AND 120 AND year(day) >= 1900 THEN strftime(day, '%Y-%m-%d')
        ELSE '2004-05-29' END AS ngay_sinh FROM (SELECT _seq, {parsed_day('ngay_sinh')} AS day FROM ({o(I.BIRTH_TEXTS)}))"""
    q["repair_status"] = f"{all_statuses()} SELECT _seq, kind, {repaired_status()} AS trang_thai FROM rows"
    changed = "(old_name IS DISTINCT FROM ho_ten OR day_is_text OR old_type IS DISTINCT FROM loai_khach_hang)"
    rc = f"rc AS ({repaired_customers('khach_hang')})"
    q["repair_record"] = f"""WITH {customers}, {rc} SELECT _seq, ho_ten, email, so_dien_thoai, strftime(ngay_sinh, '%Y-%m-%d') AS ngay_sinh,
        loai_khach_hang, {changed} AS changed FROM rc"""
    order_changed = f"({repaired_status()} IS DISTINCT FROM trang_thai)"
    q["repair_summary"] = f"""WITH {src('khach_hang', 'don_hang', 'san_pham')}, {rc}, {judged_by('don_hang', 'don_hang', 'r')}
        SELECT count(*) AS total, count(*) FILTER (WHERE {changed}) AS transformed, count(*) FILTER (WHERE NOT {changed}) AS skipped, 'khach_hang' AS table_name FROM rc
        UNION ALL SELECT count(*), count(*) FILTER (WHERE {order_changed}), count(*) FILTER (WHERE NOT {order_changed}), 'don_hang' FROM r
        UNION ALL SELECT count(*), 0, count(*), 'san_pham' FROM san_pham"""
    q["repair_strategy"] = f"WITH {customers} SELECT _seq, lower(trim(email)) AS email, email IS DISTINCT FROM lower(trim(email)) AS changed FROM khach_hang"
    q["repair_sequence"] = f"WITH {customers} SELECT _seq, {tidy_name('ho_ten')} AS ho_ten, {tidy_email('email')} AS email, {tidy_type('loai_khach_hang')} AS loai_khach_hang FROM khach_hang"
    q["repair_conditional"] = f"""WITH {customers} SELECT _seq, CASE WHEN email IS NULL THEN {tidy_name('ho_ten')} ELSE ho_ten END AS ho_ten,
        CASE WHEN loai_khach_hang = 'VIP' THEN {tidy_email('email')} ELSE email END AS email FROM khach_hang"""
    q["repair_whole_column"] = f"""WITH {customers} SELECT _seq, coalesce({tidy_name('ho_ten')}, ho_ten) AS ho_ten, coalesce({tidy_email('email')}, email) AS email,
        coalesce(strftime(ngay_sinh, '%Y-%m-%d'), '2004-05-29') AS ngay_sinh, {tidy_type('loai_khach_hang')} AS loai_khach_hang FROM khach_hang"""

    ok_again, _ = _customer_valid(AGAIN_DOB)
    side = "CASE WHEN {c} THEN 'clean' ELSE 'failing' END AS side"
    q["quality_split"] = f"""WITH {src('khach_hang', 'don_hang', 'thanh_toan')}, {rc}
        SELECT 'khach_hang' AS table_name, _seq, {side.format(c=ok_again)} FROM rc
        UNION ALL SELECT 'don_hang', _seq, {side.format(c=_fixed('trang_thai', ORDER_DOMAIN))} FROM don_hang
        UNION ALL SELECT 'thanh_toan', _seq, {side.format(c=_fixed('trang_thai', ORDER_DOMAIN))} FROM thanh_toan"""
    again = customer_checks(AGAIN_DOB)
    q["quarantine"] = f"""WITH {customers}, {rc} SELECT 'khach_hang' AS table_name, ma_khach_hang AS record_key, _seq, ho_ten,
        {joined(*[(r, c) for f in again for r, _, c, _ in f.items])} AS rules FROM rc WHERE NOT ({ok_again})"""
    raw_rules = joined(*[(r, c) for f in checks for r, _, c, _ in f.items])
    repaired_rules = joined(*[(r, c) for f in again for r, _, c, _ in f.items])
    failing = """SELECT record_key, string_agg(DISTINCT rule, ',' ORDER BY rule) AS rules, count(DISTINCT _seq) AS n
        FROM (SELECT record_key, _seq, unnest(string_split(rules, ',')) AS rule FROM {rows}) GROUP BY record_key"""
    q["quality_drift"] = f"""WITH {customers}, {rc},
        b AS (SELECT ma_khach_hang AS record_key, _seq, {raw_rules} AS rules FROM khach_hang WHERE source = 'postgresql' AND NOT ({ok})),
        a AS (SELECT ma_khach_hang AS record_key, _seq, {repaired_rules} AS rules FROM rc WHERE NOT ({ok_again})),
        f AS ({failing.format(rows='b')}), g AS ({failing.format(rows='a')})
        SELECT 'khach_hang' AS table_name, coalesce(f.record_key, g.record_key) AS record_key,
            CASE WHEN f.n IS NOT NULL AND g.n IS NOT NULL THEN 'still failing' WHEN f.n IS NOT NULL THEN 'cured' ELSE 'new' END AS status,
            coalesce(f.rules <> g.rules, false) AS changed, f.rules AS rules_before, g.rules AS rules_after, f.n AS rows_before, g.n AS rows_after
        FROM f FULL OUTER JOIN g ON f.record_key IS NOT DISTINCT FROM g.record_key"""
    q["transform_audit"] = f"""WITH {customers}, {rc}, days AS (SELECT *, strftime(ngay_sinh, '%Y-%m-%d') AS new_day, strftime(old_day, '%Y-%m-%d') AS old_text FROM rc)
        SELECT ma_khach_hang AS record_key, _seq, new_day AS ngay_sinh, 'ho_ten' AS field, old_name AS original, ho_ten AS transformed, 'capitalize_and_normalize' AS action
          FROM days WHERE old_name IS DISTINCT FROM ho_ten
        UNION ALL SELECT ma_khach_hang, _seq, new_day, 'loai_khach_hang', coalesce(nullif(old_type, ''), 'null'), loai_khach_hang,
          CASE WHEN old_type IS NULL OR old_type = '' THEN 'set_default_value' ELSE 'normalize' END FROM days WHERE old_type IS DISTINCT FROM loai_khach_hang
        UNION ALL SELECT ma_khach_hang, _seq, new_day, 'ngay_sinh', coalesce(old_text, 'null'), new_day,
          CASE WHEN old_text IS NULL THEN 'set_default_date' ELSE 'format_date_to_yyyy_mm_dd' END FROM days WHERE day_is_text"""

    def long(phase: str, t: str, rows: str, **metrics: str) -> str:
        return " UNION ALL ".join(
            f"SELECT '{phase}' AS phase, '{t}' AS table_name, '{m}' AS metric, CAST({e} AS BIGINT) AS value FROM {rows}" for m, e in metrics.items()
        )

    def filtered(condition: str) -> str:
        return f"count(*) FILTER (WHERE {condition})"

    def five(ok_: str, fix: str) -> dict[str, str]:
        return {
            "total": "count(*)", "valid": filtered(ok_), "invalid": filtered(f"NOT ({ok_})"),
            "fixable": filtered(f"NOT ({ok_}) AND {fix}"), "unfixable": filtered(f"NOT ({ok_}) AND NOT ({fix})"),
        }

    st_ok, st_fix = valid(STATUS), f"NOT {STATUS.blocked()}"
    order_ok = _fixed("trang_thai", ORDER_DOMAIN)
    q["run_report"] = f"""WITH {src('khach_hang', 'don_hang')}, mc AS ({merged_customers()}), rc AS ({repaired_customers('mc')}), {judged_by('don_hang', 'don_hang', 'r')} """ + " UNION ALL ".join(
        [
            long("dedup", "khach_hang", "khach_hang", original="count(*)", after=f"count(DISTINCT {EMAIL_KEY})", removed=f"count(*) - count(DISTINCT {EMAIL_KEY})"),
            long("validate", "khach_hang", "mc", **five(ok, fixable)),
            long("repair", "khach_hang", "rc", total="count(*)", transformed=filtered(changed), skipped=filtered(f"NOT {changed}")),
            long("final", "khach_hang", "rc", valid=filtered(ok_again), invalid=filtered(f"NOT ({ok_again})")),
            long("dedup", "don_hang", "don_hang", original="count(*)", after="count(DISTINCT ma_don_hang)", removed="count(*) - count(DISTINCT ma_don_hang)"),
            long("validate", "don_hang", "r", **five(st_ok, st_fix)),
            long("repair", "don_hang", "r", total="count(*)", transformed=filtered(order_changed), skipped=filtered(f"NOT {order_changed}")),
            long("final", "don_hang", "r", valid=filtered(order_ok), invalid=filtered(f"NOT {order_ok}")),
        ]
    )

    q["parent_keys"] = "SELECT 'SP' || CAST(p_partkey AS VARCHAR) AS key FROM part"
    q["fk_single"] = f"WITH {src('phieu_ho_tro', 'khach_hang')} SELECT _seq, ma_khach_hang FROM phieu_ho_tro c WHERE EXISTS (SELECT 1 FROM khach_hang k WHERE k.ma_khach_hang = c.ma_khach_hang)"
    q["fk_missing_passes"] = f"""WITH {src('don_hang')} SELECT _seq, ma_khach_hang FROM don_hang c WHERE ma_khach_hang IS NULL OR ma_khach_hang = ''
        OR EXISTS (SELECT 1 FROM supplier s WHERE 'KH' || CAST(s_suppkey AS VARCHAR) = c.ma_khach_hang)"""
    known = """EXISTS (SELECT 1 FROM san_pham p WHERE p.ma_san_pham = c.ma_san_pham AND p.don_gia > 0)
        AND EXISTS (SELECT 1 FROM don_hang d WHERE d.ma_don_hang = c.ma_don_hang AND d.trang_thai LIKE '%giao')"""
    lines = src("chi_tiet_don_hang", "san_pham", "don_hang")
    q["fk_multi"] = f"WITH {lines} SELECT _seq, ma_don_hang, ma_san_pham FROM chi_tiet_don_hang c WHERE {known}"
    q["fk_skipped"] = f"WITH {lines} SELECT ma_san_pham, count(*) AS n FROM chi_tiet_don_hang c WHERE NOT ({known}) GROUP BY ma_san_pham"
    q["insert_if_absent"] = f"""WITH {src('nhanvien_cskh')} SELECT _seq, ma_nhan_vien, nullif(email, 'no mail') AS email FROM nhanvien_cskh
        QUALIFY email = 'no mail' OR row_number() OVER (PARTITION BY email ORDER BY _seq) = 1"""
    q["insert_incremental"] = f"""WITH {src('chi_tiet_don_hang')} SELECT _seq, ma_don_hang, ma_san_pham FROM chi_tiet_don_hang c
        WHERE NOT EXISTS (SELECT 1 FROM chi_tiet_don_hang t WHERE t.so_luong IS NULL AND t.ma_don_hang = c.ma_don_hang AND t.ma_san_pham = c.ma_san_pham)
        QUALIFY row_number() OVER (PARTITION BY ma_don_hang, ma_san_pham ORDER BY _seq) = 1"""
    # Ids are distinct within a source, and all rows of the first come before those of the second.
    first_email = "QUALIFY email IS NULL OR row_number() OVER (PARTITION BY email ORDER BY _seq) = 1"
    q["insert_two_unique_keys"] = f"""WITH {customers}, first AS (SELECT * FROM khach_hang WHERE source = 'postgresql' {first_email}),
        second AS (SELECT * FROM khach_hang k WHERE source = 'csv'
            AND NOT EXISTS (SELECT 1 FROM first f WHERE f.ma_khach_hang = k.ma_khach_hang)
            AND NOT EXISTS (SELECT 1 FROM first f WHERE f.email = k.email) {first_email})
        SELECT _seq, ma_khach_hang, email, so_dien_thoai FROM first UNION ALL SELECT _seq, ma_khach_hang, email, so_dien_thoai FROM second"""
    q["star_increment"] = increments()
    q["warehouse_projection"] = f"""WITH {customers} SELECT ma_khach_hang, ho_ten, email, so_dien_thoai, dia_chi, ngay_sinh, ngay_dang_ky,
        CAST(NULL AS VARCHAR) AS gioi_tinh, 'Thường' AS loai_khach_hang, {DAY} AS created_at FROM khach_hang"""
    q["constraint_check"] = f"""WITH {customers} SELECT _seq, concat_ws(',', CASE WHEN length(ma_khach_hang) > 20 THEN 'ma_khach_hang:length' END,
        CASE WHEN ho_ten IS NULL THEN 'ho_ten:not_null' END, CASE WHEN length(ho_ten) > 100 THEN 'ho_ten:length' END,
        CASE WHEN email IS NULL THEN 'email:not_null' END) AS violations FROM khach_hang"""
    q["constraint_quarantine"] = f"WITH {ratings} SELECT _seq, CAST(diem_danh_gia + 1 AS INT) AS diem_danh_gia FROM danh_gia WHERE diem_danh_gia <= 4"

    star = star_ctes()
    q["star_load"] = f"{star} " + " UNION ALL ".join(f"SELECT '{w}' AS table_name, {k} AS key FROM dw_{n}" for n, (w, k) in STAR_KEYS.items())
    q["star_load_stats"] = f"""{star}, n AS ({star_counts()}) SELECT kind, table_name, CAST(loaded AS BIGINT) AS loaded, CAST(skipped AS BIGINT) AS skipped FROM n
        UNION ALL SELECT 'total', 'total', CAST(sum(loaded) AS BIGINT), CAST(sum(skipped) AS BIGINT) FROM n"""
    q["warehouse_stats"] = f"{star} " + " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM dw_{n}" for n in STAR_KEYS)

    def repeats(t: str, w: str, columns: str, label: str) -> str:
        present = " AND ".join(f"{c} IS NOT NULL" for c in columns.split(","))
        return f"""SELECT '{w}' AS table_name, 'repeated_key' AS check_name, '{label}' AS columns,
            CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n FROM (SELECT count(*) AS n FROM {t} WHERE {present} GROUP BY {columns})"""

    def empties(t: str, w: str, columns: str, label: str) -> str:
        missing = " OR ".join(f"{c} IS NULL" for c in columns.split(","))
        return f"SELECT '{w}', 'missing_key', '{label}', count(*) FILTER (WHERE {missing}) FROM {t}"

    def orphans(t: str, w: str, column: str, parent: str) -> str:
        return f"""SELECT '{w}', 'orphan', '{column}', count(*) FROM {t} c WHERE {column} IS NOT NULL AND {column} <> ''
            AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{column} = c.{column})"""

    q["integrity_audit"] = f"WITH {src('khach_hang', 'san_pham', 'don_hang', 'chi_tiet_don_hang', 'danh_muc')} " + " UNION ALL ".join(
        [
            repeats("khach_hang", "dim_khach_hang", "ma_khach_hang", "ma_khach_hang"),
            repeats("khach_hang", "dim_khach_hang", "email", "email"),
            empties("khach_hang", "dim_khach_hang", "ma_khach_hang", "ma_khach_hang"),
            repeats("san_pham", "dim_san_pham", "ma_san_pham", "ma_san_pham"),
            empties("san_pham", "dim_san_pham", "ma_san_pham", "ma_san_pham"),
            orphans("san_pham", "dim_san_pham", "ma_danh_muc", "danh_muc"),
            repeats("don_hang", "fact_don_hang", "ma_don_hang", "ma_don_hang"),
            empties("don_hang", "fact_don_hang", "ma_don_hang", "ma_don_hang"),
            orphans("don_hang", "fact_don_hang", "ma_khach_hang", "khach_hang"),
            repeats("chi_tiet_don_hang", "fact_chi_tiet_don_hang", "ma_don_hang, ma_san_pham", "ma_don_hang+ma_san_pham"),
            empties("chi_tiet_don_hang", "fact_chi_tiet_don_hang", "ma_don_hang,ma_san_pham", "ma_don_hang+ma_san_pham"),
            orphans("chi_tiet_don_hang", "fact_chi_tiet_don_hang", "ma_don_hang", "don_hang"),
            orphans("chi_tiet_don_hang", "fact_chi_tiet_don_hang", "ma_san_pham", "san_pham"),
            repeats("danh_muc", "dim_danh_muc", "ma_danh_muc", "ma_danh_muc"),
            empties("danh_muc", "dim_danh_muc", "ma_danh_muc", "ma_danh_muc"),
        ]
    )
    q["clean_orders"] = f"""WITH {src('khach_hang', 'don_hang')}, mc AS ({merged_customers()}), rc AS ({repaired_customers('mc')}),
        good AS (SELECT DISTINCT {source_prefixed('ma_khach_hang')} AS k FROM rc WHERE {ok_again}),
        {judged_by('don_hang', 'don_hang', 'r')}
        SELECT 'PG_' || ma_don_hang AS ma_don_hang, {source_prefixed('ma_khach_hang')} AS ma_khach_hang, ngay_dat, CAST(tong_tien AS BIGINT) AS tong_tien,
          {repaired_status()} AS trang_thai
        FROM r WHERE {order_ok} AND (ma_khach_hang IS NULL OR ma_khach_hang = '' OR EXISTS (SELECT 1 FROM good WHERE k = {source_prefixed('ma_khach_hang')}))"""
    return q
