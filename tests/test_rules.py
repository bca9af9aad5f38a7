"""Each rule against hand-made rows with known findings."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace import catalog as C
from millrace.operators import rules
from millrace.operators.validate import (
    ERRORS,
    FIXABLE_ERRORS,
    UNFIXABLE_ERRORS,
    validate,
    validate_chain,
    validation_summary,
)

AS_OF = "2025-11-21"
NBSP = " "


def judge(spark, field, values, dtype="string", **kw):
    """For every value: rules with codes, and whether the row is valid and fixable."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, {field} {dtype}")
    rows = validate(df, as_of=AS_OF, **kw).orderBy("i").collect()
    return [([(e.rule, e.code) for e in r[ERRORS]], r._is_valid, r._can_fix) for r in rows]


def test_name(spark):
    long_with_letter = "Nguyen Thi Thanh Huong T"
    out = judge(
        spark,
        "ho_ten",
        [None, " ", "An 1 B", "an", "nguyen thi-hoa", long_with_letter, "An B", "Tran@ Binh", "A b" + NBSP + "C",
         "Lê/Văn~ `Minh", "Nguyen " * 15, NBSP],
    )
    assert out[0] == ([("name_blank", "E002")], False, False)
    assert out[1] == out[0] and out[11] == out[0]
    assert out[2] == ([("name_digits", "E001")], False, False)
    assert out[3] == ([("name_min_words", "E001"), ("name_capitals", "E001")], False, True)
    assert out[4] == ([("name_capitals", "E001")], False, True)
    assert out[5] == ([("name_abbreviated", "E001")], False, False)
    assert out[6] == ([], True, True)
    assert out[7] == ([("name_special", "E001")], False, False)
    assert out[8] == ([("name_capitals", "E001")], False, True)  # the no-break space parts words
    assert out[9] == ([], True, True)  # hyphen, slash, tilde and backtick are allowed
    assert out[10] == ([("name_length", "E003")], False, False)


def test_special_characters_of_names(spark):
    special = "!@#$%^&*()_+=[]{};':\"\\|,.<>?"
    out = judge(spark, "ho_ten", [f"An B{ch}" for ch in special])
    assert all([r[0] for r in o[0]] == ["name_special"] for o in out)


def test_email(spark):
    out = judge(
        spark,
        "email",
        [" Foo@Bar.VN ", "a b@c.vn", "a@b", "a@@b.vn", "ngọc@x.vn", "", "@x.vn", "a@x.vn@", "a,b@x.vn", "x@x.vn\n",
         "a" * 95 + "@x.vn.com", None],
    )
    names = [[r[0] for r in o[0]] for o in out]
    assert names[0] == []
    assert names[1] == ["email_pattern", "email_space"]
    assert names[2] == ["email_pattern", "email_domain"]
    assert names[3] == ["email_pattern", "email_sides"]
    assert names[4] == ["email_pattern"]
    assert names[5] == ["email_blank"] and names[11] == ["email_blank"]
    assert names[6] == ["email_pattern", "email_sides"]
    assert names[7] == ["email_pattern", "email_sides"]
    assert names[8] == ["email_pattern", "email_chars"]
    assert names[9] == []  # trimmed first
    assert names[10] == ["email_length"]
    assert not any(o[2] for o in out if o[0])  # a wrong mail address is never fixable


def test_phone(spark):
    out = judge(spark, "so_dien_thoai", [None, "0912345678", "+84912345678", "912345678", "0912345678\n", "", " 0912345678"])
    wrong = ([("phone_pattern", "E001")], False, True)
    assert [o == wrong for o in out] == [False, False, False, True, True, False, True]


def test_birth_date_column(spark):
    days = [None, dt.date(1990, 1, 1), dt.date(2013, 11, 21), dt.date(2012, 11, 21), dt.date(2026, 1, 1), dt.date(1899, 12, 31),
            dt.date(2025, 11, 21), dt.date(1904, 11, 21)]
    out = judge(spark, "ngay_sinh", days, "date")
    codes = [[c for _, c in o[0]] for o in out]
    assert codes == [
        ["E002"], ["E001"], ["E003", "E001"], ["E001"], ["E006", "E003", "E001"], ["E003", "E006", "E001"],
        ["E003", "E001"], ["E003", "E001"],
    ]
    assert [o[2] for o in out] == [True, True, False, True, False, False, False, False]


def test_birth_date_text(spark):
    out = judge(spark, "ngay_sinh", ["1990-01-01", "", "soon", "1990-01-01T10:00:00", "2012-02-29", "19900101"])
    assert [[r for r, _ in o[0]] for o in out] == [[], ["dob_null"], ["dob_parse"], ["dob_format"], [], ["dob_format"]]


@pytest.mark.parametrize("as_of,age", [("2025-02-28", 13), ("2025-02-27", 12), ("2024-02-28", 11)])
def test_age_of_leap_day(spark, as_of, age):
    df = spark.createDataFrame([(dt.date(2012, 2, 29),)], "ngay_sinh date")
    found = validate(df, as_of=as_of).select(F.transform(ERRORS, lambda e: e["rule"])).first()[0]
    assert ("dob_too_young" in found) == (age < 13)


def test_price(spark):
    out = judge(spark, "don_gia", [None, "", "12abc", "-1", "999999999", "1000000000", "abc", ".5", "-Infinity"])
    assert [[r for r, _ in o[0]] for o in out] == [
        [], ["price_number"], [], ["price_range"], [], ["price_range"], ["price_number"], [], ["price_range"],
    ]
    numbers = judge(spark, "don_gia", [None, -0.5, float("nan"), 5.0], "double")
    assert [[r for r, _ in o[0]] for o in numbers] == [[], ["price_range"], ["price_number"], []]


def statuses(spark, rows, schema, **kw):
    df = spark.createDataFrame(rows, schema)
    out = validate(df, as_of=AS_OF, **kw).collect()
    return [[(e.rule, e.suggested_value, e.suggestion, e.can_fix) for e in r[ERRORS]] for r in out]


def test_status_by_record(spark):
    rows = [("DH1", "Đã giao"), ("DH1", "đã giao"), ("DH1", "Đã giaoo"), ("DH1", "xyz"), ("DH1", " "), ("DH1", "Hủyy"),
            ("DH1", " Trả hàng "), ("DH1", "Thành công"), ("", "Thành công"), (None, "đóng")]
    out = statuses(spark, rows, "ma_don_hang string, trang_thai string")
    assert out[0] == [] and out[6] == []
    assert out[1] == [("status_case", "Đã giao", "Chuyển thành: Đã giao", True)]
    assert out[2] == [("status_unknown", "Đã giao", "Có thể là: Đã giao", True)]
    assert out[3] == [("status_unknown", None, None, False)]
    assert out[4][0][0] == "status_blank"
    assert out[5] == [("status_unknown", None, None, False)]  # three letters leave no room for a typo
    assert out[7][0][0] == "status_unknown"  # a payment status, judged by the order domain
    assert out[8] == []  # without an order id all domains count
    assert out[9] == [("status_case", "Đóng", "Chuyển thành: Đóng", True)]


def test_status_by_table(spark):
    rows = [("TT1", "DH1", "Thành công"), ("TT2", "DH2", "Đã giao")]
    schema = "ma_thanh_toan string, ma_don_hang string, trang_thai string"
    assert [bool(o) for o in statuses(spark, rows, schema)] == [True, False]
    by_table = statuses(spark, rows, schema, status_context="table", table="thanh_toan")
    assert [bool(o) for o in by_table] == [False, True]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_closest_value_against_a_model(spark):
    import random

    rng = random.Random(7)
    domain = [*C.ORDER_STATUSES, *C.PAYMENT_STATUSES, *C.TICKET_STATUSES, *C.AGENT_STATUSES]
    letters = "abcđệaáàảgiaohxử lý"
    texts = []
    for _ in range(400):
        text = list(rng.choice(domain))
        for _ in range(rng.randint(0, 5)):
            place = rng.randrange(len(text) + 1)
            kind = rng.random()
            if kind < 0.4 and text:
                text.pop(min(place, len(text) - 1))
            else:
                text.insert(place, rng.choice(letters))
        texts.append("".join(text))

    def fold(s):
        return "".join(s.lower().split())

    def model(value):
        best, found = None, None
        for candidate in domain:
            d = levenshtein(fold(value), fold(candidate))
            if d <= len(fold(candidate)) * 0.3 and (best is None or d < best):
                best, found = d, candidate
        return found

    df = spark.createDataFrame([(t, fold(t)) for t in texts], "t string, folded string")
    got = {r.t: r.m for r in df.select("t", rules.closest_value(F.col("folded"), domain).alias("m")).collect()}
    assert got == {t: model(t) for t in texts}


def test_errors_split_and_summary(spark):
    rows = [("an b", "a@b.vn", "1"), ("An B", "a@b", "1"), ("An B", "a@b.vn", None)]
    df = validate(spark.createDataFrame(rows, "ho_ten string, email string, so_dien_thoai string"), as_of=AS_OF)
    r = df.collect()
    assert [len(x[FIXABLE_ERRORS]) for x in r] == [2, 1, 0]
    assert [len(x[UNFIXABLE_ERRORS]) for x in r] == [0, 2, 0]
    assert validation_summary(df).first().asDict() == {"total": 3, "valid": 1, "invalid": 2, "fixable": 1, "unfixable": 1}
    assert r[0]._fields_validated == ["ho_ten", "email", "so_dien_thoai"]


def test_field_list_and_unknown_fields(spark):
    df = spark.createDataFrame([("an", "x")], "ho_ten string, email string")
    only = validate(df, fields=["email", "no_rule"], as_of=AS_OF).first()
    assert {e.field for e in only[ERRORS]} == {"email"}


def test_chain(spark):
    rows = [("912345678", "an b", "a@b"), ("0912345678", None, "a@b"), ("0912345678", "An B", "a@b.vn")]
    df = spark.createDataFrame(rows, "so_dien_thoai string, ho_ten string, email string")
    out = validate_chain(df, ["so_dien_thoai", "none", "ho_ten", "email", "ho_ten"], as_of=AS_OF).collect()
    assert [r._stopped_at for r in out] == ["email", "ho_ten", None]
    assert [r._chain_valid for r in out] == [False, False, True]
    assert [[e.rule for e in r._chain_errors] for r in out] == [
        ["phone_pattern", "name_capitals", "email_pattern", "email_domain"], ["name_blank"], [],
    ]


def test_registry(spark):
    registry = rules.default_rules()
    assert set(registry.fields()) == {"don_gia", "email", "ho_ten", "ngay_sinh", "so_dien_thoai", "trang_thai"}
    registry.remove("email")
    registry.add("ho_ten", lambda value, context: [rules.Finding("never", "E001", F.lit(False), value, message="no")])
    df = spark.createDataFrame([("1", "x")], "ho_ten string, email string")
    assert validate(df, registry, as_of=AS_OF).first()._is_valid


def test_declared_rules(spark):
    df = spark.createDataFrame([("KH1", "Nam", 0), ("KH0001", "?", 3)], "ma_khach_hang string, gioi_tinh string, so_luong int")
    out = validate(df, rules.declared_rules(), as_of=AS_OF).collect()
    assert [[e.rule for e in r[ERRORS]] for r in out] == [["ma_khach_hang_pattern", "so_luong_range"], ["gioi_tinh_domain"]]


def test_a_condition_of_validate_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(1, "An Binh"), (2, None)], "_seq bigint, ho_ten string").write.parquet(path)
    checked = validate(spark.read.parquet(path), where="_seq = 2")
    assert "EqualTo(_seq,2)" in checked._jdf.queryExecution().executedPlan().toString()
    assert [r._seq for r in checked.collect()] == [2]
