from pyspark.sql import functions as F

from casebook.functions import names, text


def one(spark, expression, **values):
    row = spark.createDataFrame([tuple(values.values()) or (1,)], list(values) or ["x"])
    return row.select(expression.alias("v")).first()["v"]


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")
    return [r["out"] for r in df.select("n", build(F.col("v")).alias("out")).orderBy("n").collect()]


def test_folder_parts(spark):
    rows = [
        ("25.000.036.001.015_012345678901_Nguyen_Van_A",),
        ("a_b.c.d.e.f.g_1_x",),
        ("Folder sai",),
        ("1.2.3.4.5_6_",),
        ("1.2.3.4.5_6_ _Le _",),
        ("1.2..4.5_6_x",),
    ]
    df = spark.createDataFrame(rows, "folder_name string")
    got = {r["folder_name"]: r for r in names.with_folder_parts(df).collect()}
    first = got[rows[0][0]]
    assert (first["m1"], first["m5"], first["citizen_id"]) == ("25", "015", "012345678901")
    assert first["person_name_display"] == "Nguyen Van A" and first["unit_code"] == "25"
    assert got["a_b.c.d.e.f.g_1_x"]["m5"] == "f.g"
    assert not got["Folder sai"]["folder_valid"] and got["Folder sai"]["m1"] is None
    assert not got["1.2.3.4.5_6_"]["folder_valid"]
    assert not got["1.2..4.5_6_x"]["folder_valid"]
    assert got[rows[4][0]]["person_name_display"] == "Le"


def test_file_parts(spark):
    expected = {
        "01.Ly_lich.pdf": ("01", None, "Ly_lich"),
        "01.Ly_lich.12.PDF": ("01", 12, "Ly_lich"),
        "05.5.pdf": ("05", None, "5"),
        "05..3.pdf": ("05", 3, None),
        "05..pdf": ("05", None, None),
        "05.a..pdf": ("05", None, None),
        "05.a.b.7.pdf": ("05", 7, "a.b"),
        "999.tai_lieu.pdf": ("999", None, "tai_lieu"),
        "5.a.pdf": (None, None, None),
        "1234.a.pdf": (None, None, None),
        "²5.a.pdf": (None, None, None),
        "not-a-document.pdf": (None, None, None),
        "01.a.txt": (None, None, None),
        ".pdf": (None, None, None),
        "01.pdf": (None, None, None),
    }
    df = spark.createDataFrame([(n,) for n in expected], "filename string")
    rows = names.with_file_parts(df).collect()
    assert {r["filename"]: (r["file_code"], r["file_sequence"], r["file_slug"]) for r in rows} == expected


def test_canonical_filename(spark):
    base = F.lit("05.Quyet_dinh_ket_nap_dang_vien")
    plain = names.canonical_filename(base, F.lit(None).cast("bigint"))
    assert one(spark, plain) == "05.Quyet_dinh_ket_nap_dang_vien.pdf"
    assert one(spark, names.canonical_filename(base, F.lit(3))) == "05.Quyet_dinh_ket_nap_dang_vien.3.pdf"
    df = spark.createDataFrame([(0,)], "s bigint")
    try:
        df.select(names.canonical_filename(base, F.col("s"))).collect()
        raise AssertionError("sequence 0 must fail")
    except Exception as e:
        assert "sequence must be >= 1" in str(e)


def test_paths(spark):
    inside = ["a/b.pdf", "a/../b", "a/./b"]
    outside = ["../a", "a/../../b", "/etc/x", "a/../../a/b"]
    assert column(spark, inside, names.stays_inside) == [True] * 3
    assert column(spark, outside, names.stays_inside) == [False] * 4
    ignored = column(
        spark,
        [".x/a.pdf", "a/~$z.pdf", "a/Thumbs.db", "_x.pdf", "a/b.pdf", "a/Thumbs.dbx"],
        lambda c: names.is_ignored(c, ("Thumbs.db", ".DS_Store", "~$*")),
    )
    assert ignored == [True, True, True, False, False, False]


def test_labels(spark):
    given = ["CO_TAI_LIEU", " OK ", "ERROR", "REVIEW_PENDING", "UNKNOWN_FUTURE_CODE", None, "", "TRUE", "free text", "ABC"]
    shown = column(spark, given, text.ui_label)
    assert shown == [
        "Có tài liệu", "Hợp lệ", "Lỗi phân tích", "Chờ rà soát", "Chưa xác định", "Chưa xác định", "", "Có",
        "free text", "ABC",
    ]
    assert column(spark, [None, "", "X_Y"], lambda c: text.ui_label(c, "?")) == ["?", "?", "?"]


def test_dates(spark):
    given = [
        "2026-08-28T15:39:50.123456+00:00", "2026-08-28T15:39:50", "2026-08-28T15:39:50+07:00",
        "2026-08-28T15:39:50Z", "2026-08-28", None, "", "nonsense", "2026-02-30T10:00:00",
    ]
    assert column(spark, given, text.format_datetime) == [
        "28/08/2026 15:39", "28/08/2026 15:39", "28/08/2026 15:39", "28/08/2026 15:39", "28/08/2026 00:00",
        "Chưa quét", "Chưa quét", "nonsense", "2026-02-30T10:00:00",
    ]
    days = ["2026-08-28", "2026-08-28T10:00", "2026-8-2", None, "x"]
    assert column(spark, days, text.format_date) == ["28/08/2026", "28/08/2026", "02/08/2026", "—", "x"]


def test_search_folds_ascii_only(spark):
    given = ["Đỗ Thị", "đỗ thị", "NGUYEN Van", "a%b", "a_b"]
    assert column(spark, given, lambda c: text.ascii_like(c, "đỗ")) == [False, True, False, False, False]
    assert column(spark, given, lambda c: text.ascii_like(c, "nguyen VAN")) == [False, False, True, False, False]
    assert column(spark, given, lambda c: text.ascii_like(c, "a_b")) == [False, False, False, True, True]
    assert column(spark, ["a\\b"], lambda c: text.ascii_like(c, "\\")) == [True]


def test_rounding_is_half_even_and_exact(spark):
    shares = spark.createDataFrame([(n, *p) for n, p in enumerate([(1, 32), (3, 32), (0, 0), (1, 3), (108, 108)])], "n int, a int, b int")
    got = [r["p"] for r in shares.orderBy("n").select(text.percent(F.col("a"), F.col("b")).alias("p")).collect()]
    assert got == [3.12, 9.38, 0.0, 33.33, 100.0]
    sums = spark.createDataFrame([(0, "149.85", 6), (1, "183.15", 6), (2, "0.00", 0)], "n int, s string, c int")
    means = sums.orderBy("n").select(text.mean2(F.col("s").cast("decimal(19,2)"), F.col("c")).alias("m"))
    assert [r["m"] for r in means.collect()] == [24.98, 30.52, 0.0]


def test_upload_types(spark):
    given = ["a.jpg", "b.JPEG", "c.tar.png", "d.pdf", "e.gif", "f", ".pdf", "", None]
    assert column(spark, given, text.allowed_upload) == [True, True, True, True, False, False, False, False, False]
    assert column(spark, [0, -90, 450, 45, None], text.valid_rotation, "int") == [True, True, True, False, True]
