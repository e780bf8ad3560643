"""Function vectors: one (input, expected) table per cleaning function."""

from pyspark.sql import functions as F

from encore.functions import dates, machines as M, songs as S, users as U
from encore.functions.rsi import singer_rsi, song_rsi


def _eval(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


NO_ALBUM = "暂无专辑"


def test_album_name(spark):
    cases = [
        ('[{"name":"《A》","id":"1"}]', "《A》"),
        ("《LANDIVA》", "《LANDIVA》"),
        ("x《a》b《c》y", "《a》b《c》"),
        (None, NO_ALBUM), ("", NO_ALBUM), ("[]", NO_ALBUM), ("abc", NO_ALBUM),
        ('[{"id":"1"}]', None),
        ('{"name":"o"}', NO_ALBUM),
        ("》a《", NO_ALBUM),
        ("《a\nb》", "《a\nb》"),
    ]
    got = _eval(spark, [c[0] for c in cases], S.album_name)
    assert got == [c[1] for c in cases]


def test_singer_info(spark):
    two = '[{"name":"A","id":"1"},{"name":"B","id":"2"}]'
    one = '[{"name":"A","id":"1"}]'
    vals = [two, one, None, "not json", "[]", "", '[{"name":"A"}]', '[{"name":"A","id":10306}]']
    get = {k: _eval(spark, vals, lambda c, k=k: S.singer_info(c, *k))
           for k in [(1, "name"), (1, "id"), (2, "name"), (2, "id")]}
    assert get[(1, "name")] == ["A", "A", "", "", "", "", "A", "A"]
    assert get[(1, "id")] == ["1", "1", "", "", "", "", None, "10306"]
    assert get[(2, "name")] == ["B", "", "", "", "", "", "", ""]
    assert get[(2, "id")] == ["2", "", "", "", "", "", "", ""]


def test_post_time(spark):
    vals = ["2013-10-31 00:00:00", "2013-10-31 00:00:00.0", "2013-13-45 25:61:61", "2013-10-31",
            "x", "", None, "2013-1-5 3:4:5", "2013-10-00 00:00:00"]
    got = _eval(spark, vals, lambda c: S.post_time(c, "UTC"))
    assert got == ["2013-10-31 00:00:00", "2013-10-31 00:00:00", "2014-02-15 02:02:01", "", "", "", "",
                   "2013-01-05 03:04:05", "2013-09-30 00:00:00"]
    # Epoch milliseconds, scientific notation, shown in the requested zone.
    assert _eval(spark, ["1.3819392E+12"], lambda c: S.post_time(c, "Asia/Shanghai")) == ["2013-10-17 00:00:00"]
    assert _eval(spark, ["1381939200000"], lambda c: S.post_time(c, "UTC")) == ["2013-10-16 16:00:00"]
    assert _eval(spark, ["1381939200999.9"], lambda c: S.post_time(c, "UTC")) == ["2013-10-16 16:00:00"]


def test_product_types_and_split(spark):
    assert _eval(spark, ["[8,6,9]", "[8]", None, "8", "[]"], S.product_types) == ["8,6,9", "8", "", "", ""]
    arr = _eval(spark, ["", "8, 6"], S.product_type_array)
    assert arr == [[""], ["8", " 6"]]


def test_auth_company(spark):
    vals = ['{"name":"X"}', "bad", None]
    assert _eval(spark, vals, S.auth_company) == ["", "", ""]
    assert _eval(spark, vals, lambda c: S.auth_company(c, "intended")) == ["X", "", ""]


def test_length(spark):
    assert _eval(spark, ["xixi", "miaomiao", None], S.text_length) == [4, 8, None]


def test_province_city(spark):
    cases = [
        ("广西壮族自治区柳州市城中区东环大道", "城中区_x", "广西壮族自治区", "柳州市"),
        ("北京市朝阳区望京", "朝阳区_y", "北京市", "朝阳区"),
        ("广东省深圳市南山区科技园", "南山区_1", "广东省", "深圳市"),
        ("广东省深圳市南山区科技园", "科技园", "广东省", "深圳市南山区"),
        ("浙江杭州市", "杭州市", "", "浙江"),
        ("广东省深圳市", "无_1", "广东省", "无"),
        ("", "x_1", "", ""),
        (None, "x", "", ""),
        ("内蒙古自治区包头市", "x", "内蒙古自治区", ""),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "a string, r string")
    got = df.select(M.province(F.col("a")), M.city(F.col("a"), F.col("r"))).collect()
    assert [tuple(g) for g in got] == [c[2:] for c in cases]


def test_compact_time(spark):
    got = _eval(spark, ["null", "20200101", "20200101120000", None], M.compact_time)
    assert got == ["19700101000000", "20200101000000", "20200101120000", None]


def test_product_name(spark):
    assert _eval(spark, ["1", "2", None], M.product_name) == ["MiniK", "Kshow", "Kshow"]


def test_login_mode(spark):
    got = _eval(spark, ["0", "1", "3", "2", None, "", " 1 ", "0.0"], U.login_mode)
    assert got == ["alipay", "wechat", "qq", "app", "app", "app", "wechat", "alipay"]


def test_score_int(spark):
    got = _eval(spark, ["10", "", None, "12.5", "x", "99999999999"], U.score_int)
    assert got == [10, None, None, 12, None, None]


def test_day_minus():
    assert dates.day_minus("20201230", 7) == "20201223"
    assert dates.day_minus("20201230", 30) == "20201130"
    assert dates.window_bounds("20201230", 7) == ("20201223", "20201230")
    assert dates.window_bounds("20201230", 7, inclusive=False) == ("20201224", "20201230")


def test_day_number_roundtrip(spark):
    df = spark.createDataFrame([("20201230",), ("19700101",)], "d string")
    got = df.select(dates.day_string(dates.day_number(F.col("d"))), dates.day_minus_col(F.col("d"), 30)).collect()
    assert [tuple(r) for r in got] == [("20201230", "20201130"), ("19700101", "19691202")]


def test_rsi_formulas(spark):
    import math
    L = lambda x: math.log(x + 1)
    df = spark.createDataFrame([(5, 0, 20, 9)], "s long, p long, s7 long, t7 long")
    c = F.col
    r = df.select(song_rsi(1, c("s"), c("p")), song_rsi(7, c("s7"), c("p"), c("t7"), c("p")),
                  singer_rsi(7, c("s7"), c("p"), c("t7"), c("p"))).first()
    assert math.isclose(r[0], (L(5) * .63 * .8 + L(0) * .63 * .2) ** 2 * 10)
    assert math.isclose(r[1], ((L(20 / 7) * .63 + L(9) * .37) * .8 + (L(0) * .63 + L(0) * .37) * .2) ** 2 * 10)
    assert math.isclose(r[2], ((L(20 / 7) * .63 + L(0) * .37) * .8 + (L(9 / 7) * .63 + L(0) * .37) * .2) ** 2 * 10)


def test_sql_functions_match_columns(spark):
    from encore.functions import sql as SQL
    SQL.register(spark)
    vals = ["null", "20200101", "20200101120000", None, "1", "2", "[8,6,9]", "[8]", "8", "0", "3", "",
            "12.5", "x", " 1 "]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    df.createOrReplaceTempView("sqlfn_vectors")
    got = spark.sql("SELECT compact_time(x), product_name(x), product_types(x), login_mode(x), score_int(x) "
                    "FROM sqlfn_vectors").collect()
    exp = df.select(M.compact_time(F.col("x")), M.product_name(F.col("x")), S.product_types(F.col("x")),
                    U.login_mode(F.col("x")), U.score_int(F.col("x"))).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in exp]
    assert spark.sql("SELECT day_minus('20201230', 30)").first()[0] == "20201130"


def test_post_time_never_fails(spark):
    vals = ["2013-10-99999999 00:00:00", "99999-99-99 99:99:99", "2013-10-31 00:00:99999999999", "1e30",
            "-1.5E+12", "99999999999999999999999", "0000-00-00 00:00:00"]
    got = _eval(spark, vals, lambda c: S.post_time(c, "UTC"))
    assert len(got) == len(vals) and all(isinstance(g, str) for g in got)
    assert got[4] == "1922-06-20 21:20:00" and got[5] == ""
