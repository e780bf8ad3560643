"""User login enrichment, single-login users, machine dimension."""

from conftest import rows
from encore import schemas
from encore.plans import machines, users


def _regs(spark):
    s = spark.createDataFrame
    alipay = s([("1", "m1", "0", "b", "p1", "l", "t", "e", "10", "v", "1", "0", "oa1")], schemas.REG_ALIPAY)
    wechat = s([("1", "m1", "0", "b", "p1", "l", "t", "e", "12.5", "v", "wx1"),
                ("2", None, "1", "b", "p2", "l", "t", "e", "x", "v", "wx2")], schemas.REG_WECHAT)
    qq = s([("3", "m3", "0", "b", "p3", "l", "t", "e", "", "v", "q3")], schemas.REG_QQ)
    app = s([("4", "m4", "0", "b", "p4", "l", "t", "e", "v", "a4")], schemas.REG_APP)
    return users.registrations({"alipay": alipay, "wechat": wechat, "qq": qq, "app": app})


def test_registrations_layout(spark):
    r = _regs(spark)
    assert r.columns == schemas.REGISTRATIONS.names
    by = {(x["uid"], x["reg_channel"]): x for x in r.collect()}
    assert by[("1", "wechat")]["is_certified"] is None            # wechat: NULL
    assert by[("3", "qq")]["is_certified"] == ""                  # others: ""
    assert by[("3", "qq")]["qqid"] == "q3" and by[("4", "app")]["appid"] == "a4"
    assert by[("4", "app")]["score"] == "" and by[("4", "app")]["phone_number"] == "p4"


def _logins(spark, recs):
    return spark.createDataFrame([(u, i, "m", "t1", "t2", mt, d) for u, i, mt, d in recs], schemas.LOGINS)


def test_login_detail(spark):
    lg = _logins(spark, [("1", "a", "0", "20201230"), ("5", "b", None, "20201230"), ("1", "c", "1", "20201229")])
    det = users.login_detail(lg, _regs(spark), "20201230")
    assert det.columns == schemas.LOGIN_DETAIL.names
    got = rows(det, "uid", "id", "login_mode", "reg_channel", "score")
    assert got == rows(det.sparkSession.createDataFrame(
        [("1", "a", "alipay", "alipay", 10), ("1", "a", "alipay", "wechat", 12),
         ("5", "b", "app", None, None)], "a string, b string, c string, d string, e int"))


def test_single_login(spark):
    recs = [
        ("1", "a", "0", "20201230"),                                # one in window + older history
        ("1", "old", "0", "20201101"),
        ("3", "b", "0", "20201225"), ("3", "c", "0", "20201226"),   # two in window
        ("4", "d", "0", "20201223"),                                # one, on the window's first day
        ("2", "e", "0", "20201230"),                                # one, but reg_mid NULL
        ("9", "f", "0", "20201222"),                                # outside the window
        (None, "g", "0", "20201230"),
    ]
    hist = users.login_detail(_logins(spark, recs), _regs(spark))
    # uid 1 is in two channels -> two detail rows per login -> not "exactly one"
    got = rows(users.single_login(hist, "20201230"), "uid", "id")
    assert got == [("4", "d")]
    regs1 = _regs(spark).where("reg_channel <> 'wechat' or uid <> '1'")
    hist1 = users.login_detail(_logins(spark, recs), regs1)
    assert rows(users.single_login(hist1, "20201230"), "uid", "id") == [("1", "a"), ("1", "old"), ("4", "d")]
    assert rows(users.single_login(hist1, "20201230", bounded=True), "uid", "id") == [("1", "a"), ("4", "d")]


def _loc(spark, recs):
    data = [(mid, "p", "c", prov, city, "1", "x", "y", a, r, "null", "20200101") for mid, prov, city, a, r in recs]
    return spark.createDataFrame(data, schemas.MAC_LOC)


def test_location_truth_table(spark):
    A = "广东省深圳市南山区科技园"
    recs = [("1", "null", "null", A, "南山区_1"), ("2", "null", "C", A, "南山区_1"), ("3", "P", "C", A, "x"),
            ("4", "P", "C", "null", "x"), ("5", None, "C", A, "x"), ("6", None, "null", A, "南山区_1"),
            ("7", "P", "C", None, "x")]
    rep = machines.repair_locations(_loc(spark, recs))
    counts = {r["mid"]: r["count"] for r in rep.groupBy("mid").count().collect()}
    assert counts == {"1": 1, "2": 2, "3": 1, "5": 1, "6": 1}
    fixed = {(r["mid"], r["province"], r["city"]) for r in rep.collect()}
    assert ("1", "广东省", "深圳市") in fixed and ("2", "P", "C") not in fixed and ("2", "null", "C") in fixed
    assert {r["revenue_time"] for r in rep.collect()} == {"19700101000000"}
    assert {r["sale_time"] for r in rep.collect()} == {"20200101000000"}
    once = machines.repair_locations(_loc(spark, recs), mode="intended")
    assert {r["mid"]: r["count"] for r in once.groupBy("mid").count().collect()} == \
        {"1": 1, "2": 1, "3": 1, "5": 1, "6": 1}


def test_machine_base_info(spark):
    s = spark.createDataFrame
    mac = s([("1", "s", "h1", "w", "e", "u", "1", "1", "t1", "1", "0", "1", "1"),
             ("2", "s", "h2", "w", "e", "u", "1", "1", "t2", "1", "0", "1", "1")], schemas.MAC)
    loc = _loc(spark, [("1", "P", "C", "addr", "x"), ("2", "P", "C", "addr", "x"), ("3", "P", "C", "addr", "x")])
    admin = s([("1", "n1", "1", "2", "3", "4", "pk", "1", "t", "1", "1"),
               ("3", "n3", "1", "2", "3", "4", "pk", "2", "t", "1", "1")], schemas.MAC_ADMIN)
    smap = s([("1", "10"), ("3", "10"), ("2", "10")], schemas.MAC_STORE_MAP)
    store = s([("10", "st", "tg", "stg", "ss", "ssc", "b", "sb")], schemas.STORE)
    out = machines.base_info(mac, loc, admin, smap, store)
    assert out.columns == schemas.MACHINE_BASE.names
    got = rows(out, "mid", "product_name", "hard_id", "store_name")
    assert got == [("1", "MiniK", "h1", "st"), ("3", "Kshow", None, "st")]
    uni = machines.id_universe(mac, loc, admin)
    assert sorted(r[0] for r in uni.collect()) == ["1", "2", "3"]
    with_u = machines.mac_with_location(machines.repair_locations(loc), mac, uni)
    assert rows(with_u) == rows(machines.mac_with_location(machines.repair_locations(loc), mac))
