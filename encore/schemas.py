"""One explicit schema per warehouse table (column order = write order).

Source (ODS) tables are all-string, as their text DDL is.  Names are lower
case; Spark resolves them case-insensitively.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names.split()]


def _struct(*groups) -> T.StructType:
    fields: list[T.StructField] = []
    for g in groups:
        fields += _strings(g) if isinstance(g, str) else [g]
    return T.StructType(fields)


def _long(n: str) -> T.StructField:
    return T.StructField(n, T.LongType())


DATA_DT = T.StructField("data_dt", T.StringType())

# --- client log -----------------------------------------------------------
LOG_ROUTED = _struct("request_type line")
SONG_PLAY = _struct("songid mid optrate_type uid consume_type dur_time session_id songname pkg_id order_id",
                    DATA_DT)

#: A day's part of the song features: rows (kind '#') and values seen (kind: their column).
SONG_STATE = _struct("songid kind v", _long("n"), DATA_DT)
SONG_SKETCHES = _struct("songid", _long("n"), T.StructField("s_uid", T.BinaryType()),
                        T.StructField("s_order_id", T.BinaryType()), DATA_DT)

# --- songs ------------------------------------------------------------------
SONG_INFO = _struct(
    "nbr name other_name source album prdct lang video_format dur singer_info post_time pinyin_fst "
    "pinyin sing_type ori_singer lyricist composer bpm_val star_level video_qlty video_mk video_ftur "
    "lyric_ftur img_qlty subtitles_type audio_fmt ori_sound_qlty ori_trk ori_trk_vol acc_ver acc_qlty "
    "acc_trk_vol acc_trk width height video_rsvl song_ver auth_co state prdct_type")

SONG_BASE = _struct(
    "nbr name source album prdct lang video_format dur singer1 singer2 singer1id singer2id",
    T.StructField("mac_time", T.IntegerType()),
    "post_time pinyin_fst pinyin sing_type ori_singer lyricist composer bpm_val star_level video_qlty "
    "video_mk video_ftur lyric_ftur img_qlty subtitles_type audio_fmt ori_sound_qlty ori_trk ori_trk_vol "
    "acc_ver acc_qlty acc_trk_vol acc_trk width height video_rsvl song_ver auth_co state",
    T.StructField("prdct_type", T.ArrayType(T.StringType())))

SONG_FEATURES = _struct(
    "nbr name source album prdct lang video_format dur singer1 singer1id singer2 singer2id",
    T.StructField("mac_time", T.IntegerType()),
    *[_long(n) for n in (
        "singcnt suppcnt usercnt orderidcnt sing7cnt supp7cnt user7cnt orderid7cnt "
        "sing30cnt supp30cnt user30cnt orderid30cnt dtop7singcnt dtop7suppcnt dtop30singcnt "
        "dtop30suppcnt").split()],
    DATA_DT)

SONG_RSI = _struct("period nbr name", T.StructField("rsi", T.DoubleType()),
                   T.StructField("rsi_rank", T.IntegerType()), DATA_DT)
SINGER_ROLLUP = _struct(
    "data_dt singer1id singer1",
    *[_long(n) for n in (
        "sing_cnt supp_cnt rct_7_sing_cnt rct_7_supp_cnt rct_7_top_sing_cnt rct_7_top_supp_cnt "
        "rct_30_sing_cnt rct_30_supp_cnt rct_30_top_sing_cnt rct_30_top_supp_cnt").split()])
SINGER_RSI = _struct("period singer1id singer1", T.StructField("rsi", T.DoubleType()),
                     T.StructField("rsi_rank", T.IntegerType()), DATA_DT)

# --- users ------------------------------------------------------------------
_REG_COMMON = "uid reg_mid sex birthday"
REG_ALIPAY = _struct(_REG_COMMON, "msisdn locationid regist_time user_exp score user_level "
                     "is_certified is_student_certified openid")
REG_WECHAT = _struct(_REG_COMMON, "msisdn locationid regist_time user_exp score user_level wxid")
REG_QQ = _struct(_REG_COMMON, "msisdn locationid regist_time user_exp score user_level openid")
REG_APP = _struct(_REG_COMMON, "phone_number locationid regist_time user_exp user_level app_uid")
REGISTRATIONS = _struct(
    "uid reg_mid sex birthday phone_number locationid reg_channel regist_time user_exp score "
    "user_level is_certified is_student_certified openid wxid appid qqid")
LOGINS = _struct("uid id mid logintime logouttime mode_type", DATA_DT)
LOGIN_DETAIL = _struct(
    "uid id mid logintime logouttime login_mode reg_mid sex birthday phone_number locationid "
    "reg_channel regist_time user_exp",
    T.StructField("score", T.IntegerType()),
    "user_level is_certified is_student_certified openid wxid appid qqid",
    DATA_DT)

# --- machines -----------------------------------------------------------------
MAC = _struct("mid serialnum hard_id song_warehouse_version exec_version ui_version online status "
              "current_login_time pay_switch language_type songware_type screen_type")
MAC_LOC = _struct("mid province_id city_id province city map_class mglng mglat address real_address "
                  "revenue_time sale_time")
MAC_ADMIN = _struct("machine_num machine_name inv_rate age_rate com_rate par_rate package_name "
                    "product_type activate_time is_activate had_mpay_func")
MAC_STORE_MAP = _struct("machine_num store_id")
STORE = _struct("id store_name tag_name sub_tag_name sub_scence_name sub_scence_cate_name brand_name "
                "sub_brand_name")
MAC_LOC_JOINED = _struct(
    "mid serialnum hard_id song_warehouse_version exec_version ui_version online status "
    "current_login_time pay_switch language_type songware_type screen_type province_id city_id "
    "province city map_class mglng mglat address real_address revenue_time sale_time")
MACHINE_BASE = _struct(
    "mid machine_name inv_rate age_rate com_rate par_rate package_name product_type product_name "
    "activate_time is_activate had_mpay_func hard_id song_warehouse_version exec_version ui_version "
    "revenue_time sale_time store_name tag_name sub_tag_name sub_scence_name sub_scence_cate_name "
    "brand_name sub_brand_name province city address real_address current_login_time")
