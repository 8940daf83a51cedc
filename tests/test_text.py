from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reqsift.functions import text

PIECE = st.text(alphabet="ab1-:[]| =&", max_size=6)
KEY = PIECE.filter(lambda s: s != "")


def _safe(m):
    """Without texts that, joined with the separators, spell a separator of their own."""
    joined = text.ENTRY_SEP.join(k + text.PAIR_SEP + v for k, v in m.items())
    parts = [p.split(text.PAIR_SEP) for p in joined.split(text.ENTRY_SEP)]
    return parts == [[k, v] for k, v in m.items()]


MAPS = st.lists(st.dictionaries(KEY, PIECE, min_size=1, max_size=4).filter(_safe), min_size=20, max_size=60)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck), phases=[Phase.generate])
@given(MAPS)
def test_decode_is_the_inverse_of_encode(spark, maps):
    maps = [m for m in maps if _safe(dict(sorted(m.items())))]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(maps)], "i int, m map<string,string>")
    back = df.select("i", "m", text.decode_map(text.encode_map(F.col("m"))).alias("back")).collect()
    assert all(r.m == r.back for r in back)


def test_encode_sorts_keys_and_writes_null_as_empty(spark):
    df = spark.createDataFrame([({"b": "2", "a": None},), ({},)], "m map<string,string>")
    lines = [r[0] for r in df.select(text.encode_map(F.col("m"))).collect()]
    assert lines == ["a[[:]][[--]]b[[:]]2", ""]


def test_decode_of_empty_text_is_empty(spark):
    assert spark.range(1).select(text.decode_map(F.lit(""))).first()[0] == {}


def test_last_win_map_needs_no_session_setting(spark):
    assert spark.conf.get("spark.sql.mapKeyDedupPolicy") == "EXCEPTION"
    schema = "e array<struct<key:string,value:string>>"
    df = spark.createDataFrame([([("a", "1"), ("b", "2"), ("a", "3"), ("a", None)],), ([],), (None,)], schema)
    assert [r[0] for r in df.select(text.last_win_map(F.col("e"))).collect()] == [{"a": None, "b": "2"}, {}, None]


def test_frame_round_trip(spark):
    message = text.frame(F.lit("a.example"), F.lit("x|y||z"))
    row = spark.range(1).select(message.alias("m")).select(
        "m", text.frame_key(F.col("m")).alias("k"), text.frame_line(F.col("m")).alias("l")
    ).first()
    assert row.m == "a.example|| x|y||z" and row.k == "a.example" and row.l == "x|y||z"


def test_is_blank(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",)], "s string")
    assert [r[0] for r in df.select(text.is_blank(F.col("s"))).collect()] == [True, True, False]
