import unicodedata

from pyspark.sql import functions as F

from sorigil.functions import jamo as J
from sorigil.sources import fixtures as fx


def _hangulized(text):
    """The derivation rule of the fixtures in plain Python."""
    return "".join(fx.hangul_of(ord(c)) if "A" <= c <= "Z" or "a" <= c <= "z" or 0xC0 <= ord(c) <= 0xFF else c for c in text)


def test_every_syllable_native_matches_python(spark):
    rows = [(chr(cp),) for cp in range(J.SYLLABLE_FIRST, J.SYLLABLE_LAST + 1)]
    df = spark.createDataFrame(rows, "t string")
    got = df.select("t", J.hangul_to_jamo("t").alias("j"), J.hangul_to_jamo_arrow(F.col("t")).alias("a")).collect()
    assert len(got) == 11172
    for r in got:
        assert r["j"] == J.decompose_syllable(r["t"]) == r["a"]


def test_decomposition_recomposes():
    # The compatibility jamo map back to conjoining jamo; NFC recomposes the syllable.
    ini = "ᄀᄁᄂᄃᄄᄅᄆᄇᄈᄉᄊᄋᄌᄍᄎᄏᄐᄑᄒ"
    med = "".join(chr(0x1161 + i) for i in range(21))
    fin = "".join(chr(0x11A8 + i) for i in range(27))
    for cp in range(J.SYLLABLE_FIRST, J.SYLLABLE_LAST + 1, 7):
        d = J.decompose_syllable(chr(cp))
        conj = ini[J.INITIALS.index(d[0])] + med[J.MEDIALS.index(d[1])] + (fin[J.FINALS.index(d[2])] if len(d) == 3 else "")
        assert unicodedata.normalize("NFC", conj) == chr(cp)


def test_edge_cases(spark):
    df = spark.createDataFrame([("안녕하세요",), ("닭 값 text|",), ("",), (None,), ("a😀b가",)], "t string")
    got = [r[0] for r in df.select(J.hangul_to_jamo("t")).collect()]
    assert got == ["ㅇㅏㄴㄴㅕㅇㅎㅏㅅㅔㅇㅛ", "ㄷㅏㄺ ㄱㅏㅄ text|", "", None, "a😀bㄱㅏ"]
    arrow = [r[0] for r in df.select(J.hangul_to_jamo_arrow(F.col("t"))).collect()]
    assert arrow == got


def test_utf8_bytes_forms_agree(spark):
    texts = ["ㅇㅏㄴ", "", None, "a😀é", "[S1] ㄱ"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    native = [r[0] for r in df.select(J.utf8_bytes("t")).collect()]
    arrow = [r[0] for r in df.select(J.utf8_bytes_arrow(F.col("t"))).collect()]
    expect = [None if t is None else list(t.encode("utf-8")) for t in texts]
    assert native == expect
    assert arrow == expect


def test_hangulize_matches_python(spark):
    docs = fx.table(spark, "/root/testdata/sf0.001", "documents").select("text").limit(20)
    for r in docs.select("text", fx.hangulize("text").alias("h")).collect():
        assert r["h"] == _hangulized(r["text"])
