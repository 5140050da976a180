import os

from sorigil.streaming.ingest import start_jamo_ingest


def test_incremental_ingest(spark, tmp):
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w", encoding="utf-8") as f:
        f.write("filename|text\n1.wav|안녕하세요\n2.wav|값\n")
    out = os.path.join(tmp, "out")
    ckpt = os.path.join(tmp, "ckpt")
    q = start_jamo_ingest(spark, src, out, ckpt, available_now=True)
    q.awaitTermination(120)
    with open(os.path.join(src, "b.csv"), "w", encoding="utf-8") as f:
        f.write("filename|text\n3.wav|닭\n")
    q = start_jamo_ingest(spark, src, out, ckpt, available_now=True)
    q.awaitTermination(120)
    rows = {r["filename"]: r["jamo"] for r in spark.read.parquet(out).collect()}
    assert rows == {"1.wav": "ㅇㅏㄴㄴㅕㅇㅎㅏㅅㅔㅇㅛ", "2.wav": "ㄱㅏㅄ", "3.wav": "ㄷㅏㄺ"}
    files = {r["filename"]: r["source_file"].rsplit("/", 1)[-1] for r in spark.read.parquet(out).collect()}
    assert files == {"1.wav": "a.csv", "2.wav": "a.csv", "3.wav": "b.csv"}
