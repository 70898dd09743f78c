import pytest
from pyspark.sql import functions as F

#: Awkward rows: nulls, empty and blank texts, copies, repeated rows, a very long text, and
#: columns whose names the operators use inside.
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ROWS = [
    (1, None, "en", "b"),
    (2, "", "en", "b"),
    (3, " \t\n\v\f\r ", None, None),
    (4, "Hello   world\n\nagain ", "en", "a"),
    (5, "HELLO   world\n\nAGAIN ", "en", "a"),
    (6, "Äpfel und Öl, größer als ▁ zwei  Räume", "de", "c"),
    (7, "äpfel und Öl, größer als ▁ zwei  Räume", "de", None),
    (8, LONG, "fr", "a"),
    (9, LONG, "fr", "a"),
    (10, "1234 5678 --- !!!", "es", "d"),
    (11, "a", "en", "d"),
    (12, "日本語のテキスト 😀 　 \x00 nul\x1ctab\x85 x", None, "e"),
    (12, "日本語のテキスト 😀 　 \x00 nul\x1ctab\x85 x", None, "e"),
    (13, "<|endoftext|> a <|endoftext|>  b</s><s> <unk>", "en", "e"),
    (14, " leading and trailing  ", "en", "a"),
    (15, "\nline\n \nline\r\nend\n", "en", "a"),
]
CLASHING = ["size", "key", "before", "hash", "norm", "raw", "_id", "n", "start", "score", "kept", "shard", "taken", "component"]


@pytest.fixture(scope="session")
def awkward(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string, source string")
    for name in CLASHING:
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def small_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return {r.doc_id: r.text or "" for r in docs.collect()}
