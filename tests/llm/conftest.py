import pytest

SCHEMA = "doc_id long, text string"
ODD = [
    "", None, " ", "  ", "a", " a", "a ", "a  b", "\n\n a\t b　c", "▁x ▁ y", "<s> </s> <unk> <|endoftext|>x <|startoftext|>.",
    "Don't we'll IT'S 12345 ½ Ⅷ", "ﬁ é é Σας ΣΑΣ İx", "x\x1cy \x85z\xa0q", "日本語のテキスト", "🙂🙂 a🙂", "\x00 a\x00b", "a" * 3000,
    "word " * 3000, "ab, Cd. EF; gh: ij! (kl)", "\r\n x \r\n",
]


@pytest.fixture
def odd(spark):
    """Empty, null, long and strange texts, repeated rows, and columns with clashing names."""
    rows = [(i, t, "x", 1, b"k") for i, t in enumerate(ODD)] + [(4, "a", "y", 2, b"k"), (4, "a", "y", 2, b"k"), (None, "null id", "z", 3, None)]
    return spark.createDataFrame(rows, SCHEMA + ", key string, n long, ids binary")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ids_and_texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


def sample(spark, n=300):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(n)
