import pytest

#: Nulls, blanks, ties, repeated rows, odd spaces, special strings, a long text.
TEXTS = [
    None, "", " ", "  a  b ", "a\nb\tc\x0bd", "▁", "x▁y ▁▁z", "<s> </s> <unk> <|startoftext|> <|endoftext|>", "É é ß ﬁ é 　x\xa0y",
    "The same words of a line that many documents share with one another today", "THE SAME words of a line that many documents share with one another today",
    "日本語 テキスト 🙂🙂 ok", "don't it's 123 4.5", "trailing ", "\n\n", "a" * 300, "word " * 5000, "naïve café " * 700,
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, kept string"


@pytest.fixture(scope="session")
def odd_rows():
    rows = [(i, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 4}", None, i, "clash") for i, t in enumerate(TEXTS)]
    return rows + [(3, TEXTS[3], "en", "s3", None, 3, "clash"), (None, "no id", None, None, None, None, None), (None, None, None, None, None, None, None), (40, "", "en", "s1", 0, 1, "x")]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.01"
