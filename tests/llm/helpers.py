"""Small tables with the awkward rows that every operator must take."""

SF = "/root/testdata/sf0.001"
TOK = "/opt/tokenizers"

ODD_TEXTS = [None, "", " ", "\n", "word", "two words", "a  b\t c", "Ünïcode tëxt “quoted” 日本語 😀", "x" * 30_000,
             "one two three four five six seven eight", "one two three four five six seven eight", "\x00 \x01 \x02.", "▁ blank sign"]


def odd_documents(spark, extra: bool = True):
    """Null id, repeated ids and rows, null and empty and long texts; columns that clash."""
    rows = [(i, t, "en" if i % 2 else None, "s", len(t or "")) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id here at all", "en", None, 1), (None, None, None, None, None), (9, ODD_TEXTS[9], "en", "s", 1), (3, "other text of id three", "de", "s", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        from pyspark.sql import functions as F
        df = df.withColumn("score", F.lit("x")).withColumn("c0", F.lit(1)).withColumn("_doc", F.lit(2)).withColumn("kept", F.lit(3)).withColumn("block", F.lit(4))
    return df


def empty_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
