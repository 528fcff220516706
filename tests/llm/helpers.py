"""Documents with every odd case: nulls, empties, odd white space, special strings, ties, repeated rows, long texts."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("kept", T.StringType()), T.StructField("measures", T.StringType()),
    T.StructField("ids", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("key", T.StringType()),
])

LONG = " ".join(f"w{i * i % 9973}" for i in range(30_000))

TEXTS = [
    None, "", " ", "\n", "a", "A bc  def", "tab\there", " lead", "trail ", "x\n\ny", "x \n y", "line\nline\nline",
    "<|endoftext|> a<|endoftext|>b", "it's we'll DON'T", " nbsp　wide", "emoji \U0001f600 café 中文",
    "a▁b ▁", "nul\x00byte", "<s> </s> <unk> <0x0A>", "1234567890 12,345.67", "#*$%&|<>", "one two three four",
    "one two three four five six", "same same same same same same", LONG,
]


def rows():
    out = [(i, t, "en" if i % 2 else None, f"src{i % 3}" if i % 4 else None, None) for i, t in enumerate(TEXTS)]
    out += [(5, "A bc  def", "en", "src1", 3), (5, "A bc  def", "en", "src1", 3), (None, "no id", None, None, None),
            (None, None, None, None, None), (100, "one two three four five six", "de", "src9", 1)]
    return [(*r, "clash", "clash", "clash", "clash", "clash") for r in out]


def odd_documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df):
    return [r.asDict() for r in df.collect()]
