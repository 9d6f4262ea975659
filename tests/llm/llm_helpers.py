"""Documents for the operator tests."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part int, chunk string, row string, doc long, ids string, sequence_id string"
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(20_000))


def make(spark, texts):
    """Documents with ids from 0 and extra columns whose names operators use inside."""
    data = [(i, t, "en", "s", len(t or ""), 7, "c", "r", 9, "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(data, SCHEMA)
