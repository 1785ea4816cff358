import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, start=0, sources=None, langs=None):
    rows = [
        (start + i, t, (langs or {}).get(i, "en"), (sources or {}).get(i, f"src{i % 3}"), None if t is None else len(t)) for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture
def docs(spark):
    return lambda texts, **more: frame(spark, texts, **more)


#: Nulls, empties, white space, long and repeated texts, ties, odd characters.
ODD = [None, "", " ", "\n\n", "a", "a", "A", "word " * 30_000, "word " * 30_000, "tab\tand\x0bvt nbsp", "emoji 😀😀 and é", "x" * 70_000, "İstanbul K"]
