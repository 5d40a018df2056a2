import os
import sys

import pytest
from pyspark.sql import functions as F

from framecurate.llm.common import prepare

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from texts import LONG, prose  # noqa: E402

ODD_DOCS = [
    (7, prose(2, 80), "en", "a"), (3, prose(2, 80), "en", "a"),                 # equal texts, ids out of order
    (3, prose(2, 80), "en", "a"),                                              # a repeated row
    (9, prose(3, 60) + "\n" + prose(4, 60), "de", None), (None, prose(3, 60), None, "b"),
    (None, None, None, None), (None, None, None, None), (11, None, "en", "a"),
    (12, "", "en", "b"), (13, "   \n\t ", "fr", "b"), (14, "one", "fr", "b"), (15, "one two", "fr", "b"),
    (16, LONG, "en", "a"), (17, LONG.replace("alpha", "alphas", 3), "en", "a"),
    (18, prose(2, 80).upper(), "en", "a"), (19, "日本語 テキスト ümlaut İ ß <|endoftext|> ~x~ 3²", "ja", "c"),
    (20, "x" * 50_000, "en", "c"), (-5, prose(5, 40) + "\n\n" + prose(5, 40), "en", "c"),
    (20, prose(6, 30), "en", "c"),                                             # one id, two texts
]
#: Names that operators use inside.
CLASH = ["fp", "h", "n", "part", "score", "predicted", "root", "component_id", "pos", "kind", "start", "end",
         "tokens", "fingerprint", "c0", "c1", "guest", "chunk", "ids", "label", "x"]


@pytest.fixture(scope="session")
def llm_spark(spark):
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def odd_docs(llm_spark):
    df = llm_spark.createDataFrame(ODD_DOCS, "doc_id long, text string, lang string, source string")
    return df.select(*[F.lit("clash").alias(c) for c in CLASH], "*")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("1 = 0")


@pytest.fixture(scope="session")
def small_docs(llm_spark):
    return llm_spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
