import pytest

TOKENIZERS = "/opt/tokenizers"


@pytest.fixture
def documents(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, s, "clash") for i, t, s in rows], "doc_id bigint, text string, source string, flagged string")

    return make
