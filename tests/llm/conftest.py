import pytest


@pytest.fixture
def tables(spark, tmp_path):
    """Writes the given tables as Parquet and returns their folder."""

    def write(**frames):
        for name, df in frames.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) rows, with columns whose names the operators use inside."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7, 0.5, "x") for i, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long, n long, score double, h string")

    return make
