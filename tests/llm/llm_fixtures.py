import pytest

from tillwright.llm import registry


@pytest.fixture(autouse=True)
def shared_code(spark):
    registry.share_code(spark)


@pytest.fixture
def docs(spark, tmp_path_factory):
    """Documents with a fixed order, stored so that every read deals them out alike."""

    def build(rows, schema="doc_id long, text string", parts=3):
        path = str(tmp_path_factory.mktemp("docs") / "d")
        rows = list(rows)
        spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
        return spark.read.parquet(path)

    return build


def prose(rng, words, vocabulary=400):
    """Invented prose: lines of a few words, some with letters beyond ASCII."""
    out = []
    for i in range(words):
        out.append(f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.1 else f"w{rng.randrange(vocabulary)}")
        out.append("\n" if rng.random() < 0.12 else " ")
    return "".join(out).strip()


@pytest.fixture
def make_prose():
    return prose


#: Rows that every operator must bear: nulls, empty, blank, one long word, many blanks, repeated rows.
ODD = [(None, "lone row without id"), (-1, None), (-2, ""), (-3, " \n\t \n"), (-4, "x" * 3000), (-5, "A"), (-5, "A"),
       (-6, "same text twice here ok"), (-7, "same text twice here ok"), (None, None)]


@pytest.fixture
def odd():
    return list(ODD)
