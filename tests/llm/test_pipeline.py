import pytest

import corpus_pipeline as C
from tradelake.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "mixing", "packing"]
    current, sizes = docs, [docs.count()]
    for name, stage in C.STAGES:
        out = stored(stage(spark, current, SF), name)
        if name != "packing":
            assert out.columns == docs.columns and out.schema == docs.schema
            assert {r.doc_id for r in out.select("doc_id").collect()} <= {r.doc_id for r in current.select("doc_id").collect()}
        sizes.append(out.count())
        current = out
    assert sizes[1] <= sizes[0] and sizes[2] == sizes[1] and sizes[3] <= sizes[2]
    assert current.columns[:4] == ["doc_id", "start", "length", "ids_crc32"]
    assert C.run(spark, SF).count() == sizes[-1]


LABELS = "doc_id long, quality int, toxic int"
CLEAN = "\n".join(f"a quiet sentence about garden number {i} and the weather of the week" for i in range(3))


@pytest.fixture
def folder(spark, docs, tmp_path):
    """A data folder with the given documents and labels for the first of them."""
    def make(rows):
        docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
        marks = [(r[0], 1, 0) for r in rows[:4] if r[0] is not None]
        spark.createDataFrame(marks, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
        return str(tmp_path)
    return make


ODD = [(1, CLEAN, "a"), (1, CLEAN, "a"), (None, "a text without an id", "b"), (2, None, None), (3, "", "b"), (4, "\n\n", "a"),
       (5, "word " * 20_000, "b"), (6, CLEAN + "\none more line that nothing else has got", "c"), (7, "x", "c")]


def test_every_stage_on_odd_rows(spark, folder):
    sf = folder(ODD)
    current = spark.read.parquet(f"{sf}/documents.parquet")
    columns = current.columns
    for name, stage in C.STAGES:
        out = stored(stage(spark, current, sf), name)
        if name != "packing":
            assert out.columns == columns, name
        if name in ("toxicity", "line_dedup"):
            assert out.count() == len(ODD), name                       # clean documents stay, whatever they hold
        if name == "near_duplicates":
            # of the two equal rows one has lost its lines and joins the texts without words
            assert sorted(map(str, (r.doc_id for r in out.collect()))) == ["1", "1", "5", "6", "7", "None"]
            assert [r.doc_id for r in out.collect() if not (r.text or "").strip()] == [1]
        if name == "mixing":
            assert out.where("text is not null and trim(text) <> ''").count() > 0
        current = out
    assert current.count() > 0


def test_every_stage_on_an_empty_table(spark, folder):
    sf = folder([])
    current = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in C.STAGES:
        current = stored(stage(spark, current, sf), name)
        assert current.count() == 0, name
