"""The stages in a row, on documents with planted cases."""
import corpus_pipeline
from conftest import words

from gridlore.llm.queries import QUERIES


def test_stages(spark, docs_of, tmp_path):
    clean = [(i, " ".join(words(("c", i), 60 + i % 40))) for i in range(240)]
    bad = [(1000 + i, " ".join([*words(("b", i), 30), "xuzzle", "quorble", *words(("e", i), 20)])) for i in range(80)]
    shared, item = words("shared", 60), words("item", 25)
    copies = [(2000 + i, clean[i][1] + " more") for i in range(5)]
    repeats = [(3000 + i, " ".join(words(("r", i), 40) + shared)) for i in range(4)]
    leaked = [(4000, " ".join(words("l", 40) + item))]
    odd = [(5000, None), (5001, ""), (5002, "short one"), (None, " ".join(words("no id", 30)))]
    docs = docs_of(clean + bad + copies + repeats + leaked + odd)
    labels = [(i, 1, 0) for i, _ in clean] + [(i, 0, 1) for i, _ in bad]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")

    left = []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs.columns, stage(spark, docs, str(tmp_path))
        path = f"{tmp_path}/{number}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == before
            left.append({r.doc_id: r.text for r in docs.collect()})
    ids = [{*x} for x in left]
    assert ids[0] == {i for i, _ in clean + copies + repeats + leaked + odd}
    # The two texts without words are copies of each other.
    assert ids[1] == ids[0] - {i for i, _ in copies} - {5001}
    assert ids[2] == ids[1]
    passage = " ".join(shared)
    assert sum(passage in (x or "") for x in left[2].values()) == 1
    assert ids[3] == ids[2] - {4000}
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == ids[3]
    assert all(left[3][i] == text for i, text in clean)


def test_fourteen_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert [sum(x.startswith(f"op{n}_") for x in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(QUERIES) <= set(names)
