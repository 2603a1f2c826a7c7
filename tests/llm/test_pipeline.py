import corpus_pipeline
from tests.llm.test_search import reached


def test_stages(spark, sf, docs, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "n-gram Jaccard join", "mixing sources", "best-fit packing"]
    before, frames = docs, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, sf).write.parquet(f"{tmp_path}/{i}")
        before = spark.read.parquet(f"{tmp_path}/{i}")
        frames.append(before)
    assert all(f.columns == docs.columns for f in frames[:-1])
    ids = [{r["doc_id"] for r in f.select("doc_id").collect()} for f in frames]
    good, once, far, mixed, packed = ids
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert sum(labels[i] == 1 for i in labels if i not in good) <= 1
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    low = {i: "".join(c.lower() if "A" <= c <= "Z" else c for c in texts[i] or "") for i in good}
    assert once == {min(i for i in good if low[i] == t) for t in set(low.values())}
    top = reached([(i, texts[i]) for i in once], 5, 80)
    assert far == {i for i in once if top[i] == i}
    assert mixed == far == packed
    pieces = frames[-1].groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in pieces) <= 2048


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_near_copies_go_by_row(spark, sf):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (2, text + " more"), (2, "an unrelated text that has some words of its own"), (None, text + " other")]
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf).collect()
    assert sorted(r["text"] for r in got) == sorted([rows[0][1], rows[2][1]])


def test_packing_follows_the_mix(spark, sf, tmp_path):
    """Of equally long documents, those that the schedule puts first are placed first."""
    docs = spark.range(600).selectExpr("id as doc_id", "'the same words' as text", "case when id < 500 then 'hot' else 'rare' end as source")
    corpus_pipeline.interleave(spark, docs, sf).write.parquet(f"{tmp_path}/m")
    rows = corpus_pipeline.fill(spark, spark.read.parquet(f"{tmp_path}/m"), sf).collect()
    first = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))][:200]
    assert 40 <= sum(i >= 500 for i in first) <= 80  # weights 22 and 10: a third is rare, where the table has a sixth


def test_stages_take_hard_rows(spark, sf, edge):
    for (_, stage), rows in zip(corpus_pipeline.STAGES[1:4], (8, 9, 13), strict=True):
        assert stage(spark, edge, sf).count() == rows
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, edge.limit(0), sf).count() == 0
