import corpus_pipeline
from dwellmart.llm import stages


def test_stages_keep_the_columns(spark, docs, tmp_path):
    folder = str(tmp_path)
    frame = docs.drop("score").selectExpr("*", "'en' AS lang", "length(text) AS n_chars")
    frame.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "nothing like it")], "item_id LONG, text STRING").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(9)], "doc_id LONG, quality INT, toxic INT").write.parquet(
        f"{folder}/labels.parquet"
    )
    read = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, read, folder).columns == read.columns
    kept = stages.near_duplicates(spark, read, folder)
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert ids == sorted((i is None, i or 0) for i in [1, 4, 5, 6, None, 8, 9, 10])
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_near_copies_of_repeated_ids(spark):
    from dwellmart.llm.shipping import ship

    def texts(name):
        words = [f"{name}{i}" for i in range(80)]
        return " ".join(words), " ".join([*words, "more"])

    (a, a2), (x, x2), (y, y2) = texts("a"), texts("x"), texts("y")
    b, z = texts("b")[0], texts("z")[0]
    rows = [(1, a), (5, a2), (5, b), (10, y), (11, y2), (11, x), (12, x2), (20, z), (20, z + " more"), (20, z), (None, a), (5, "")]
    frame = ship(spark).createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    found = [tuple(r) for r in stages.near_duplicates(spark, frame, "").collect()]
    z_kept = [r for r in found if r[0] == 20]
    assert len(z_kept) == 1 and z_kept[0] in rows
    expected = {(1, a), (5, b), (10, y), (11, x), (None, a), (5, "")}
    assert len(found) == 7 and set(found) - set(z_kept) == expected
