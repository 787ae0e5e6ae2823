"""The language stage on tables without labels, and on texts too short to judge."""

import corpus_pipeline


def test_texts_stay_where_nothing_is_labelled(spark):
    schema = "doc_id long, text string, lang string"
    texts = [(1, "plain words", None), (2, "日本語", None), (3, "12 !!", None), (4, None, None), (5, "", None)]
    for rows in (texts, [*texts, (6, None, "en")]):
        out = corpus_pipeline.identify_language(spark, spark.createDataFrame(rows, schema), "")
        assert out.columns == ["doc_id", "text", "lang"] and sorted(r["doc_id"] for r in out.collect()) == [1, 2]


def test_short_texts_with_a_letter_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    short = [(9200 + i, t, lang) for i, (t, lang) in enumerate((("A.", "en"), ("A.\nAll rights reserved.", "en"), ("Avec.", "fr"), ("OK", None), ("Ja", "de"), ("Короткий текст", None)))]
    gone = [(9300, "Привет мир, это длинный текст. " * 3, None), (9301, "12", "en"), (9302, None, "en")]
    out = corpus_pipeline.identify_language(spark, docs.union(spark.createDataFrame(short + gone, docs.schema)), "")
    ids = {r["doc_id"] for r in out.collect()}
    assert {i for i, _, _ in short} <= ids and not ids & {i for i, _, _ in gone}
