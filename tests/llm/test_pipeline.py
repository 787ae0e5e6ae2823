"""Each stage against brute force on its own input."""

import corpus_pipeline
import pyarrow as pa
from brute import SPACE, components, secrets
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9000, None, "en", "s", 0), (9001, "12 34", None, "s", 5), (9002, "", "en", "s", 0), (9003, "plain words that stay token=abcdefghij", "en", None, 38)], docs.schema)
    docs = docs.union(odd)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        rows = after.collect()
        texts = [(r["doc_id"], r["text"]) for r in before]
        ids = sorted(r["doc_id"] for r in rows)
        if name == "language":
            assert ids == sorted(i for i, t in texts if any(c.isalpha() for c in t or ""))
        elif name == "exact_copies":
            best = {}
            for i, t in texts:
                key = SPACE.sub("", t)
                best[key] = min(best.get(key, (1, 0)), (-len(t), i))
            assert ids == sorted(i for _, i in best.values())
        elif name == "near_copies":
            assert ids == sorted({c for _, n, c in components(texts, 5, 80, 100)})
        elif name == "secrets":
            assert ids == sorted(i for i, _ in texts)
            assert not any(secrets(r["text"]) for r in rows) and all(r["n_chars"] == len(r["text"]) for r in rows)
            was = dict(texts)
            assert all(r["text"] == was[r["doc_id"]] for r in rows if not secrets(was[r["doc_id"]]))
        else:
            assert {r["doc_id"] for r in rows} == {i for i, _ in texts}
            assert sum(r["length"] for r in rows) == sum({r["doc_id"]: r["doc_tokens"] for r in rows}.values())
        docs = after


def test_unknown_scripts_go(spark):
    """The prediction decides: text in a script that no label knows has no more than chance in common with any prototype."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    strange = [(9100 + i, t * 30, None) for i, t in enumerate(("日本語のテキストです。", "Привет мир, это текст. ", "これは別の文章"))]
    out = corpus_pipeline.identify_language(spark, docs.union(spark.createDataFrame(strange, docs.schema)), SF)
    ids = {r["doc_id"] for r in out.collect()}
    assert not ids & {i for i, _, _ in strange}
    assert ids == {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}


def test_odd_tables_through_all_stages(spark, tmp_path):
    text = "some words that stand in this text more than once and go on for a while "
    rows = [(None, text), (1, text), (1, text), (2, text + "x"), (3, None), (4, ""), (5, "12 34"), (6, "x" * 200_000), (7, text * 2000), (None, None)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    for name in ("raw", "score", "lang_pred", "spans", "sha", "label", "stay", "blob"):
        docs = docs.withColumn(name, docs["lang"])
    for n, table in enumerate((docs, docs.limit(0))):
        table.write.parquet(str(tmp_path / f"{n}/documents.parquet"))
        out = corpus_pipeline.run(spark, str(tmp_path / str(n)))
        assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        # the copies of one text leave one row; a text that repeats it has the same five-word shingles but for the seam
        assert {r["doc_id"] for r in out.collect()} - {2, 7} == ({1, 6} if n == 0 else set())


def test_batches_are_bounded_in_bytes(spark):
    """A batch of up to 10,000 texts is a task's whole part, and in memory several times over."""
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words of plain text "), 1000).alias("text"), F.lit("en").alias("lang")).coalesce(1)
    assert corpus_pipeline.identify_language(spark, docs, SF).count() == 600

    def sizes(batches):
        for b in batches:
            yield b.select(["doc_id"]).append_column("size", pa.array([b.nbytes] * b.num_rows))

    rows = docs.mapInArrow(sizes, "doc_id long, size long").collect()
    assert len(rows) == 600 and max(r["size"] for r in rows) <= 6 << 20


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
