"""The pipeline's stages on a small table, and the stage that strips repeats."""

import corpus_pipeline
import numpy as np
import public_tokenizers
from test_dedup import byte_rows, covered

import __spark_entry__ as entry
from tabforge.llm import byte_bpe, suffix_dedup


def test_strip_repeats_keeps_rows_and_characters(spark):
    rows = byte_rows(1)
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, row string, _null int")
    got = suffix_dedup.strip_repeats(df, block_bytes=3000)
    assert got.columns == df.columns
    want = []
    for (d, t), (_, u, flags) in zip(rows, covered(rows, lambda t: (t or "").encode(), 50)):
        starts = [i for i in range(len(u)) if u[i] & 0xC0 != 0x80] + [len(u)]
        kept = b"".join(u[a:b] for a, b in zip(starts, starts[1:]) if not any(flags[a:b]))
        want.append((d, None if t is None else kept.decode(), "x", 1))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_pipeline_stage_by_stage(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and entry.queries()["pipeline"] is not None
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
        assert out.columns == docs.columns
        left = {r.doc_id for r in out.select("doc_id").collect()}
        assert left <= ids and len(left) > 100
        ids, docs = left, out
    assert docs.filter("n_chars <> length(text)").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in last} == ids and all(r.intact for r in last)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        codec = byte_bpe.codec_of(f.read(), public_tokenizers.PATTERN)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in last[:50]:
        raw = np.frombuffer(bytes(r.ids), "<u4").astype(np.int64)
        assert codec.decode(raw, np.array([0, len(raw)]))[0].tobytes().decode() == texts[r.doc_id]


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Null ids and texts, repeated rows, a text of a million characters; then no rows at all."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    first = docs.orderBy("doc_id").first()
    long = " ".join(f"word{i} of a long text," for i in range(45_000))
    odd = [(None, first.text, "en", "x", 1), (None, None, None, None, None), (first.doc_id, first.text, first.lang, first.source, first.n_chars), (9001, None, "en", "x", None),
           (9002, "", "en", "x", 0), (9003, long, "en", "x", len(long)), (9003, long, "en", "x", len(long))]
    for name, rows in (("odd", docs.unionByName(spark.createDataFrame(odd, docs.schema))), ("none", docs.filter("false"))):
        rows.write.parquet(str(tmp_path / name / "documents.parquet"))
        for other in ("labels", "benchmark"):
            spark.read.parquet(f"{folder}/{other}.parquet").write.parquet(str(tmp_path / name / f"{other}.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()
    assert all(r.intact for r in found) and len(found) > 100
    assert {len([r for r in found if r.doc_id == i]) for i in (first.doc_id, 9003)} <= {0, 2}  # copies of a row stay or go together
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
