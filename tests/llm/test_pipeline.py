"""The pipeline's stages against brute force, and their defined results for odd rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from provgraph.llm import chosen_path, quality, raking, secret_scan, sp_codec
from provgraph.llm.queries import MIXTURE, MIXTURE_KEEP

pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


def _classes(rows):
    """Smallest (id, place) of each class of the rows (id, text), by all pairs."""
    sets = [set(chosen_path.shingles(chosen_path.words_list(t)).tolist()) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [i for i in range(len(rows)) if find(i) == i]


def test_every_stage_agrees_with_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = docs
    seen = {}
    for name, stage in pipeline.STAGES:
        stage(spark, left, SF).write.parquet(str(tmp_path / name))
        left = spark.read.parquet(str(tmp_path / name))
        seen[name] = sorted(left.collect(), key=lambda r: r["doc_id"])
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    kept = {r[0] for r in con.sql(f"SELECT doc_id FROM ({quality.ORACLE_SQL}) WHERE kept").fetchall()}
    cleaned = seen["quality_rules"]
    assert {r["doc_id"] for r in cleaned} == kept and all(r["n_chars"] == len(r["text"]) for r in cleaned)
    rows = [(r["doc_id"], r["text"]) for r in cleaned]
    assert [r["doc_id"] for r in seen["ngram_jaccard_join"]] == [rows[i][0] for i in _classes(rows)]
    whole = {r["doc_id"]: r["text"] for r in cleaned}
    for r in seen["secret_scan"]:
        assert r["text"] == secret_scan.redact(whole[r["doc_id"]], secret_scan.find_spans(whole[r["doc_id"]])[1])
    masked = spark.createDataFrame(seen["secret_scan"], docs.schema)
    chosen = raking.mix(masked, MIXTURE, MIXTURE_KEEP).where("selected")
    assert [r["doc_id"] for r in seen["source_mix"]] == sorted(r["doc_id"] for r in chosen.collect())
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sp_codec.MODEL_PATH)
    texts = {r["doc_id"]: r["text"] for r in seen["secret_scan"]}
    assert seen["sentencepiece"] and all(r["ids"] == library.encode(texts[r["doc_id"]]) and r["round_trip"] for r in seen["sentencepiece"])
    run = pipeline.run(spark, SF)
    assert sorted(r["doc_id"] for r in run.collect()) == [r["doc_id"] for r in seen["sentencepiece"]]


def test_odd_rows_pass_every_stage(spark):
    text = lambda k: ". ".join(f"{k}{i} word" for i in range(60))
    rows = [(1, None, "en", "src0", None), (None, "", None, None, 0), (2, text("a"), "en", "src1", 1), (2, text("b"), None, None, 1), (2, text("a"), "en", "src1", 1), (None, text("c"), "xx", "none", 1), (3, "x" * 200_000, "en", "src2", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({"quality": F.lit("q"), "mix_lang": F.lit("m"), "key0": F.lit(0)})
    first = pipeline.quality_stage(spark, docs, SF)
    assert sorted(r["text"][:1] for r in first.collect()) == ["a", "a", "b", "c"]
    assert sorted(r["text"][:1] for r in pipeline.duplicates_stage(spark, first, SF).collect()) == ["a", "b", "c"]
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).collect() == []
    for _, stage in pipeline.STAGES[2:3] + pipeline.STAGES[4:]:
        assert stage(spark, docs, SF).count() == len(rows)
    assert pipeline.mixture_stage(spark, docs, SF).columns == list(pipeline.COLUMNS)
