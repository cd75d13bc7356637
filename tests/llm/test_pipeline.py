import corpus_pipeline as P
from tripwright.llm import decontaminate, lines, minhash, quality

from .helpers import empty, table

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_the_small_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for name, stage in P.STAGES:
        now = stage(spark, seen[-1], SF)
        if name != "packing":
            assert now.columns == COLUMNS
        now = now.cache()
        seen.append(now)
    raw, good, unique, single, clean, packed = seen
    kept = {r.doc_id for r in quality.quality(raw).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept and 0 < len(kept) < raw.count()
    assert lines.duplicate_lines(unique).count() == 0
    labels = {r.doc_id: r.component_id for r in minhash.near_duplicates(unique).collect()}
    left = {r.doc_id for r in single.collect()}
    assert left == {d for d, c in labels.items() if d == c}
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    bad = {r.doc_id for r in decontaminate.contamination(single, benchmark).where("n_hit > 0").collect()}
    assert {r.doc_id for r in clean.collect()} == left - bad
    assert {r.doc_id for r in packed.collect()} == left - bad


def test_run_gives_the_last_stage(spark):
    assert P.run(spark, SF).columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    assert [n for n, _ in P.STAGES] == ["quality rules", "line dedup", "near-duplicates", "decontamination", "packing"]


def test_odd_tables(spark):
    for name, stage in P.STAGES:
        assert stage(spark, empty(spark), SF).count() == 0, name
    words = " ".join(f"w{i}" for i in range(80))
    rows = table(spark, [None, "", words, words + "\n" + "tail " * 3]).selectExpr("if(doc_id = 2, null, doc_id) as doc_id", "* except (doc_id)")
    for name, stage in P.STAGES[:4]:
        got = stage(spark, rows, SF)
        assert got.columns == rows.columns, name
        assert any((r.text or "").startswith(words) for r in got.collect()), name
