"""The corpus pipeline against its stages' brute-force versions."""

import corpus_pipeline
from test_dedup import UP, brute_components, brute_fingerprint, brute_repeats
from test_tokens import check_pieces
from tidemark.llm.common import table

import public_tokenizers as P
from tokenizers import Tokenizer

TINY = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = table(spark, TINY, "documents")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r["doc_id"], r["text"]) for r in docs.collect()] if "text" in docs.columns else []
        out = stage(spark, docs, TINY)
        out.write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        if name != "packing":
            assert after.columns == docs.columns
            kept = {r["doc_id"]: r["text"] for r in after.collect()}
        if name == "toxicity":
            labels = {r["doc_id"]: r["toxic"] for r in table(spark, TINY, "labels").collect()}
            gone = [i for i, _ in before if i not in kept]
            assert sum(labels.get(i) == 0 for i in gone) <= 0.05 * len(before)
        elif name == "exact dedup":
            best = {}
            for i, t in before:
                best[(t or "").translate(UP)] = max(i, best.get((t or "").translate(UP), i))
            assert set(kept) == set(best.values())
        elif name == "SimHash near-dedup":
            fps = {i: brute_fingerprint(t) for i, t in before}
            links = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
            assert set(kept) == set(brute_components(fps, links).values())
        elif name == "suffix-array dedup":
            want = {i: w[3].decode("utf-8", "ignore") for i, w in brute_repeats(before).items()}
            assert all((kept[i] or "") == want[i] for i in want) and len(kept) == len(want)
        else:
            padding, total = check_pieces(after.collect(), before, Tokenizer.from_file(P.path("byte_bpe_50k.json")))
            assert padding < 0.02 * total
        docs = after


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, TINY).columns[0] == "doc_id"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "SimHash near-dedup", "suffix-array dedup", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_table(spark):
    docs = table(spark, TINY, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, TINY)
        assert out.count() == 0
        docs = out if out.columns == docs.columns else docs
