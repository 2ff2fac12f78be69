import hashlib
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parents[2])]
import check_oracle  # noqa: E402
import corpus_fixture as fx  # noqa: E402
import corpus_pipeline  # noqa: E402
from braidlake.llm.queries import ORACLE, QUERIES  # noqa: E402

public_tokenizers = pytest.importorskip("public_tokenizers")
ROOT = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    text, ok = check_oracle.compare(spark, check_oracle.connect(ROOT), ROOT, name)
    assert ok, text


def test_every_query_runs_over_the_whole_table(spark):
    n = spark.read.parquet(f"{ROOT}/documents.parquet").count()
    for name in ("op1_token_files", "op2_quality", "op8_byte_bpe"):
        assert QUERIES[name](spark, ROOT).count() == n


def test_stages_in_a_row(spark, tmp_path):
    """Each stage on the result of the one before, against plain Python."""
    spark.createDataFrame(fx.documents(), fx.SCHEMA).select(corpus_pipeline.COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == corpus_pipeline.COLUMNS, name
        out.write.parquet(str(tmp_path / f"stage{i}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{i}"))
        seen[i] = [tuple(r) for r in docs.collect()]
    assert all(not fx.base_counts(r[1])[5] for r in seen[0])
    texts = {k: v for k, v in fx.lines_kept(seen[0])}
    assert {r[0]: r[1] for r in seen[1]} == {k: v for k, v in texts.items() if fx.words(v)}
    assert all(r[4] == len(r[1]) for r in seen[1])
    _, roots = fx.near_components(seen[1], 5)
    assert {r[0] for r in seen[2]} == {r[0] for r, c in zip(seen[1], roots) if r[0] == c}
    assert {r[0] for r in seen[3]} <= {r[0] for r in seen[2]}
    import tiktoken

    from braidlake.llm.bpe import Encoder

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    t = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=Encoder(path, public_tokenizers.PATTERN).ranks, special_tokens={}
    )
    want = []
    for r in seen[3]:
        ids = np.array(t.encode_ordinary(r[1]), "<u4")
        want.append((r[0], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(r[1].encode()).hexdigest()))
    assert sorted(seen[4]) == sorted(want)


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, ROOT)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0


def test_importable_entry():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline", *QUERIES} <= names and set(ORACLE) <= set(entry.oracle_sql())
