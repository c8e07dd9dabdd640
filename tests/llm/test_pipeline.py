"""The pipeline's stages, and its queries on whole small tables."""

import corpus_pipeline
import __spark_entry__ as E
from adtrail.llm import queries
from conftest import SMOKE
from llm.conftest import documents


def test_stages_and_run_agree(spark, staging):
    docs = queries.table(spark, SMOKE, "documents")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staging.table(stage(spark, docs, SMOKE), name)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        sizes.append(docs.count())
    assert 0 < sizes[3] < sizes[2] < sizes[0] and sizes[1] <= sizes[0]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE)
    got, want = corpus_pipeline.run(spark, SMOKE), last
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_stages_take_edge_rows(spark, edge, empty, staging):
    for rows in (edge, empty):
        docs = rows
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = staging.table(stage(spark, docs, SMOKE), name)
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE).collect()


def test_every_operator_is_registered():
    names = E.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names


def test_near_copies_are_told_by_five_words_and_eight_tenths(spark, staging):
    words = [f"w{i}" for i in range(220)]
    scattered = [f"new{i}" if i in (20, 70, 120, 170) else w for i, w in enumerate(words[:200])]   # 176 of 216 shingles
    longer = words[:200] + [f"more{i}" for i in range(30)]                                         # 196 of 226
    fewer = [f"new{i}" if i in (20, 50, 80, 110, 140, 170) else w for i, w in enumerate(words[:200])]   # 166 of 226
    texts = [words[:200], scattered, longer, fewer]
    docs = documents(spark, [(i + 1, " ".join(t), "en", "a") for i, t in enumerate(texts)])
    kept = corpus_pipeline.without_near_copies(spark, docs, SMOKE)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4]
