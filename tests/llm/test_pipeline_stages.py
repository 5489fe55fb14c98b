import os

import corpus_pipeline
import pytest
from llm_texts import prose

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_stages_keep_the_columns_and_run_gives_pieces(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.dtypes == docs.dtypes, name
    pieces = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(pieces.columns) and pieces.count()


def test_decisions_take_effect(spark, tmp_path):
    passage = prose(1, 60)
    rows = [(i, f"{prose(100 + i, 80)}\n{passage if i in (3, 4) else ''}\n{prose(500 + i, 40)}") for i in range(10)]
    rows += [(20, rows[5][1]), (21, rows[6][1].replace(rows[6][1].split()[50], "edited", 1)), (22, "too short"), (23, None), (24, rows[7][1] + " " + prose(900, 30))]
    rows += [(25, f"{prose(300, 40)} {prose(77, 25)} {prose(301, 40)}"), (26, "Same Again " * 60)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, prose(77, 25))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept, texts = [], dict(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        kept.append(sorted(r.doc_id for r in docs.collect()))
    assert kept[0] == [*range(10), 20, 21, 24, 25]
    assert kept[1] == [*range(10), 24, 25] or kept[1] == [*range(10), 25]
    assert kept[3] == [i for i in kept[2] if i != 25]
    after = {r.doc_id: r for r in docs.collect()}
    assert passage.split()[30] not in after[3].text.split() and after[3].n_chars == len(after[3].text)
    assert after[0].text == texts[0]
