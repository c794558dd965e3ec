import corpus_pipeline
import public_tokenizers
import test_byte_bpe
import test_decontamination
import test_quality_rules
import test_simhash
import tiktoken  # noqa: F401
from messy import TEXTS, clashing, docs, rows_of
from test_byte_bpe import library  # noqa: F401

from ascentframe.llm import quality_classifier
from ascentframe.llm.common import table

SF = "/root/testdata/sf0.001"


def test_against_brute_force(spark, library):  # noqa: F811
    """Every stage by plain loops; for the classifier its scores, which have tests of their own."""
    frame, marks = table(spark, SF, "documents"), table(spark, SF, "labels")
    good = {r.doc_id for r in marks.collect() if r.quality == 1}
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    texts = dict(rows)
    kept = [r[0] for r in test_quality_rules.brute(rows, good) if r[-1]]
    left = frame.where(frame.doc_id.isin(kept))
    kept = [r.doc_id for r in quality_classifier.score(left, marks).where("predicted = 1").collect()]
    kept = sorted({c for _, _, c in test_simhash.brute([(i, texts[i]) for i in sorted(kept)])})
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    dirty = {r[0] for r in test_decontamination.brute([(i, texts[i]) for i in kept], items)}
    wanted = test_byte_bpe.expected(library, [(i, texts[i]) for i in kept if i not in dirty])
    assert rows_of(corpus_pipeline.run(spark, SF), *test_byte_bpe.COLUMNS) == wanted


def test_stages_keep_columns_and_take_messy_rows(spark):
    for frame in (clashing(docs(spark)), clashing(docs(spark, []))):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, frame, SF)
            assert after.dtypes == frame.dtypes
            assert after.count() <= frame.count()
        assert corpus_pipeline.STAGES[-1][1](spark, frame, SF).count() == frame.count()
    assert len(TEXTS) == docs(spark).count() and public_tokenizers.path("x")


def test_clean_documents_stay(spark):
    frame, marks = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    good = {r.doc_id for r in marks.where("quality = 1").collect()}
    for stage in (corpus_pipeline.by_rules, corpus_pipeline.by_classifier):
        texts = {r.doc_id: r.text for r in frame.collect()}
        after = {r.doc_id for r in stage(spark, frame, "/root/testdata/sf0.01").collect()}
        gone = [i for i in good & set(texts) - after if test_quality_rules.base(texts[i])[0] >= 10 and test_quality_rules.base(texts[i])[4] * 5 <= test_quality_rules.base(texts[i])[0]]
        assert len(gone) <= 0.01 * len(good)
