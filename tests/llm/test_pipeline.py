import public_tokenizers
import pytest
import sentencepiece
from test_decontaminate import brute as contaminated
from test_simhash import brute as grouped
from test_simhash import plain

from touchline.llm import decontaminate, langid, secrets, simhash, subwords

pipeline = pytest.importorskip("corpus_pipeline", reason="the pipeline is removed")
SF = "/root/testdata/sf0.001"


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    _, scores, fits = langid.fit(docs).predict([r.text for r in docs.collect()])
    rows = [r for r, fit, s in zip(docs.collect(), fits, scores) if fit and s >= langid.LEAST_SCORE]
    keep = {d for d, _, c in grouped([(r.doc_id, r.text) for r in rows]) if d == c}
    rows = [r for r in rows if r.doc_id in keep]
    hit = {d for d, _, n, *_ in contaminated([(r.doc_id, r.text) for r in rows], items) if n}
    rows = [r for r in rows if r.doc_id not in hit]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(subwords.MODEL))
    got = pipeline.run(spark, SF)
    assert got.columns == [*docs.columns, "piece_ids", "same"] and got.where("same").count() == len(rows)
    got = by_id(got)
    assert set(got) == {r.doc_id for r in rows} and hit and len(keep) < docs.count()
    for r in rows:
        text = secrets.masked(r.text)
        assert (
            got[r.doc_id].text, got[r.doc_id].lang, got[r.doc_id].source, got[r.doc_id].piece_ids
        ) == (text, r.lang, r.source, library.encode(text))


def test_stages_keep_columns_and_take_odd_rows(spark):
    rows = [
        (1, None, "en", "s", 0, "a"), (2, "", "en", "s", 0, "b"), (None, "the same words", None, None, None, None),
        (None, "the same words", None, None, None, None), (5, "The same  words", "en", "s", 3, "c"), (5, "The same  words", "en", "s", 3, "c")
    ]
    rows += [(6 + i, f"text number {i} is of its own kind {'abcdefgh'[i]}" * 5, "en", "s", 1, "d") for i in range(8)]
    rows += [(40, "a long text of its own " * 20_000 + "ab" * 40_000, "en", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string")
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).collect() == []
    last = pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.columns == [*docs.columns, "piece_ids", "same"] and last.where("same").count() == len(rows)
    assert pipeline.STAGES[-1][1](spark, docs.limit(0), SF).collect() == []
    kept = simhash.one_of_each(docs).collect()
    groups = grouped([(r[0], r[1]) for r in rows])
    assert len(kept) == len({c for *_, c in groups}) and sum(r.doc_id == 5 for r in kept) == 1
    alone = simhash.one_of_each(docs.where("doc_id is null")).collect()
    assert len(alone) == 1 and alone[0].text == "the same words"
    assert len({plain(r.text) for r in kept}) == len(kept)
    assert len(decontaminate.clean(docs, spark.createDataFrame([(1, "the same words")], "item_id long, text string")).collect()) == len(rows) - 4
