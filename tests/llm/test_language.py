import zlib

from helpers import awkward, awkward_rows, empty

from fettle.llm import language, queries


def test_held_out_accuracy(spark, sf_dir):
    truth = {r["doc_id"]: r["lang"] for r in queries.documents(spark, sf_dir).collect()}
    rows = queries.op5_language_id(spark, sf_dir).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    out = [r for r in rows if r["held_out"] and truth[r["doc_id"]]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) / len(out) > 0.9
    assert sum(r["accepted"] for r in rows) / len(rows) > 0.9


def test_sample_is_bounded(spark, sf_dir):
    learnt = language.sample_dictionaries(queries.documents(spark, sf_dir), 4, 100)
    assert set(learnt) == {"de", "en", "es", "fr"} and all(len(v) <= 2 * 4 * 101 for v in learnt.values())


def test_awkward_rows(spark):
    learnt = {"en": b"the of and to in is that for it was on", "de": b"der die das und ist nicht ein eine mit"}
    rows = {(r["doc_id"], r["lang_pred"]): r for r in language.identify(awkward(spark), learnt).collect()}
    assert sum(1 for _ in language.identify(awkward(spark), learnt).collect()) == len(awkward_rows())
    for i in (0, 1, 2, 3):
        assert rows[i, "und"]["score"] == 0 and not rows[i, "und"]["accepted"]
    assert language.identify(empty(spark), learnt).count() == 0
    for few in ({}, {"en": learnt["en"]}):
        assert language.identify(awkward(spark), few).count() == len(awkward_rows())
    assert language.sample_dictionaries(empty(spark)) == {}
    clash = awkward(spark).withColumnRenamed("lang", "score").withColumnRenamed("source", "lang_pred")
    out = language.identify(clash, learnt)
    assert out.columns.count("score") == 1 and dict(out.dtypes)["score"] == "double" and "_block" in out.columns


def test_narrow_leads_are_rejected(spark):
    learnt = {"en": b"the of and to in is that for it was on", "de": b"der die das und ist nicht ein eine mit"}
    docs = spark.createDataFrame([(1, "zq xv " * 40), (2, "the of and that for it was on the of and")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in language.identify(docs, learnt).collect()}
    assert not rows[1]["accepted"] and rows[2]["accepted"] and rows[2]["lang_pred"] == "en"


def test_short_texts_tie_less_often(spark, sf_dir):
    """Of labelled texts under 60 characters that tie by whole bytes, most are told apart by parts."""
    docs = queries.documents(spark, sf_dir)
    encoders = language.Encoders(language.sample_dictionaries(docs))
    rows = [(t[at : at + 30], r["lang"]) for r in docs.where("lang is not null").collect() if (t := r["text"] or "")
            for at in range(0, min(len(t), 600), 30) if t[at : at + 30].strip()]
    tied = right = found = 0
    for text, lang in rows:
        blocks = [language.letters(text)]
        whole = [language._size([e], blocks) for e in encoders.all]
        if whole.count(min(whole)) > 1:
            sizes = encoders.sizes(text)
            tied += 1
            found += sizes.count(min(sizes)) == 1
            right += sizes.count(min(sizes)) == 1 and encoders.names[sizes.index(min(sizes))] == lang
    assert tied > 50 and found > 0.5 * tied and right > 0.8 * found


def test_documents_without_an_id_are_learnt_from(spark):
    docs = spark.createDataFrame([(None,), (1,)], "doc_id long")
    assert all(r[0] is not None for r in docs.select(language.held_out(docs.doc_id)).collect())
