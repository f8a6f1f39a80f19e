"""Texts travel once to the judge of languages, in parts, and counts are summed up where they arise."""

from __future__ import annotations

import corpus_pipeline
from attestry.llm import language

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_a_text_goes_to_the_judge_once(spark, monkeypatch):
    docs = spark.createDataFrame([(2, "some words", "en", "s", 1), (3, "12", None, "s", 2)], SCHEMA)
    given = []
    plain = type(docs).mapInArrow
    monkeypatch.setattr(
        type(docs), "mapInArrow", lambda self, *a: given.append(self.schema) or plain(self, *a)
    )
    known = corpus_pipeline.known_language(spark, docs, "")
    assert known.columns == docs.columns
    assert given[-1].names == ["_row", "text"]
    assert given[-1]["_row"].dataType.names == [c for c in docs.columns if c != "text"]


def test_counts_are_summed_up_before_they_leave_a_task(spark, monkeypatch):
    """One row for each n-gram, however often a task had to sum up; the same profile."""
    texts = [(i, "abc abd", "en" if i % 2 else "de") for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string").coalesce(1)
    whole = sorted(map(tuple, language.learn_profiles(docs).collect()))
    grams = len({row[2] for row in whole})
    monkeypatch.setattr(language, "FLUSH", 10 * grams)
    sent = []
    plain = type(docs).mapInArrow
    monkeypatch.setattr(
        type(docs), "mapInArrow", lambda self, *a: sent.append(plain(self, *a)) or sent[-1]
    )
    assert sorted(map(tuple, language.learn_profiles(docs).collect())) == whole
    assert sent[0].count() == 2 * grams
