"""Reading level: parts of the formula, defined cases, and held-out agreement with readers."""

import os
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelake.llm import reading

EASY = "We can go home now. The dog ran to the red box and sat on it. It is a good day for all of us."
HARD = "Notwithstanding considerable epistemic indeterminacy, the ontological reification of provisional invariants presupposes methodological commitments that are seldom articulated."


def test_words_sentences_and_machine_lines():
    assert reading.words_and_sentences("Stop it. Go on!\n- a list item\r\n2. another one") == (["stop", "it", "go", "on", "a", "list", "item", "another", "one"], 4)
    machine = '{"a":1,"b":"c"}\n2021-01-01T00:00:00Z INFO w-1 n=3 t=x.y\nsha256 0f0f\na/b/c/2021-01-01/hour-1.zst\n| X | 1 | 2 |\noffset 1 -> 2 lag=3 session a-b_1'
    assert reading.words_and_sentences(machine) == ([], 0)
    assert reading.words_and_sentences("be​fore after x\x85y z") == (["before", "after", "x", "y", "z"], 3)
    assert reading.words_and_sentences(None) == ([], 0) == reading.words_and_sentences(" 　\n")


PIECES = st.sampled_from([*"aBzİßéЖ夜²5_'’-.!?,;:#*>•()[]/=", " ", "  ", "\t", "\n", "\r\n", "\x85", "\u2028", "\u3000", "\u200b", "\xad", "\x1c", "1. ", "- ", "word", "don't", "x=1"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(PIECES, max_size=30).map("".join)), max_size=8))
def test_many_texts_at_once_follow_the_rule(texts):
    n, s, words, counts = reading.count_words(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        want, sentences = reading.words_and_sentences(text)
        assert dict(zip(words[i].as_py(), counts[i].as_py())) == dict(Counter(want)) and (n[i], s[i]) == (len(want), sentences)


def test_every_word_counts_and_no_language_is_seeded(spark):
    """Words beyond any number or length take part, and languages that nothing was told about are told from English."""
    long = "pneumono" + "ultra" * 10 + "ly"
    docs = [(i, f"the {long} word w{chr(97 + i // 26 % 26)}{chr(97 + i % 26)} is plain and we read it") for i in range(80)]
    docs += [(900, "ja to nie wiem czy plik jest gotowy i kto go sprawdzi"), (901, "dit is een lijst met namen die niemand meer kent")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, "r", 1 + i % 5, None) for i in range(80)], "doc_id long, rater string, level int, rated_at timestamp")
    f = reading.train(d, labels)
    assert long in f.words and {"waa", "wdb"} <= set(f.words) and not {"plik", "lijst"} & {w for w, m in zip(f.words, f.masks) if m & reading.KNOWN}
    by = {r.doc_id: r for r in reading.reading_levels(d, labels).collect()}
    assert by[0].is_english_prose and not by[900].is_english_prose and not by[901].is_english_prose


def corpus(spark, n=60):
    docs, labels = [], []
    for i in range(n):
        docs.append((i, HARD if i % 2 else EASY, "xx", 1))
        labels.append((i, "r", 5 if i % 2 else 1, None))
    docs += [(900, None, "en", 1), (901, "", "en", 1), (902, " \n", "en", 1), (903, '{"a":1}', "en", 1), (904, "Die Lücke wurde später geschlossen und die Datei ist nicht da, bitte prüfen Sie das. " * 3, "en", 1), (905, HARD * 2000, "de", 1), (906, "夜間の処理は問題なく終わりました。" * 3, "en", 1), (1, HARD, "en", 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, level int")
    return d, spark.createDataFrame(labels + labels[:3] + [(2, "q", None, None)], "doc_id long, rater string, level int, rated_at timestamp")


def test_defined_cases(spark):
    d, labels = corpus(spark)
    got = reading.reading_levels(d, labels).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == d.count()
    assert all(by[i].level is None and not by[i].is_english_prose for i in (900, 901, 902, 903, 904, 906))
    assert by[0].level <= 2 and by[1].level >= 4 and by[905].level >= 4 and by[905].n_words > 20_000
    f = reading.Formula()
    assert reading.reading_levels(d.limit(0), labels, f).count() == 0
    assert reading.reading_levels(d, labels.limit(0)).count() == d.count()
    assert reading.reading_levels(d.limit(0), labels.limit(0)).count() == 0


def test_readers_median(spark):
    rows = [(1, "a", 2, 1), (1, "a", 4, 2), (1, "b", 5, 1), (1, "b", 5, 1), (2, "a", None, 1), (3, "a", 9, 1)]
    d = spark.createDataFrame(rows, "doc_id long, rater string, level int, rated_at long")
    assert [tuple(r) for r in reading.median_levels(d).collect()] == [(1, 4.5)]
    many = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("a").alias("rater"), F.lit(3).alias("level"), F.lit(1).alias("rated_at"))
    assert reading.median_levels(many, 20).count() == 20


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_held_out_agreement(spark):
    """Fitted without a fifth of the labelled documents, it agrees with their readers."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/reading_labels.parquet")
    test = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    out = reading.reading_levels(docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi"), labels, reading.train(docs, labels.where(~test)))
    m = reading.median_levels(labels.where(test)).withColumnRenamed("level", "told").join(out.where("is_english_prose"), "doc_id").where("told <= 3 OR told >= 4").collect()
    hit = sum(r.level >= 4 and r.told >= 4 for r in m)
    said, hard = sum(r.level >= 4 for r in m), sum(r.told >= 4 for r in m)
    assert len(m) > 100 and hit / said > 0.9 and hit / hard > 0.85
    assert sum(abs(r.level_estimate - r.told) for r in m) / len(m) < 0.5
