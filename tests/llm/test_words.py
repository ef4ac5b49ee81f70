"""Words of all scripts, and near copies and passages in them."""

import pytest
from pyspark.sql import functions as F

from bazaarflow.llm import decontamination, jaccard_join, shingles, span_dedup

HAN = [chr(0x4E00 + 37 * k % 5000) for k in range(400)]
ENGLISH = "It's a plain passage of some words - and it isn't the only one. Nobody \"knows\" how it goes on. It ends here."


@pytest.mark.parametrize(
    "text, n",
    [
        ("\u4f60\u597d\uff0c\u4e16\u754c\u3002abc", 5),
        ("\u3053\u308c\u306f\u30ab\u30bf\u30ab\u30ca2\u500b", 9),
        ("\u0e17\u0e35\u0e48\u0e19\u0e35\u0e48", 2),
        ("cafe\u0301 \u0939\u093f\u0928\u094d\u0926\u0940 \u00fcber", 3),
        ("\ud55c\uad6d\uc5b4 \ubb38\uc7a5", 2),
        ("a\u00a0b\u3000c\u2014d\u201ce\u201d \u2026 \u0301 \U0001f600", 5),
        ("\ufffd\u3002", 0),
    ],
)
def test_words_by_class(text, n):
    assert len(shingles.word_hashes(text)) == n
    assert (shingles.word_hashes("- " + text) == shingles.word_hashes(text)).all()


def test_typographic_marks_and_blanks_change_nothing():
    fine = ENGLISH.replace("'", "\u2019").replace(' "', " \u201c").replace('" ', "\u201d ").replace(" - ", "\u00a0\u2014 ")
    assert (shingles.word_hashes(fine) == shingles.word_hashes(ENGLISH)).all()
    wide = fine.replace(". ", ".\u00a0")
    assert [x.tolist() for x in span_dedup.spans(wide)] == [x.tolist() for x in span_dedup.spans(ENGLISH)]


def clauses(mark="\uff0c"):
    return mark.join("".join(HAN[k : k + 40]) for k in range(0, 400, 40)) + "\u3002"


def test_near_copies_and_items_without_spaces(spark):
    whole = clauses()
    near = whole.replace(HAN[85], "x").replace(HAN[245], "y").replace(HAN[325], "z")
    df = spark.createDataFrame([(1, whole), (2, near), (3, clauses("\u3001")), (4, "".join(HAN[::-1]))], "doc_id bigint, text string")
    assert {r.doc_id for r in jaccard_join.one_of_each(df).collect()} == {1, 4}
    items = spark.createDataFrame([(7, "".join(HAN[100:112]))], "item_id bigint, text string")
    assert {r.doc_id for r in decontamination.contained(df, items).collect()} == {1, 2, 3}


def test_passages_end_at_full_width_marks(spark):
    passage = "".join(HAN[:12]) + "\u3002" + "".join(HAN[12:20]) + "\uff01" + "".join(HAN[20:30]) + "\uff1f"
    texts = {1: "".join(HAN[50:60]) + "\u3002" + passage, 2: "".join(HAN[70:85]) + "\u3002" + passage + "".join(HAN[90:99]) + "\u3002"}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").withColumn("h", F.lit(1))
    got = {r.doc_id: r for r in span_dedup.deduplicated(df).collect()}
    assert got[1].text == texts[1] and got[1].n_sentences == 4
    assert got[2].text == texts[2].replace(passage, "") and got[2].n_removed == 3
    assert got[2].removed_spans == f"16:{16 + len(passage) - 1}"
