"""Account numbers in the forms in which they are written."""

from bazaarflow.llm import pii

FORMS = ["DE89 3704 0044 0532 0130 00", "de89370400440532013000", "gb82 west 1234 5698 7654 32", "NO93-8601-1117-947", "FR14 2004 1010 0505 0001 3M02 606", "DE89370400440532013000", "MT84 MALT 0110 0001 2345 MTLC AST0 01S"]


def test_written_forms(spark):
    texts = [x for f in FORMS for x in (f"IBAN: {f} and 12 more words", f"({f}).", f"\u00e4 {f}\n{f}")]
    wrong = ["DE88 3704 0044 0532 0130 00", "DE89 3704 0044 0532 0130", "De89 3704 0044 0532 0130 00", "XX89 3704 0044 0532 0130 00", "xDE89 3704 0044 0532 0130 00", "DE89 3704 0044 0532 0130 001", "DE89  3704 0044 0532 0130 00"]
    df = spark.createDataFrame(list(enumerate(texts + wrong)), "doc_id bigint, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.iban] for r in pii.personal_data(df).collect()}
    for k, text in enumerate(texts):
        form = FORMS[k // 3]
        at = [i for i in range(len(text)) if text.startswith(form, i)]
        assert got[k] == [(i, i + len(form)) for i in at], text
    assert [got[len(texts) + k] for k in range(len(wrong))] == [[]] * len(wrong)
