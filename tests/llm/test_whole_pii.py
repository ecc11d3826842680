"""Account and card numbers with words and digits after them."""

import pytest

from areapanel.llm import pii

IBANS = ("DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947",
         "FR14 2004 1010 0505 0001 3M02 606", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "BE68539007547034",
         "XX89370400440532013000")  # the last: a code that is not listed; check digits are set below
AFTER = ("", " Kontakt", " The end", " BIC COBADEFF", " 00", " 12345 A", " GB82 WEST 1234 5698 7654 32", ", und", ". 7", " KONTO")


def checked(iban):
    body = iban.replace(" ", "")
    number = int("".join(str(int(c, 36)) for c in body[4:] + body[:2] + "00"))
    return f"{iban[:2]}{98 - number % 97:02d}{iban[4:]}"


@pytest.fixture(scope="module")
def cases():
    rows = []
    for iban in map(checked, IBANS):
        for after in AFTER if iban[:2] != "XX" else ("", " Kontakt", ", und"):
            rows.append((len(rows), f"iban {iban}{after}", iban, after))
    return rows


def test_iban_before_words_and_digits(spark, cases):
    docs = spark.createDataFrame([c[:2] for c in cases], "doc_id int, text string")
    only = tuple(k for k in pii.KINDS if k.name == "iban")  # digits around may be a card by chance
    spans = {r.doc_id: r.spans for r in pii.find_pii(docs).collect()}
    texts = {r.doc_id: r.text for r in pii.redact(docs, "text", only).collect()}
    for i, text, iban, after in cases:
        want = [f"iban:5:{5 + len(iban)}"] + [f"iban:{6 + len(iban)}:{len(text)}"] * (" GB82" in after)
        assert [s for s in spans[i].split(",") if s.startswith("iban")] == want, text
        assert texts[i] == "iban [IBAN]" + (" [IBAN]" if " GB82" in after else after), text


def test_card_of_three_groups_beside_digits(spark):
    cards = ("3782 822463 10005", "3714-496353-98431", "3056 930902 5904")
    rows = [(i, f"no {card} 12 {card}x") for i, card in enumerate(cards)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    for r in pii.find_pii(docs).collect():
        n = len(cards[r.doc_id])
        assert f"card:3:{3 + n}" in r.spans.split(","), rows[r.doc_id]
    assert all(r.text.startswith("no [CARD] 12 [CARD]") for r in pii.redact(docs, "text").collect())
