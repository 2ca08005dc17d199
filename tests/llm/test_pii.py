import datetime

from helpers import docs, table
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkcivic.llm import pii

P = pii.Permutation(b"key")
VALUES = ["4111 1111 1111 1111", "4485275742308327", "378282246310005", "+1 (499) 555-6503", "+44 20 7946 0958", "(415) 555-2671",
          "415-555-2671", "123-45-6789", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "169.122.221.182", "0.0.0.0",
          "1999-02-28", "2000-02-29", "31.12.1999", "12/25/2001", "03/04/2001", "the.72@mail3.example.com", "A.B@X.CO.UK"]
PLAIN = ["4111 1111 1111 1112", "1.2.3", "CC BY 4.0.", "10.0.0.256", "2001-13-01", "30.02.2000", "000-12-3456", "12345678",
         "DE89370400440532013001", "a @ b", "x@y", "1.2.3.4.5", "2024", "version 3, 2 of 4"]


def test_values_change_within_their_format_and_back():
    for v in VALUES:
        text = f"Say {v}, then\n({v})"
        new, found = pii.replace(text, P)
        assert len(found) == 2 and all(text[a:b] == v for _, a, b in found), v
        assert new != text and pii.replace(new, P, back=True)[0] == text
        one = pii.replace(v, P)[0]
        assert new.count(one) == 2 and v not in new  # equal values stay linked
        again = pii.replace(one, P)[1]
        assert [k for k, *_ in again] == [found[0][0]]  # still valid in its format


FOLLOWED = ["+1 (826) 555-4081", "+1 499 555 6503", "+44 20 7946 0958", "+44 (0)20 7946 0958", "+999 20 7946 0958 12", "BE68 5390 0754 7034",
            "ES91 2100 0418 4502 0005 1332", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "(415) 555-2671",
            "4111 1111 1111 1111", "123-45-6789"]
AFTER = ["2024", "12", "190.137.223.204", "10.0.0.1", "2001-02-03", "31.12.1999", "BIC", "I", "SWIFT AG", "ABCD 1234", "4111 1111 1111 1111",
         "+1 (826) 555-4081", "x"]


def test_values_followed_by_others_are_found_and_stay_linked():
    for v in FOLLOWED:
        alone, found = pii.replace(v, P)
        assert len(found) == 1, v
        for after in AFTER:
            text = f"Say {v} {after}"
            new, spans = pii.replace(text, P)
            own, others = pii.replace(after, P)
            assert spans[0] == (found[0][0], 4, 4 + len(v)) and len(spans) == 1 + len(others), (v, after)
            assert new == f"Say {alone} {own}" and pii.replace(new, P, back=True)[0] == text, (v, after)


def test_a_number_before_a_card():
    new, found = pii.replace("In 2024 4111 1111 1111 1111 and 12 378282246310005.", P)
    assert [k for k, *_ in found] == ["card", "card"] and "4111" not in new


def test_clean_texts_stay():
    for v in PLAIN + [None and ""]:
        if v:
            assert pii.replace(v, P) == (v, []), v


@settings(max_examples=300)
@given(st.integers(2, 10 ** 40), st.integers(0, 10 ** 40))
def test_permutation_is_invertible(size, value):
    value %= size
    new = P("x", size, value)
    assert 0 <= new < size and P("x", size, new, back=True) == value


def test_permutation_is_one_to_one_on_small_formats():
    for size in (1, 2, 3, 7, 100, 365):
        assert sorted(P("s", size, v) for v in range(size)) == list(range(size))
    days = {pii.date(P, (datetime.date(2001, 1, 13) + datetime.timedelta(d)).isoformat(), False) for d in range(400)}
    assert len(days) == 400


def test_another_key_gives_other_values():
    assert pii.replace(VALUES[1], P)[0] != pii.replace(VALUES[1], pii.Permutation(b"other"))[0]


def test_rows(spark):
    texts = [None, "", VALUES[1], VALUES[1], "x" * 500_000 + "@", "a@" * 50_000, "9" * 100_000, (None, VALUES[0])]
    df = docs(spark, texts, clash=True)
    got = pii.pseudonymise(df, "key").collect()
    assert len(got) == len(texts) and set(got[0].asDict()) == set(df.columns)
    by = {r["doc_id"]: r for r in got}
    assert by[0]["text"] is None and by[1]["text"] == "" and by[2]["text"] == by[3]["text"] != VALUES[1]
    assert by[4]["text"] == texts[4] and by[6]["text"] == texts[6] and by[None]["text"] == pii.replace(VALUES[0], P)[0]
    back = pii.pseudonymise(pii.pseudonymise(df, "key"), "key", back=True).collect()
    assert [r["text"] for r in back] == [r["text"] for r in df.collect()]
    assert pii.pseudonymise(df.limit(0), "key").count() == 0


def test_documents_round_trip():
    for r in table("documents"):
        new, found = pii.replace(r["text"] or "", P)
        assert pii.replace(new, P, back=True)[0] == (r["text"] or "")
        assert all((r["text"][a:b] not in new) for _, a, b in found)


def day_of(text):
    a, b, c = (int(x) for x in text.replace("/", "-").replace(".", "-").split("-"))
    return datetime.date(a, b, c) if a > 31 else datetime.date(c, b, a) if b <= 12 else datetime.date(c, a, b)


def test_a_day_is_linked_across_notations_and_keeps_its_own():
    for day in (datetime.date(1900, 1, 1) + datetime.timedelta(n) for n in range(0, 73049, 97)):
        forms = [f"{day:%Y-%m-%d}", f"{day:%d/%m/%Y}", f"{day.day}.{day.month}.{day.year}", f"{day.year}/{day.month}/{day.day}"]
        forms += [f"{day:%m/%d/%Y}", f"{day.month}-{day.day}-{day.year}"] if day.day > 12 else []
        new = [pii.replace(f, P)[0] for f in forms]
        assert len({day_of(n) for n in new}) == 1, day
        assert [pii.replace(n, P, back=True)[0] for n in new] == forms
        assert [[len(x) for x in n.replace("/", "-").replace(".", "-").split("-")] for n in new] == \
            [[len(x) for x in f.replace("/", "-").replace(".", "-").split("-")] for f in forms]


def test_new_days_are_one_to_one():
    assert len({pii._new_day(P, d, False) for d in range(0, 4000)}) == 4000


def test_phones_are_linked_with_and_without_their_country_code():
    forms = ["826-555-4081", "(826) 555-4081", "+1 826 555-4081", "+1 (826) 555-4081", "+18265554081", "826.555.4081"]
    new = [pii.replace(f, P)[0] for f in forms]
    assert len({"".join(c for c in n if c.isdigit())[-10:] for n in new}) == 1 and "8265554081" not in new[4]
    assert [pii.replace(n, P, back=True)[0] for n in new] == forms
