import hashlib
import random
import re
import time
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from logstow.llm.pii import Disclosure, pii, sanitise

from .conftest import by_id

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return True


def brute(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text or "")
        if holds(kind, m.group())
    ]


def digest(text):
    return hashlib.sha256(",".join(brute(text)).encode()).hexdigest()


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii(df).collect()}
    for i, text in enumerate(texts):
        assert got[i].base_sha256 == digest(text), text
        n = [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone]
        assert n == [sum(s.startswith(k) for s in brute(text)) for k in PLAIN]


@settings(max_examples=3, deadline=None)
@given(
    st.lists(
        st.text("ab1.@-+ 5(%\né", max_size=50) | st.text("0123456789 -", max_size=45),
        min_size=150, max_size=150,
    )
)
def test_patterns_against_plain_ones(spark, texts):
    check(spark, texts)


def test_known_cases(spark):
    check(spark, [
        "a@b.com_x@y.org", "4111 1111 1111 1111 5", "4111-1111-1111-1111", "1.2.3.4.5.6.7.8",
        "+1 (499) 555-6503-", "0000001.2.3.4", "4111111111111111  4111-1111-1111-1111",
        None, "", "256.1.1.1 255.255.255.255", "é 😀 x@y.zz", "+12345678" * 30, "1" * 20000,
        "a" * 20000 + "@",
    ])


def test_awkward_rows(awkward, nothing):
    got = pii(awkward).select("doc_id", "base_sha256").collect()
    assert by_id(got) == by_id((r.doc_id, digest(r.text)) for r in awkward.collect())
    assert pii(nothing).collect() == [] and sanitise(nothing).collect() == []


def test_disclosing_terms_go_and_others_stay(spark):
    near = [(i, f"hello contact Zebulon 77777 at zeb@x.org today {i}\nmore today") for i in range(5)]
    plain = [(10 + i, f"hello contact number {i} today more") for i in range(60)]
    df = spark.createDataFrame(near + plain, "doc_id long, text string")
    out = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert out[0] == "hello contact  [NUMBER] at [EMAIL] today 0\nmore today"
    assert all(out[i] == t for i, t in plain)
    strict = {r.doc_id: r.text for r in sanitise(df, Disclosure(share=1.01)).collect()}
    assert strict[0].startswith("hello contact Zebulon 77777 at [EMAIL]")


def test_copies_are_no_evidence(spark):
    same = [(i, "the rare Zebulon wrote to zeb@x.org") for i in range(50)]
    other = [(100 + i, f"the text number {i}") for i in range(50)]
    df = spark.createDataFrame(same + other, "doc_id long, text string")
    assert all(r.n_term == 0 for r in pii(df).collect())


def test_sanitised_rows_keep_their_columns(awkward, spark):
    out = sanitise(awkward)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    df = spark.createDataFrame([(1, "mail a@b.cc, +1 (499) 555-6503 and 1.2.3.4", 99)], "doc_id long, text string, n_chars int")
    assert sanitise(df).first() == (1, "mail [EMAIL], [PHONE] and [IP]", 30)


WORDS = r"[^\W_]{3,}"


def pieces_of(text, size):
    return re.findall(rf"[^\n]{{1,{size}}}(?![^\x20\n])|[^\n]{{1,{size}}}", text or "")


def words_of(text):
    return set(re.findall(WORDS, text.lower()))


def terms_of(text):
    for kind, pattern in PLAIN.items():
        if kind == "card":
            pattern = r"[0-9]([\x20-]?[0-9]){15,}"
        text = re.sub(pattern, " ", text)
    return words_of(text)


def entities_of(piece):
    found = set()
    for span in brute(piece):
        kind, start, stop = span.split(":")
        value = piece[int(start) : int(stop)].lower()
        found.add((kind, re.sub("[^0-9]", "", value) if kind in ("card", "phone") else value))
    return found


def plain_term_spans(texts, share, size):
    """The rule over lists: every entity against every term of its contexts."""
    cut = [pieces_of(t, size) for t in texts]
    n, n_e, n_t, met = 0, Counter(), Counter(), Counter()
    different = {}
    for pieces in cut:
        for i, piece in enumerate(pieces):
            n += 1
            n_t.update(terms_of(piece))
            context = "\n".join(pieces[max(i - 1, 0) : i + 2])
            for e in entities_of(piece):
                n_e[e] += 1
                for t in terms_of(context):
                    met[e, t] += 1
                    different.setdefault((e, t), set()).add(context)
    flagged = set()
    for (e, t), n_et in met.items():
        d = len(different[e, t])
        p = min(n_et / n_t[t], 1.0) * d / (d + 1)
        if n_e[e] < n and p > (n_e[e] / n) ** (1 - share):
            flagged.add(t)
    out = []
    for text in texts:
        masked = list(text or "")
        for span in brute(text):
            _, start, stop = span.split(":")
            masked[int(start) : int(stop)] = " " * (int(stop) - int(start))
        words = re.finditer(WORDS, "".join(masked))
        out.append([f"term:{m.start()}:{m.end()}" for m in words if m.group().lower() in flagged])
    return out


def check_terms(spark, texts, share, size):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii(df, Disclosure(share, size)).collect()}
    want = plain_term_spans(texts, share, size)
    for i, text in enumerate(texts):
        assert got[i] == ",".join(brute(text) + want[i]), text
    return sum(map(len, want))


def test_term_spans_against_plain_ones(spark):
    draw = random.Random(7)
    names = ["Kim", "Zebulon", "Ada", "Grace", "Lin", "Oskar"]
    common = ["the", "and", "mail", "call", "today", "about", "é", "1.2.3.999"]
    texts = [None, "", "\n\n", "zeb@x.orgéé Kim 1.2.3.4@x.yz Kim", "x" * 300]
    for _ in range(250):
        name = draw.choice(names)
        found = [f"{name} {name.lower()}@x.org", "+49 (30) 1234567", f"{name.upper()}: {name.lower()}@x.org"]
        words = draw.choices(common, k=draw.randint(2, 40)) + draw.choices(found, k=draw.randint(0, 3))
        words += [f"w{draw.randint(0, 400)}"]
        draw.shuffle(words)
        texts.append("".join(w + draw.choice([" ", " ", " ", ", ", "\n"]) for w in words))
    assert check_terms(spark, texts, 0.9, 40) > 50
    assert check_terms(spark, texts, 0.6, 500) > 50


def test_terms_of_given_tables(spark, small):
    rows = sorted((r.doc_id, r.text) for r in small.collect())
    assert check_terms(spark, [text for _, text in rows], 0.9, 500) > 0


def test_terms_go_in_every_document_and_from_the_next_line(spark):
    signed = [(i, f"Kim Abelard\nkim@x.org\nletter number {i}") for i in range(12)]
    alone = [(15, "we met Abelard in the garden")]
    plain = [(20 + i, f"a letter about garden number {i}") for i in range(60)]
    df = spark.createDataFrame(signed + alone + plain, "doc_id long, text string")
    out = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert out[0] == " \n[EMAIL]\nletter number 0"
    assert out[15] == "we met  in the garden"
    assert all(out[i] == t for i, t in plain)


def test_very_many_matches(spark):
    many = "".join(f"é{i} a{i}@b.cc 1.2.3.4 x\n" for i in range(50_000))
    df = spark.createDataFrame([(1, many), (2, "é5 plain")], "doc_id long, text string")
    begun = time.monotonic()
    row = pii(df, Disclosure(share=1.01)).filter("doc_id = 1").first()
    assert row.n_email == 50_000 and row.n_ip == 50_000 and row.base_sha256 == digest(many)
    out = sanitise(df, Disclosure(share=1.01)).filter("doc_id = 1").first().text
    assert out == re.sub(r"a[0-9]+@b\.cc 1\.2\.3\.4", "[EMAIL] [IP]", many)
    assert time.monotonic() - begun < 120
