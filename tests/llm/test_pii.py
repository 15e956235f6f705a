import hashlib
import re

import pytest

from trackspark.llm.pii import find_pii, op4_pii, redacted

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def keep(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(x) <= 255 for x in hit.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(digits) <= 15
    return True


def brute(text):
    return [
        (k, m.start(), m.end())
        for k, p in BASE.items()
        for m in re.finditer(p, text or "")
        if keep(k, m.group())
    ]


TEXTS = [
    None,
    "",
    "mail a.b@c.de_f@g.hi and x@y.z.w@q.r, no@host",
    "é 4111 1111 1111 1111 ü 4111-1111-1111-1112 and 4111  1111 1111 1111",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3",
    "+49 (30) 1234-567 +1 2 +123456789012345678 ++44 20 7946 0958",
    "iban DE89 3704 0044 0532 0130 00 and DE89 3704 0044 0532 0130 01, GB82WEST12345698765432",
    "call 555-123-4567 now; order 555-123-4567" + " far away" * 10,
    "call 555-123-4567",
    'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"',
    "9" * 30_000 + " " + "a" * 30_000 + " " + "1-" * 20_000 + "@" + ".a" * 20_000,
    "x@y" + ".z" * 9000 + " " + "4111 1111 1111 1111 " * 300,
]


def test_base_spans_equal_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for row in find_pii(docs).collect():
        base = [(s.kind, s.start, s.end) for s in row.pii if s.kind in BASE]
        assert base == brute(row.text), row.doc_id
        assert all(row.text[s.start : s.end] == s.hit for s in row.pii)


def test_checksum_and_context_decide_on_added_kinds(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    added = {r.doc_id: [(s.kind, s.hit) for s in r.pii if s.kind not in BASE] for r in find_pii(docs).collect()}
    assert added[6] == [("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432")]
    assert added[8] == [("tel", "555-123-4567")] and added[7][0] == ("tel", "555-123-4567")
    assert added[9] == [("secret", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff")]


def test_redaction_and_clashing_columns(spark):
    rows = [(1, "é a@b.cd +49 30 1234567 x", 9, "keep", 1), (1, None, 5, None, 2), (2, "plain", 5, "k", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, pii string, `a.b` int")
    out = redacted(docs)
    assert out.columns == docs.columns
    want = [(1, "é [EMAIL] [PHONE] x", 19, "keep", 1), (1, None, 5, None, 2), (2, "plain", 5, "k", 3)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert redacted(docs.limit(0)).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_on_given_documents(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op4_pii(spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        spans = brute(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in BASE]
        assert r.spans.startswith(joined)


def test_words_after_an_iban_are_not_part_of_it(spark):
    spanish, austrian, polish = "ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "PL61109010140000071219812874"
    german = "DE89 3704 0044 0532 0130 00"
    texts = {
        f"{spanish} BIC": [spanish],
        f"to {austrian} 12 and {polish} EUR": [austrian, polish],
        f"{spanish} {austrian}": [spanish, austrian],
        f"{austrian} {austrian} {german} {spanish} A1": [austrian, austrian, german, spanish],
        f"{german} X": [german],
        "ES91 2100 0418 4502 0005 1333 BIC": [],
    }
    rows = find_pii(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert {r.text: [s.hit for s in r.pii if s.kind == "iban"] for r in rows} == texts
    assert all(r.text[s.start : s.end] == s.hit for r in rows for s in r.pii)
