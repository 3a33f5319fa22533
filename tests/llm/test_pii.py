"""Patterns against the plain regular expressions, and the field against enumeration."""

import hashlib
import itertools
import random
import re

import numpy as np

from queuelens.llm import pii
from tests.helpers import rows

# The patterns as they are specified.
PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", "[0-9]([\x20-]?[0-9])+"),
    ("phone", "\\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0


def fits(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {"email": True, "ip": all(int(p) <= 255 for p in text.split(".")) if kind == "ip" else True,
            "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def plain_spans(text):
    return [(kind, *m.span()) for kind, p in PLAIN for m in re.finditer(p, text) if fits(kind, m[0])]


def base_of(text):
    found, _ = pii.base_spans(text)
    return [(kind, a, b) for kind, spans in zip(pii.KINDS, found) for a, b in spans]


def test_base_spans_are_the_plain_ones():
    odd = ["", "a@b", "a@b.c", "x a.b@c.d@e.f.g h", "@@a@b.cc@d.e", "1.2.3.4.5.6.7.8.9", "256.1.1.1 255.0.0.255",
           "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111 4111111111111111", "+1 (800) 555-0100.",
           "++1 23456789 ", "+1", "00.0.0.00000001", "1" * 4000 + ".1.1.1", "٣.1.1.1.1", "é@x.y +49 30-123456 7"]
    r = random.Random(2)
    odd += ["".join(r.choice("a1.@- +()9") for _ in range(r.randrange(60))) for _ in range(3000)]
    for text in odd:
        assert base_of(text) == plain_spans(text), text


def test_beliefs_are_exact_on_trees_and_close_on_loops():
    rng = np.random.default_rng(1)
    for loop in (False, True):
        for _ in range(10):
            n = 6
            edges = np.array([(i, i + 1) for i in range(n - 1)] + ([(0, n - 1)] if loop else []))
            unary, coupling = rng.normal(0, 1.5, n), rng.uniform(0.1, 0.5, len(edges))
            odds = np.zeros((n, 2))
            for labels in itertools.product((-1, 1), repeat=n):
                y = np.array(labels)
                weight = np.exp(unary @ y / 2 + coupling @ (y[edges[:, 0]] * y[edges[:, 1]]))
                odds[np.arange(n), (y + 1) // 2] += weight
            exact = np.log(odds[:, 1] / odds[:, 0])
            assert np.abs(pii.beliefs(unary, edges, coupling) - exact).max() < (0.5 if loop else 1e-3)


WEIGHTS = pii.Weights(np.append(np.zeros(pii.FEATURES), -4.0), 1.0, 2.5)


def test_a_distant_repeat_takes_the_label():
    text = "write to marlowe.7@mail.example.org " + "filler words here " * 50 + "and Marlowe, answered"
    added = [text[a:b] for kind, a, b in pii.spans_of(text, WEIGHTS) if kind == pii.ADDED]
    assert added == ["Marlowe"]
    common = "ask the.7@mail.example.org " + "the cat and the dog saw the house of the man " * 20
    assert [s for s in pii.spans_of(common, WEIGHTS) if s[0] == pii.ADDED] == []
    assert pii.spans_of("no data at all, Marlowe", WEIGHTS) == []


def test_any_number_of_repeats_is_found():
    for coupling in pii.COUPLING:
        weights = pii.Weights(WEIGHTS.unary, 1.0, coupling)
        for n, addresses in itertools.product((1, 2, 3, 5, 50), (1, 2)):
            mail = "write to marlowe.7@mail.example.org "
            first = mail * addresses + "filler words here Marlowe " * n
            amid = "Marlowe spoke here " * (n - n // 2) + mail * addresses + "filler words here Marlowe " * (n // 2)
            for text in (first, amid):
                spans = pii.spans_of(text, weights)
                assert [text[a:b] for kind, a, b in spans if kind == pii.ADDED] == ["Marlowe"] * n, (coupling, n, text)


def test_common_words_are_told_by_the_corpus(spark):
    texts = [f"the painter number x{i} met another painter" for i in range(20)]
    texts += ["ask painter@mail.example.org or tulkin@mail.example.org, painter to Tulkin, painter to Tulkin"] * 30
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    weights = pii.fit(docs)
    assert "painter" in weights.common and "tulkin" not in weights.common
    added = [texts[-1][a:b] for kind, a, b in pii.spans_of(texts[-1], weights) if kind == pii.ADDED]
    assert added == ["Tulkin"] * 2


def test_every_document_is_counted(spark):
    """Of 30,000 texts a share of 150 makes a key common, 149 do not; copies of them do not count."""
    edge = "substring('abcdefghijkl', 1 + id % 200, 1)"
    docs = spark.range(30_000).selectExpr("id AS doc_id", f"""concat('row ', id, CASE
        WHEN id % 200 < 6 THEN concat(' painter', {edge})
        WHEN id % 200 < 12 AND id >= 200 THEN concat(' tulkin', {edge}) ELSE '' END) AS text""")
    copies = docs.where("text LIKE '%tulkin%' AND doc_id % 3 < 2")
    common = pii.fit(docs.union(copies).union(copies.where("doc_id % 3 = 0"))).common
    assert {k for k in common if k.startswith(("painter", "tulkin"))} == {f"painter{c}" for c in "abcdef"}


DOCS = [(1, "mail a.b@c.de or +1 (800) 555-0100, card 4111 1111 1111 1111 from 10.0.0.1"), (2, None), (3, ""),
        (4, "nothing here"), (4, "nothing here"), (None, "x@y.zz"), (5, "word " * 20_000 + "q@r.st")]


def test_query_columns(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string").selectExpr("*", "3 AS n_email", "'' AS spans")
    found = rows(pii.find(docs), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    expected = []
    for doc, text in DOCS:
        spans = plain_spans(text or "")
        joined = ",".join("%s:%d:%d" % s for s in spans)
        expected.append((doc, *(sum(s[0] == k for s in spans) for k in pii.KINDS),
                         hashlib.sha256(joined.encode()).hexdigest()))
    assert found == sorted(expected, key=lambda r: [(v is not None, str(v)) for v in r])
    assert pii.find(docs.limit(0)).count() == 0


def test_masking(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string").selectExpr("*", "length(text) AS n_chars")
    found = {r.doc_id: r for r in pii.masked(docs).collect()}
    assert found[1].text == "mail [EMAIL] or [PHONE], card [CARD] from [IP]"
    assert found[1].n_chars == len(found[1].text) and found[2].text is None and found[4].text == "nothing here"
    assert pii.mask("abcdef", [("a", 1, 4), ("b", 2, 5)]) == "a[A]f"
