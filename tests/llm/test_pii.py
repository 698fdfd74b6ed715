import hashlib
import random
import re

from pyspark.sql import functions as F

from medstrata.llm.pii import BASE, find, joined, luhn, mod_97, op11_query
from tests.helpers import plan
from tests.llm.helpers import HARD_TEXTS, documents, empty, prose, with_clashes

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ORDER = ["email", "ip", "card", "phone", "iban", "ssn", "local_phone"]


def luhn_by_hand(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn_by_hand(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def base_by_hand(text):
    found = [(m.start(), ORDER.index(k), k, m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if passes(k, m[0])]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


def hostile(seed, count=60):
    chance = random.Random(seed)
    parts = ["a", "b.c", "@", ".", "-", "+", "_", "%", "é", "😀", " ", "  ", "\n", "(", ")", "1", "25", "256", "0", "4111111111111111", "4111 1111 1111 1111",
             "5500-0000-0000-0004", "10.0.0.1", "1.2.3", "0001.2.3.255", "x@y.z", "a@b.c_d@e.f", "+1 (906) 555-7962", "+49", "123-45-6789", "ip", "phone ", "\x00"]
    return "".join(chance.choice(parts) for _ in range(chance.randint(1, count)))


def spans_by_id(df):
    out, spans = find(df)
    return {r[0]: r[1].split(",") if r[1] else [] for r in out.select("doc_id", joined(F.col(f"`{spans}`"))).collect()}


def test_base_spans_equal_plain_patterns(spark):
    texts = [hostile(i) for i in range(600)] + HARD_TEXTS + [
        "9" * 30000, "1." * 20000, "a@" + "b." * 20000 + "c", "x" * 40000, "4 " * 30000, "+1 " * 9000, "a.b" * 9000 + "@", "1-2" * 9000,
        "4111111111111111", " 4111111111111111 ", "41111111111111112", "1-4111111111111111", "4111111111111111-", "4111111111111111  5",
        "999.1.2.3.4", "1.2.3.4.5.6.7.8", "a@b", "a@b.", "a@b.c.", "é a@b.cd 😀 +1 555 123 4567 é",
    ]
    found = spans_by_id(documents(spark, list(enumerate(texts))))
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        base = [s for s in found[i] if s.split(":")[0] in PLAIN]
        assert base == base_by_hand(text), repr(text)[:200]


def test_many_spans_in_one_text(spark):
    text = " ".join(f"u{i}@host{i % 7}.example.org é" for i in range(6000))
    assert spans_by_id(documents(spark, [(1, text)]))[1] == base_by_hand(text)


ADDED_CASES = [
    ("pay to DE89 3704 0044 0532 0130 00 today", ["iban:7:34"]),
    ("GB82WEST12345698765432", ["iban:0:22"]),
    ("GB82WEST12345698765433", []),  # fails mod 97
    ("xGB82WEST12345698765432", []),  # within a word
    ("SSN: 123-45-6789.", ["ssn:5:16"]),
    ("number 123-45-6789", []),  # no word beside it tells what it is
    ("ssn 000-45-6789 or 1123-45-6789 or 123-45-6789-1", []),
    ("call me: (906) 555-7962 now", ["local_phone:9:23"]),
    ("on 906 555 7962", []),
    ("call +1 906 555 7962", ["phone:5:20"]),  # the added span lies within the base one
    ("é tel. 906-555-7962", ["local_phone:7:19"]),
]


def test_added_spans(spark):
    found = spans_by_id(documents(spark, [(i, text) for i, (text, _) in enumerate(ADDED_CASES)]))
    assert [found[i] for i in range(len(ADDED_CASES))] == [expected for _, expected in ADDED_CASES]


def test_words_beside_raise_the_score(spark):
    out, spans = find(documents(spark, [(1, "server 10.0.0.1"), (2, "version 10.0.0.1"), (3, "server " + "x" * 50 + " 10.0.0.1")]))
    scores = {r["doc_id"]: r[spans][0]["score"] for r in out.collect()}
    assert scores == {1: 1.0, 2: 0.6, 3: 0.6}


def test_checks(spark):
    numbers = ["4111 1111 1111 1111", "4111111111111112", "79927398713", "0"]
    df = spark.createDataFrame([(n,) for n in numbers], "n string")
    assert [r[0] for r in df.select(luhn(F.col("n"))).collect()] == [luhn_by_hand(n.replace(" ", "")) for n in numbers]
    accounts = ["DE89370400440532013000", "FR14 2004 1010 0505 0001 3M02 606", "DE88370400440532013000"]
    df = spark.createDataFrame([(n,) for n in accounts], "n string")
    assert [r[0] for r in df.select(mod_97(F.col("n"))).collect()] == [True, True, False]


def test_edge_cases(spark):
    docs = documents(spark, [(None, "a@b.cd"), (1, None), (2, ""), (3, "a@b.cd"), (3, "a@b.cd")])
    out, spans = find(with_clashes(docs, "Spans", "kind", "start"))
    assert len(out.collect()) == 5 and "Spans" in out.columns and spans not in docs.columns
    assert sorted(len(r[spans]) for r in out.collect()) == [0, 0, 1, 1, 1]
    assert find(empty(spark))[0].count() == 0


def test_query(spark):
    texts = [hostile(i, 30) for i in range(1000, 1100)] + [prose(3, 500), None]
    for r in op11_query(documents(spark, list(enumerate(texts)))).collect():
        base = base_by_hand(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        for kind in BASE:
            assert r[f"n_{kind.name}"] == sum(s.startswith(kind.name) for s in base)
        assert set(base) <= set(r["spans"].split(",")) or not base


def test_stays_native(spark):
    assert not re.search("Python|Pandas|Arrow|Exchange", plan(op11_query(documents(spark, [(1, "a")]))).replace("Scan", ""))
