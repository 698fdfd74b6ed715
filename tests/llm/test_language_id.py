import pytest
from pyspark.sql import functions as F

from medstrata.llm import language_id as li
from tests.llm.helpers import HARD_TEXTS, documents, empty, with_clashes

SAMPLES = {
    "en": "the weather was cold and the children stayed in the house while their father went out to look for wood",
    "fr": "le temps était froid et les enfants restaient dans la maison pendant que leur père cherchait du bois",
    "de": "das wetter war kalt und die kinder blieben im haus während ihr vater draußen nach holz suchte",
}


def corpus():
    out = []
    for n, (lang, text) in enumerate(SAMPLES.items()):
        words = text.split()
        for i in range(120):
            out.append((n * 1000 + i, " ".join(words[(i * 7 + j * 3) % len(words)] for j in range(6 + i % 9)), lang, f"https://www{i % 3}.site-{lang}.{'org' if lang == 'en' else lang}/p/{i}"))
    return out


def test_languages_are_found_and_clean_rows_kept(spark):
    rows = corpus()
    wrong = {0, 1000, 2000}  # their declaration is wrong; the text says otherwise
    told = [(i, t, ("fr" if lang == "en" else "en") if i in wrong else lang, s) for i, t, lang, s in rows]
    out, (lang, posterior, accepted) = li.identify(with_clashes(documents(spark, told), "guess", "posterior", "host"))
    found = {r["doc_id"]: r for r in out.collect()}
    truth = {i: lang for i, _, lang, _ in rows}
    assert sum(found[i][lang] == truth[i] for i in truth) / len(truth) >= 0.99
    assert all(r[accepted] for r in found.values())
    assert all(0 <= r[posterior] <= 1 for r in found.values()) and posterior == "_posterior"


def test_host_and_declaration_decide_what_the_text_does_not(spark):
    letters = li.fit(documents(spark, corpus()))
    hosts = corpus() + [(9000, "on", None, "https://www1.site-fr.fr/x"), (9001, "on", "en", "https://www1.site-en.org/x"), (9002, "on", None, "https://new.site-de.de/x")]
    out, (lang, *_) = li.identify(documents(spark, hosts), letters=letters)
    found = {r["doc_id"]: r[lang] for r in out.collect()}
    assert found[9000] == "fr" and found[9001] == "en" and found[9002] == "de"


def test_not_a_language(spark):
    letters = li.fit(documents(spark, corpus()))
    odd = [(1, t, None, None) for t in (None, "", "  ", "123 456", "!!! ???")] + [(2, "qzxqj wvkqx zzkqj xqzvw kjqxz " * 20, None, None)]
    out, (*_, accepted) = li.identify(documents(spark, odd), letters=letters)
    assert [r[accepted] for r in out.collect()] == [False] * 6


def _hosts():
    spark_rows = [("https://u:p@M.A.example.COM:80/x?y#z", "m.a.example.com"), ("src8", "src8"), (None, ""), ("", ""), ("ftp://h", "h"), ("://x", ""), ("a://", "")]
    return spark_rows


@pytest.mark.parametrize("address, host", _hosts())
def test_host_of(spark, address, host):
    df = spark.createDataFrame([(address,)], "a string")
    assert df.select(li.host_of(F.col("a"))).first()[0] == host


def test_edge_cases(spark):
    docs = documents(spark, [(None, t) for t in HARD_TEXTS])
    out, (lang, posterior, accepted) = li.identify(docs)  # not a label in the table
    assert out.count() == len(HARD_TEXTS) and not any(r[accepted] for r in out.collect())
    some = documents(spark, [*corpus(), *[(None, t) for t in HARD_TEXTS], *corpus()[:3]])
    assert li.op9_query(some).count() == 363 + len(HARD_TEXTS)
    assert li.identify(empty(spark))[0].count() == 0 and li.op9_query(empty(spark)).count() == 0


def test_columns_that_bear_names_of_helpers_stay(spark):
    names = ["_host", "_logs", "_all", "_suffix", "_domain", "_said", "_top", "_sum", "of_host", "of_said", "counts", "domain", "likelihoods", "detected_lang"]
    docs = documents(spark, corpus())
    plain, (lang, posterior, accepted) = li.identify(docs)
    found, (own_lang, own_posterior, own_accepted) = li.identify(with_clashes(docs, *names))
    assert own_lang == "_detected_lang" and set(names) < set(found.columns)
    rows = found.collect()
    assert all(r[name] == "own" for r in rows for name in names)
    judged = {r["doc_id"]: (r[lang], r[accepted], pytest.approx(r[posterior])) for r in plain.collect()}
    assert {r["doc_id"]: (r[own_lang], r[own_accepted], r[own_posterior]) for r in rows} == judged
