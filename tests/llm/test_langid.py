import zlib

from llm_frames import documents
from sparkgate.llm import langid

WORDS = {
    "en": "the of and that with this from have which their would there other because through",
    "de": "der die und nicht auch eine werden zwischen schon gegen durch weil über ungefähr",
    "nl": "het een van niet ook worden tussen tegen door omdat ongeveer zijn heeft deze",
    "fr": "les des une dans pour avec cette mais leurs parce après être toujours même",
    "es": "los las una para con esta pero porque después siempre también según entre",
    "zz": "qxq xqx zqz qzqz xzx zxz qxz xqz zqx qqx xxz zzq",
}


def made(spark, n=400):
    rows, langs = [], sorted(WORDS)
    for i in range(n):
        lang = langs[i % len(langs)]
        words = WORDS[lang].split()
        rows.append((i, " ".join(words[(i * 7 + j * j) % len(words)] for j in range(12)), lang))
    return rows


def test_families_and_languages_on_held_out_rows(spark):
    rows = made(spark)
    found = {r.doc_id: r for r in langid.languages(documents(spark, rows)).collect()}
    held = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(found[i].held_out for i, _ in held) and len(held) > 50
    assert sum(found[i].lang_pred == lang for i, lang in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values())


def test_held_out_languages_are_not_looked_at(spark):
    rows = made(spark)
    blank = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else g) for i, t, g in rows]
    a = langid.languages(documents(spark, rows)).collect()
    b = langid.languages(documents(spark, blank)).collect()
    assert sorted(a) == sorted(b)


def test_given_rows(given):
    docs = given("documents")
    rows = langid.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_odd_rows(odd, none):
    rows = langid.languages(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    for i in (1, 2, 3, 9):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert all(by_id[i].lang_pred in ("en", "de", "fr", "es") for i in (4, 5, 6, 7, 8, 10, 11))
    assert langid.languages(none).count() == 0


def test_nothing_to_learn_from(spark):
    rows = langid.languages(documents(spark, [(1, "some text", None), (2, None, None)])).collect()
    assert {r.lang_pred for r in rows} == {"und"}


def test_case_and_gaps_do_not_matter():
    assert (langid.grams("Some Text") == langid.grams("some -- 12 text")).all()
    assert langid.grams("1 2 !") is None
