import pytest
from helpers import documents

from panelcast.llm import language_id as l

WORDS = {
    "en": "the of and to in that is was for with as his they at be this from have or by one had not but what all were when".split(),
    "fr": "le de un être et à il avoir ne je son que se qui ce dans en du elle au pour pas vous par sur faire plus dire me on mon".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie".split(),
}


def text(lang, n, seed):
    return " ".join(WORDS[lang][(seed * 7 + i * i) % len(WORDS[lang])] for i in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, text(lang, 60, i), lang) for i, lang in enumerate(list(WORDS) * 30)] + [(900, None, "en"), (901, "x", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def run(spark, docs, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, lang string, share string")
    return {r["page_id"]: r for r in l.identify(pages, docs).collect()}


def page(i, url, lang, n, declared=None):
    head = f'<html lang="{declared}">' if declared else "<html>"
    return (i, url, f"<!DOCTYPE html>{head}<style>.a{{b:c}}</style><p>{text(lang, n, i)}</p></html>", "zz", "s")


def test_text_alone(spark, docs):
    got = run(spark, docs, [page(i, f"http://h{i}.example.com/", lang, 40) for i, lang in enumerate(list(WORDS) * 20)])
    assert all(got[i]["lang"] == lang and got[i]["probability"] > 0.9 for i, lang in enumerate(list(WORDS) * 20))


def test_evidence_decides_short_pages(spark, docs):
    rows = [page(i, "http://fr-host.example.fr/", "fr", 40, "fr") for i in range(40)]
    rows += [page(100 + i, "http://de-host.example.de/", "de", 40, "de") for i in range(40)]
    rows += [(200, "http://fr-host.example.fr/", "", None, None), (201, "http://new.other.de/", "", None, None)]
    rows += [(202, "http://new.nowhere.org/", '<html lang="fr"></html>', None, None), (203, None, None, None, None)]
    got = run(spark, docs, rows)
    assert [got[i]["lang"] for i in (200, 201, 202)] == ["fr", "de", "fr"]
    assert got[203]["text_lang"] is None and got[203]["declared"] is None and got[203]["host"] is None
    assert all(r["probability"] == pytest.approx(max(r["posterior"].values())) for r in got.values())
    assert all(sum(r["posterior"].values()) == pytest.approx(1) for r in got.values())


def test_text_beats_a_wrong_declaration(spark, docs):
    rows = [page(i, f"http://h{i % 3}.example.com/", "en", 50, "en") for i in range(30)] + [page(99, "http://h1.example.com/", "de", 50, "en")]
    assert run(spark, docs, rows)[99]["lang"] == "de"


def test_parsing():
    assert l.declared_language("<HTML xml:lang='pt-BR' dir=ltr>") == "pt"
    assert l.declared_language('<html><meta http-equiv="Content-Language" content="es, en">') == "es"
    assert l.declared_language('<html hreflang="xx">') == "" and l.declared_language(None) == ""
    assert l.address_parts("https://a.b.co.uk:80/x") == ("a.b.co.uk", "co.uk", "uk")
    assert l.address_parts(None) == l.address_parts("http://[bad") == ("", "", "")
    assert l.visible_text("<script>var t='</p>';</script>a<!-- x -->b&amp;<p title='y'>c").split() == ["a", "b&", "c"]


def test_no_labels_no_pages_and_repeats(spark, docs):
    none = run(spark, docs.where("false"), [page(1, "http://a.b/", "en", 5)])
    assert (none[1]["lang"], none[1]["probability"]) == ("und", 1.0)
    pages = spark.createDataFrame([page(1, "http://a.b/", "en", 30)] * 2, "page_id long, url string, html string, lang string, share string")
    assert l.identify(pages, docs).count() == 2
    assert l.identify(pages.where("false"), docs).count() == 0
    assert l.identify(pages, documents(spark, ["the and of"] * 3)).first()["lang"] == "en"


def test_hostile_pages_take_one_pass():
    import time

    for part in ("<meta name=language ", "<", "<!--", "<html ", "<script", "a" * 9, " lang", "<meta a=\"", "&", "<style>x</style"):
        page = part * (1_000_000 // len(part))
        began = time.process_time()
        l.declared_language(page), l.visible_text(page)
        assert time.process_time() - began < 5, part


def test_declared_languages_in_any_order_of_attributes():
    pages = {
        "<html lang='fr-CA'>": "fr", '<HTML xml:lang="de">': "de", "<html><meta name=language content=en>": "en",
        '<meta content="es-MX" http-equiv="Content-Language">': "es", "<meta name='author' content='fr'>": "", "<html lang=''><meta name=language content=it>": "it",
        "<html data-lang=fr>": "", None: "", "": "",
    }
    assert {p: l.declared_language(p) for p in pages} == pages


def test_hidden_parts():
    page = "a<!-- b --> c <script>d</script > e<style>f</style> g <!-- open <b>h</b>"
    assert l.visible_text(page).split()[:4] == ["a", "c", "e", "g"] and "h" in l.visible_text(page)
