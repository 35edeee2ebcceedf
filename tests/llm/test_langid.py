import numpy as np

from lucrum.llm import langid


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.fit(docs.where("doc_id % 5 != 0"), max_rows=250)
    rows = docs.where("doc_id % 5 = 0 and length(text) > 200").orderBy("doc_id").select("text", "lang").limit(400).collect()
    right = [model.languages[int(np.argmax(model.posterior(r.text)))] == r.lang for r in rows]
    assert np.mean(right) > 0.95


def docs(spark):
    text = {"en": "the cat and the dog with this thing", "de": "der hund und die katze nicht schön", "fr": "le chien et la voisine être"}
    return spark.createDataFrame([(i, text[k], k) for i, k in enumerate(["en", "de", "fr"] * 20)] + [(99, None, "en"), (None, "x", "de"), (98, "x", None)],
                                 "doc_id long, text string, lang string")


def page(lang, body):
    return f"<html lang='{lang}'><head><title>x</title></head><body><script>the the</script><p>{body}</p></body></html>"


def test_evidence_is_fused(spark):
    model = langid.fit(docs(spark))
    rows = [(i, f"https://h{i % 3}.example.org/de/{i}", page("de", "der hund und die katze")) for i in range(30)]
    rows += [(100, "https://h1.example.org/de/x", page("de", "")), (101, "https://h1.example.org/", "<p></p>"),
             (102, "https://other.example.com/en/", page("de", "the cat and the dog with this thing")),
             (103, None, None), (None, "bad", ""), (103, None, None), (104, "https://h2.example.org/de/1", page("de", "der " * 50_000))]
    out = langid.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()
    assert len(out) == len(rows)
    got = {r.page_id: r for r in out if r.page_id is not None}
    assert all(got[i].lang == "de" for i in range(30)) and got[104].lang == "de"
    assert got[100].lang == "de" and got[100].text_lang is None       # by markup, address and host
    assert got[101].lang == "de"                                      # by its host alone
    assert got[102].lang == "en"                                      # strong text against a wrong declaration
    assert got[103].host is None and got[103].declared is None and got[103].lang == "de"
    assert all(0 < r.confidence <= 1 for r in out)


def brute_prior(rows, me, weight):
    """Smoothed host prior of page ``me`` from (host, posterior) rows."""
    def total(match):
        return sum((p for i, (h, p) in enumerate(rows) if i != me and h is not None and match(h)), np.zeros(len(rows[me][1])))
    top = sum(p for _, p in rows) + 1
    prior = top / top.sum()
    h = rows[me][0]
    if h is None:
        own = [np.zeros(len(prior))] * 3
    else:
        own = [total(lambda x: x.split(".")[-1] == h.split(".")[-1]), total(lambda x: x.split(".")[-2:] == h.split(".")[-2:]), total(lambda x: x == h)]
    for sums, w in zip(own, weight):
        prior = (sums + w * prior) / (sums.sum() + w)
    return prior


def test_priors_equal_brute_force(spark):
    """Pages without declaration or address code: text times prior."""
    model = langid.fit(docs(spark))
    bodies = ["der hund", "the cat and", "le chien et la", "the", "x", ""]
    hosts = ["a.example.org", "b.example.org", "c.example.com", "a.example.org", None]
    rows = [(i, hosts[i % 5] and f"https://{hosts[i % 5]}/page/{i}", f"<p>{bodies[i % 6]}</p>") for i in range(40)]
    out = {r.page_id: r for r in langid.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()}
    known = [(hosts[i % 5], model.posterior(bodies[i % 6])) for i in range(40)]
    weights = [langid.SMOOTH[k] for k in ("tld", "domain", "host")]
    for i in range(40):
        p = known[i][1] * brute_prior(known, i, weights)
        assert out[i].lang == model.languages[int(np.argmax(p))]
        assert np.isclose(out[i].confidence, p.max() / p.sum(), rtol=1e-6)


def test_rare_languages_have_models(spark):
    """Two documents among a thousand, and more languages than fit a small table."""
    rare = spark.createDataFrame([(5000 + i, "agus an bhfuil sé anseo", "ga") for i in range(2)], "doc_id long, text string, lang string")
    many = spark.range(1000).selectExpr("id as doc_id", "'the cat and the dog' as text", "if(id < 550, 'en', concat('x', id)) as lang")
    model = langid.fit(many.unionByName(rare), max_rows=20)
    assert len(model.languages) == 452 and "ga" in model.languages
    assert model.languages[int(np.argmax(model.posterior("bhfuil sé anseo agus")))] == "ga"


def test_nothing_to_learn_from_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "https://a.example.org/", page("en", "the"))], "page_id long, url string, html string")
    assert langid.fit(docs(spark).limit(0)) is None
    assert langid.identify(pages, None).first().lang is None
    assert langid.identify(pages.limit(0), langid.fit(docs(spark))).count() == 0
