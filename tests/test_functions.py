import pytest
from pyspark.sql import functions as F

from quarrystone.functions import contacts as C
from quarrystone.functions import content as P
from quarrystone.functions import names as N
from quarrystone.functions import scoring as S
from quarrystone.functions import similarity as M


def values(spark, column, rows, schema="c string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r[0] for r in df.select(column).collect()]


def test_company_names(spark):
    got = values(spark, N.normalize_company(F.col("c")), ["Acme S.r.l.", "Foo Bar SPA", "Societa Cooperativa Beta", "Il Ristorante Da Mario", None, ""])
    assert got == ["acme", "foo bar", "beta", "da mario", "", ""]
    assert values(spark, N.clean_company_name(F.col("c")), ["Rossi & Figli S.R.L."]) == ["rossi figli"]
    assert values(spark, N.fold_text(F.col("c")), ["  Caffè-Perù 2 "]) == ["caffe peru 2"]
    assert values(spark, N.name_tokens(F.col("c")), ["AB Meccanica SRL"]) == [["ab", "meccanica"]]
    assert values(spark, N.name_variants(F.col("c")), ["Acme S.r.l."]) == [["Acme", "Acme SRL", "Acme S.R.L.", "Acme S.r.l."]]
    assert values(spark, N.clean_input(F.col("c")), ["A​cme – “Due”"]) == ["Acme - Due"]
    assert values(spark, N.legal_suffix(F.col("c"))[1], ["Acme s.r.l.", "Beta spa", "Gamma"]) == ["srl", "spa", ""]
    assert values(spark, N.profile_slugs(F.col("c"), F.lit("123")), ["Acme Due srl"]) == [["acme-due", "acme-due-srl", "acme-due-123", "acme-due-srl-123"]]


def test_places(spark):
    city, code = N.split_province(F.col("c"), F.lit("x"))
    assert values(spark, F.struct(city, code), ["Brescia (BS)", "Roma - RM", "Erba/CO", "Foo (ZZ)", None]) == [("Brescia", "BS"), ("Roma", "RM"), ("Erba", "CO"), ("Foo (ZZ)", None), ("", None)]
    assert values(spark, N.normalize_province(F.col("c")), ["milano", "to", "Lazio", None]) == ["MI", "TO", "Lazio", None]
    assert values(spark, N.normalize_cap(F.col("c")), ["I-20100", "123"]) == ["20100", None]
    assert values(spark, N.address_tokens(F.col("c")), ["Via Garibaldi Nuova, 12/A"]) == [["garibaldi", "nuova"]]
    q = N.input_quality(F.col("n"), F.col("c"), F.col("p"), F.col("a"), F.col("m"))
    assert values(spark, q, [("x", "y", None, None, None), ("x", "y", "1", "a", "m.it"), (None, None, None, None, None)], "n string, c string, p string, a string, m string") == [0.5, 1.0, 0.1]


def test_phones(spark):
    formatted = C.normalize_phones(F.col("c"))[0]
    got = values(spark, formatted, ["02 12345678", "333-123.45.67", "+39 06 12345", "00390612345", "02/12345; 333456789", "12", None])
    assert got == [["+390212345678"], ["+393331234567"], ["+390612345"], ["+390612345"], ["+390212345", "+39333456789"], [], []]
    assert values(spark, F.struct(*C.phone_e164(F.col("c"))), ["333 1234567", "12"]) == [("+393331234567", True), (None, False)]
    assert values(spark, C.phones_match(F.col("c"), F.lit("0612345678")), ["+39 06 12345678", "0698765432"]) == [True, False]


def test_vat_numbers(spark):
    assert values(spark, C.vat_checksum(F.col("c")), ["00743110157", "00905811006", "01114601006", "01114601007", "12345678901", "123", None]) == [True, True, True, False, False, False, False]
    assert values(spark, C.normalize_vat(F.col("c")), ["IT 00743110157", "00743110157", "12"]) == ["00743110157", "00743110157", None]
    assert values(spark, C.normalize_vat(F.col("c"), strict_reference=True), ["IT00743110157"]) == ["IT00743110157"]
    assert values(spark, C.extract_vats(F.col("c")), ["P.IVA 00743110157, IT 00905811006 e 12345678901"])[0][:2] == ["00743110157", "00905811006"]


def test_mail_and_urls(spark):
    assert values(spark, C.business_email_domain(F.col("c")), ["a@acme.it", "a@gmail.com", "a@x.legalmail.it", "no"]) == ["acme.it", None, None, None]
    assert values(spark, C.extract_pec(F.col("c")), ["Email: test@legalmail.it - scriveteci"]) == ["test@legalmail.it"]
    assert values(spark, C.root_domain(F.col("c")), ["https://www.Acme.it/x", "acme.it", "http://", None]) == ["acme.it", "acme.it", None, None]
    assert values(spark, C.url_key(F.col("c")), ["https://www.acme.it/", "http://facebook.com/x", "x"]) == ["acme.it", None, None]
    assert values(spark, C.is_directory_or_social(F.col("c")), ["facebook.com/page", "it.linkedin.com", "shop.paginegialle.it", "facebookmania.it", "mylinkedincoach.it", "???"]) == [True, True, True, False, False, True]
    assert len(values(spark, C.email_candidates(F.lit("Anna"), F.lit("Neri"), F.col("c")), ["x.it"])[0]) == 11
    assert values(spark, C.site_root(F.col("c")), ["https://a.it/b?c", "https://google.com/x", "https://a.it/b.pdf"]) == ["https://a.it", None, None]


MATCHES = [
    (("Rossi Impianti SRL", "Milano", None, "12345678901", "https://rossi-impianti.it", "Rossi Impianti SRL - Contatti - Partita IVA 12345678901", "Rossi Impianti"), 1.0, 1.0),
    (("Fabbro Fast Srl", "Roma", "+39 06 12345678", None, "https://fabbrofastroma.it", "Fabbro Fast\nPronto intervento\nTel 06-12345678\nRoma\nContatti", "Fabbro Fast Roma"), 0.8, 1.0),
    (("Officina Bianchi SRL", "Torino", "011998877", None, "https://example.com", "Benvenuto nel nostro blog di cucina e viaggi internazionali.", "Travel Blog"), 0.0, 0.4),
    (("Pavireflex SRL", "Brescia", None, None, "https://pavireflex.it", "soluzioni per pavimenti e rivestimenti a Brescia: contatti, chi siamo", "Home"), 0.35, 1.0),
    (("Tecno Service SRL", "Napoli", None, None, "https://tecnoservice.it", "tecno service offre assistenza, contatti e servizi.", "Tecno Service"), 0.6, 1.0),
]


@pytest.mark.parametrize(("row", "low", "high"), MATCHES)
def test_match_confidence(spark, row, low, high):
    s = M.match_signals(*[F.col(c) for c in ("n", "city", "a", "p", "v", "u", "t", "title")])
    n, city, p, v, u, t, title = row
    got = values(spark, M.match_confidence(s), [(n, city, None, p, v, u, t, title)], "n string, city string, a string, p string, v string, u string, t string, title string")[0]
    assert low <= got <= high


def test_similarities(spark):
    pair = "a string, b string"
    assert values(spark, M.jaccard_tokens(F.col("a"), F.col("b")), [("super company", "super company spa"), ("", ""), ("abc", "")], pair) == [2 / 3, 1.0, 0.0]
    assert values(spark, M.domain_coverage(F.col("a"), F.col("b")), [("MCM SRL", "https://mcm-srl.it"), ("Acme", None)], pair) == [1.0, 0.0]
    assert values(spark, M.name_coverage(F.col("a"), F.col("b")), [("Rossi Impianti SRL", "il sito di rossiimpianti")], pair) == [1.0]
    assert values(spark, M.levenshtein_similarity(F.col("a"), F.col("b")), [("abcd", "abce")], pair) == [0.75]


def test_content(spark):
    assert values(spark, P.is_directory_title(F.col("c")), ["Elenco aziende idraulici Milano", "Rossi Impianti - Home", "Le nostre Aziende Partner", "Orari di Apertura", None]) == [True, False, False, False, False]
    assert values(spark, P.keyword_relevance(F.col("c"), ["automazione", "robotica", "farmaceutico"])[2], ["Automazione e robotica", ""]) == [2 / 3, 1.0]
    assert values(spark, F.struct(*P.content_validity(F.col("c"))), ["Coming soon", "Buy this domain", "ok"]) == [(False, "Under Construction detected: coming soon"), (False, "Parking Page detected: buy this domain"), (True, None)]
    cases = [(429, ""), (403, "x"), (403, "captcha"), (0, ""), (200, "Just a moment"), (200, "short"), (200, "x" * 300)]
    assert values(spark, P.classify_block(F.col("s"), F.col("b"))[0], cases, "s int, b string") == ["RATE_LIMIT_429", "WAF_403", "CAPTCHA", "CONNECTION_REFUSED", "CHALLENGE_PAGE", "EMPTY_RESPONSE", "NONE"]
    assert values(spark, P.error_category(F.col("c")), ["timeout", "puppeteer", "unexpected token", "zod", "401", "?"]) == ["NETWORK", "BROWSER", "PARSING", "VALIDATION", "AUTH", "LOGIC"]
    figures = values(spark, P.financials(F.col("c")), ["Fatturato: € 1.5 mln nel 2023", "Dipendenti: 10-20"])
    assert figures[0].revenue == "1.5 mln" and figures[0].year == "2023" and figures[1].employees == "10-20"
    assert values(spark, P.first_line_title(F.col("c")), ["\n\n# Acme\nx"]) == ["Acme"]
    assert values(spark, P.title_parts(F.col("c"))[1], ["Anna Neri - CEO | X"]) == ["CEO"]
    assert values(spark, P.embedded_site(F.col("c"), F.lit('<a href="https://facebook.com/x"><a href="https://acme.it/">'), ["reg.it"]), ["Acme", "Sito: www.beta.it"]) == ["https://acme.it/", "www.beta.it"]


def evidence(**changes):
    base = {"phones_found": [], "vat_ids_found": [], "emails_found": [], "structured_data": None, "meta_title": "Test Company Generic", "address_match_score": None, "name_match_score": None, "has_contact_page": True, "has_privacy_policy": True, "is_https": True, "site_type": "CORPORATE", "dns_ok": True, "http_ok": True}
    return base | changes


def test_site_score(spark):
    schema = "e struct<phones_found: array<string>, vat_ids_found: array<string>, emails_found: array<string>, structured_data: array<string>, meta_title: string, address_match_score: double, name_match_score: double, has_contact_page: boolean, has_privacy_policy: boolean, is_https: boolean, site_type: string, dns_ok: boolean, http_ok: boolean>, f int"
    rows = [(evidence(phones_found=["+390212345678"]), 1), (evidence(meta_title="Super Company SpA Official Site"), 1), (evidence(site_type="DIRECTORY"), 1), (evidence(vat_ids_found=["00743110157"]), 1), (evidence(phones_found=["+390212345678"]), 3)]
    score = S.site_score(F.col("e"), F.lit("Super Company"), F.array(F.lit("+390212345678")), F.lit("00743110157"), F.col("f"))
    phone, title, directory, vat, common = values(spark, score, rows, schema)
    assert phone.strong >= 45 and "S1" in phone.details
    assert "S3" in title.details
    assert directory.penalties == 100 and directory.final_score == 0
    assert vat.strong >= 100
    assert common.strong == phone.strong - 20


def test_lead_score(spark):
    df = spark.createDataFrame([("anna@acme.it", "+39 333 1234567", "https://acme.it", "00743110157", None, None, None, "Anna", None, None, None), (None,) * 11], "email string, phone string, website string, vat string, pec string, revenue string, employees string, ceo_name string, ssl_valid boolean, dns_valid boolean, keyword_match boolean")
    hot, dead = [r[0] for r in df.select(S.lead_score_v2(df)).collect()]
    assert (hot.contact, hot.data, hot.website, hot.total, hot.category) == (40, 15, 25, 80, "HOT")
    assert (dead.total, dead.category) == (0, "DEAD")


def test_fold_equals_nfd_on_all_letters(spark):
    import re
    import unicodedata

    from quarrystone.functions import names

    chars = [chr(c) for c in range(0x20, 0x2000) if unicodedata.category(chr(c))[0] in "LMN"]
    texts = [*chars, *[f"x{c}y" for c in chars], "Šimić d.o.o.", "Győri Bálint", "Brăila", "Kőszeg", "Ångström", "Żabka"]
    strip = lambda t: "".join(c for c in unicodedata.normalize("NFD", t.lower()) if not 0x300 <= ord(c) < 0x370)
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", names.fold_text(F.col("t")).alias("f")).collect()
    got = {r.i: r.f for r in rows}
    wrong = [t for i, t in enumerate(texts) if got[i] != re.sub("[^a-z0-9]+", " ", strip(t)).strip()]
    assert wrong == [] and got[len(texts) - 6] == "simic d o o" and got[len(texts) - 3] == "koszeg"


def test_sql_table_function_is_plain_expressions(spark):
    from quarrystone.functions.sql import register

    register(spark)
    out = spark.sql("SELECT n, g.* FROM VALUES ('Rossi Impianti S.r.l.'), (NULL), ('srl') AS t(n), LATERAL domain_candidates(n, 'Milano', 'MI', 'Idraulico') g")
    plan = out._jdf.queryExecution().executedPlan().toString()
    rows = out.collect()
    assert "Python" not in plan and {r.n for r in rows} == {"Rossi Impianti S.r.l."} and max(r.place for r in rows) == 80
    assert any(r.domain == "rossiimpianti.it" for r in rows)
