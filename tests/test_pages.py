"""Written pages of three engines, listings and profiles, by their trees."""

from quarrystone.operators import pages
from quarrystone.operators.tree import parsed

OWN = ["google.com", "bing.com", "duckduckgo.com", "microsoft.com"]
GOOGLE = """<body><a href="/preferences">Settings</a><div class="g"><div class="yuRUbf"><a href="/url?q=https%3A%2F%2Facme.it%2Fa%3Fb%3D1&sa=U"><h3>Acme <b>srl</b></h3><cite>acme.it</cite></a></div>
<a href="https://ad.example/x">ad</a></div><div class="x kCrYT"><a href="https://beta.it/">Beta</a></div><div class="kCrYT"><a href="/url?q=https%3A%2F%2Facme.it%2Fa%3Fb%3D1">again</a></div><div class="kCrYT"><a href="https://www.google.com/search?q=z">more</a></div></body>"""
BING = """<ol><li class="b_algo"><h2><a href="https://acme.it/">Acme</a></h2><p>text <a href="https://deep.it/">deep</a></p><li class="b_algo"><h2><a href="https://notbing.com/">Not</a></h2></li>
<li class="b_ad"><a href="https://ad.example">ad</a></li><li class="b_algo"><h2><a href="https://www.bing.com/ck">own</a></h2></li></ol>"""
DDG = """<div class="result"><h2><a class="result__a" href="//duckduckgo.com/l/?uddg=https%3A%2F%2Facme.it%2F&rut=1">Acme</a></h2><a class="result__url" href="https://other.it">u</a></div><a class="result__a" href="/y.js?ad_domain=q&uddg=http%3A%2F%2Fbeta.it">B</a>"""
HEADED = """<a href="https://menu.it">menu</a><h2><a href="https://acme.it/">Acme</a></h2><a href="https://beta.it"><h3>Beta</h3>x</a>"""
PLAIN = """<a href="https://acme.it/">Acme</a><a href="#top"></a>"""


def test_results_by_engine(spark):
    rows = [(i, "https://www.google.com/search?q=a", h) for i, h in enumerate([GOOGLE, BING, DDG, HEADED, PLAIN, None, "<li class=b_algo>no link"])]
    got = pages.serp_rows(spark.createDataFrame(rows, "page_id long, url string, html string"), OWN).orderBy("page_id", "place").collect()
    found = {i: [(r.url, r.title, r.engine) for r in got if r.page_id == i] for i in range(7)}
    assert found[0] == [("https://acme.it/a?b=1", "Acme srl", "google"), ("https://beta.it/", "Beta", "google")]
    assert found[1] == [("https://acme.it/", "Acme", "bing"), ("https://notbing.com/", "Not", "bing")]
    assert found[2] == [("https://acme.it/", "Acme", "duckduckgo"), ("http://beta.it", "B", "duckduckgo")]
    assert found[3] == [("https://menu.it", "menu", ""), ("https://acme.it/", "Acme", ""), ("https://beta.it", "Beta", "")] and found[4] == [("https://acme.it/", "Acme", "")] and found[5] == found[6] == []


def test_tree_of_open_elements():
    root = parsed("<ul><li>a<li>b <b>c</ul><table><tr><td>1<td>2<tr><td>3</table><p>x<p>y</div>")
    assert [n.text() for n in root.walk() if n.tag == "li"] == ["a", "b c"]
    assert [[c.text() for c in n.elements()] for n in root.walk() if n.tag == "tr"] == [["1", "2"], ["3"]]
    assert [n.text() for n in root.walk() if n.tag == "p"] == ["x", "y"]
    deep = parsed("<div>" * 50_000 + "end")
    assert deep.text() == "end"


PROFILE = """<h1>Acme</h1><div>Partita IVA: 00743110157</div><div><span>REA</span><span>MI-1</span></div><dl><dt>Forma giuridica<dd>S.r.l.<dt>Fatturato<dd>3 mln</dl>
<table><tr><td><b>Indirizzo</b></td><td>Via Roma, 1</td></tr><tr><td>Provincia</td><td></td><td>MI</td></tr></table>
<table><thead><tr><th>Utile</th><th>Dipendenti</th></tr></thead><tbody><tr><td>7</td><td>12</td></tr></tbody></table>
<table><tr><th>Anno Fondazione</th><th>Regione</th></tr><tr><td>1999</td><td>Lombardia</td></tr></table>
<div><b>Stato Attività</b> attiva</div><script>Città: no</script><p>La Ragione sociale non c'è</p>"""


def test_labels_by_tree(spark):
    got = pages.labelled_fields(spark.createDataFrame([(1, PROFILE), (2, None), (3, "<p>REA")], "page_id long, html string"), pages.PROFILE_LABELS).orderBy("page_id").collect()
    one = got[0].asDict()
    want = {"vat": "00743110157", "rea": "MI-1", "legal_form": "S.r.l.", "revenue": "3 mln", "address": "Via Roma, 1", "province": "MI", "profit": "7", "employees": "12", "founded": "1999", "region": "Lombardia", "status": "attiva"}
    assert {k: one[k] for k in want} == want and one["city"] is None and one["activity"] is None
    assert all(v is None for k, v in got[1].asDict().items() if k != "page_id") and got[2].rea is None


LISTING = """<div class="list"><div class="item"><div><h2>Acme</h2></div><p>Via Roma, 12 - 20121 Milano (MI)</p><span>Tel 02 1234567</span><a href="https://acme.it">site</a></div>
<div class="item"><a href="https://wrong.it">before</a><h2>Beta</h2></div><div class="item"><h2>Gamma</h2><p>06 7654321</p></div></div><h2>Flat</h2><p>011 9876543</p><h2>Last</h2><a href="/x">x</a>"""


def test_listing_by_tree(spark):
    got = pages.listing_rows(spark.createDataFrame([(1, LISTING)], "page_id long, html string")).orderBy("place").collect()
    assert [(r.name, r.phone, r.website, r.city) for r in got] == [("Acme", "021234567", "https://acme.it", "Milano"), ("Beta", None, None, None), ("Gamma", "067654321", None, None), ("Flat", "0119876543", None, None), ("Last", None, None, None)]
