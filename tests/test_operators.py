import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarrystone.operators import frontier, pages, ranking, resolve, telemetry
from quarrystone.operators.components import connected_components
from quarrystone.sources import files
from quarrystone.streaming import jobs


def brute_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == brute_components(edges)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_entities_do_not_depend_on_order(spark):
    rows = [(1, "IT00743110157", None), (2, "00743110157", "https://acme.it"), (3, None, "http://www.acme.it/"), (4, None, "https://beta.it"), (5, None, None)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame([(i, "N", "", v, w) for i, v, w in order], "row_id long, company_name string, city string, vat string, website string")
        got = {r.row_id: r.entity_id for r in resolve.resolve_entities(df).collect()}
        assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_merge_longest(spark):
    df = spark.createDataFrame([(1, 1, "Acme", "null", "a"), (1, 2, "Acme SRL", "x", "b"), (1, 3, "Acme SPA", "", "a")], "entity_id long, row_id long, n string, m string, s string")
    r = resolve.merge_records_longest(df, ["n", "m"], source="s").first()
    assert (r.n, r.m, r.source_file, r.n_records) == ("Acme SRL", "x", "a;b", 3)


@pytest.mark.parametrize("seed", [3, 4])
def test_fuzzy_pairs_lose_none(spark, seed):
    rng = random.Random(seed)

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    names = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(5, 16))) for _ in range(80)})
    df = spark.createDataFrame(list(enumerate(names)), "row_id long, company_name string")
    got = {(r.a, r.b) for r in resolve.fuzzy_pairs(df, "company_name").collect()}
    want = {(i, j) for i in range(len(names)) for j in range(i + 1, len(names)) if lev(names[i], names[j]) * 100 <= max(len(names[i]), len(names[j])) * 15}
    assert got == want


def test_decide_thresholds(spark):
    rows = [(1, 1, "Acme Spa", "https://a.it", 90.0, 0), (1, 2, "Acme Spa", "https://b.it", 70.0, 0), (2, 1, "Acme Spa", "https://a.it", 90.0, 0), (2, 2, "Acme Spa", "https://b.it", 70.1, 0), (3, 1, "Abc", "https://a.it", 93.0, 0)]
    df = spark.createDataFrame(rows, "company_id long, pos int, company_name string, source_url string, final_score double, phone_freq long").withColumns({"n_vats": F.lit(0), "n_phones": F.lit(1)})
    got = {r.company_id: (r.status, r.confidence) for r in ranking.decide(df).collect()}
    assert got == {1: ("OK", 94), 2: ("NO_DOMAIN_FOUND", 80), 3: ("NO_DOMAIN_FOUND", 80)}


def test_scheduler_ids(spark):
    rows = [(1, None, "Acme Srl", "Milano", "Via Roma 1", "+390212340000"), (2, None, "Acme Srl", "Milano", "Via Roma 1", "+390212340000"), (3, None, "beta snc", "Torino", "Via Po 2", "+390111110000")]
    kept, counts = resolve.deterministic_company_id(spark.createDataFrame(rows, "row_id long, company_id string, company_name string, city string, address string, phone string"))
    assert kept.count() == 2 and tuple(counts.first()) == (3, 1)


def test_domain_candidates(spark):
    df = spark.createDataFrame([(1, "Rossi Impianti S.R.L.", "Milano", "MI", "Idraulico"), (2, "Fabbro Fast", "Roma", "RM", "Fabbro")], "row_id long, company_name string, city string, province string, category string")
    got = frontier.domain_candidates(df)
    first = [r.domain for r in got.where("row_id = 1").collect()]
    assert 1 <= len(first) <= 80 and any("rossiimpianti.it" in x for x in first)
    assert {"fabbrofastroma.it", "fabbro-fast-roma.it"} & {r.domain for r in got.where("row_id = 2").collect()}


PAGE = """<html><head><title>Acme</title><meta name="description" content="Fine things"><script type="application/ld+json">{"@graph": [{"@type": "Organization", "url": "https://www.acme.it/", "telephone": "+39 02 1234567", "vatID": "IT00743110157"}]}</script></head>
<body><nav><a href="/x">X</a></nav><h1>Acme Srl</h1><p>Tel <b>02 1234567</b></p><a href="/contatti">Contatti</a><a href="https://other.it/">Other</a><a href="/url?q=https://found.it/&x=1">Found</a><h2>Beta</h2><p>Tel. 02 7654321 <a href="https://beta.it">sito</a></p><p>Ricavi: 3 mln</p><script>x()</script></body></html>"""


def test_pages(spark):
    df = spark.createDataFrame([(1, "https://acme.it/", PAGE), (2, None, None)], "page_id long, url string, html string")
    one, two = pages.extract_page(df).orderBy("page_id").collect()
    assert one.title == "Acme" and one.description == "Fine things" and one.h1 == ["Acme Srl"] and "x()" not in one.text
    assert "https://acme.it/contatti" in one.contact and "https://other.it/" in one.external and two.text == ""
    walked = pages.jsonld_walk(pages.extract_page(df), ["vatid", "telephone"]).orderBy("page_id").first()
    assert (walked.vatid, walked.telephone) == ("IT00743110157", "+39 02 1234567")
    signals = pages.extract_page(df).withColumns({"website": F.lit("https://acme.it"), "phone": F.lit("021234567"), "vat": F.lit("00743110157")})
    assert tuple(pages.schema_org_signals(signals).orderBy("page_id").first()) == (1, True, True, True, True)
    serp = pages.serp_rows(df.where("page_id = 1"), ["acme.it"]).collect()
    assert [r.url for r in serp][:2] == ["https://other.it/", "https://found.it/"]
    assert pages.listing_rows(df.where("page_id = 1")).first().asDict() == {"page_id": 1, "place": 1, "name": "Beta", "phone": "027654321", "website": "https://beta.it", "street": None, "zip": None, "city": None, "province": None}
    shop = "<h2>Gamma</h2><div>Via Roma, 12 - 20121 Milano (MI)</div><p>Tel 02 1234567, scrivi a info@gamma.it o a Beta@x.it, P.IVA 00743110157 e 12345678901</p><a href='/chi-siamo'>noi</a><a href='https://shop.gamma.it/cookie'>c</a>"
    listed = pages.listing_rows(spark.createDataFrame([(3, shop)], "page_id long, html string")).first()
    assert (listed.street, listed.zip, listed.city, listed.province) == ("Via Roma, 12", "20121", "Milano", "MI")
    three = pages.extract_page(spark.createDataFrame([(3, "https://www.gamma.it/x", shop), (4, "http://[bad", shop)], "page_id long, url string, html string")).orderBy("page_id").first()
    assert three.emails == ["info@gamma.it", "Beta@x.it"] and three.vats == ["00743110157"]
    assert three.contact == ["https://www.gamma.it/chi-siamo"] and three.privacy == ["https://shop.gamma.it/cookie"] and three.external == []
    fields = "<table><tr><td>Ricavi</td><td>3 mln</td></tr></table><dl><dt>Addetti</dt><dd>12</dd></dl><div>REA: MI-1</div><p><b>Utile</b> <span>7</span></p>"
    got = pages.labelled_fields(spark.createDataFrame([(5, fields)], "page_id long, html string"), {"a": "ricavi", "b": "addetti", "c": "REA", "d": "Utile", "e": "Sede"}).first()
    assert (got.a, got.b, got.c, got.d, got.e) == ("3 mln", "12", "MI-1", "7", None)
    assert pages.labelled_fields(df, {"revenue": "Ricavi"}).orderBy("page_id").first().revenue == "3 mln"
    assert pages.html_to_text(df, 5).orderBy("page_id").first().text.endswith("[truncated]")
    assert "BODY" in pages.clean_html(df).orderBy("page_id").first().text


def test_csv_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Ragione Sociale;Citta;Telefono\nAcme, Srl ; Roma;06 1\n\n;Milano;\n")
    (tmp_path / "b.csv").write_text("company_name,city,website\nBeta,Torino,https://b.it\n")
    (tmp_path / "MASTER_CONSOLIDATED.csv").write_text("company_name,city\nOld,Roma\n")
    got = files.read_campaign_dir(spark, [str(tmp_path)])
    assert {r["source_file"] for r in got.collect()} == {"a.csv", "b.csv"}
    named = files.map_headers(got)
    assert {(r.company_name, r.city) for r in named.collect()} == {("Acme, Srl", "Roma"), (None, "Milano"), ("Beta", "Torino")}
    flagged = files.flag_invalid_rows(named.withColumn("row_id", F.monotonically_increasing_id()))
    assert flagged.where("ingest_error is not null").count() == 1
    assert files.delimiter("a;b;c,d") == ";" and files.delimiter("a\tb") == "\t" and files.delimiter("a,b") == ","


def test_exports_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", "HOT", 80, "MI", ["x"]), ("2", "COLD", 30, None, [])], "company_id string, category string, total int, province string, tags array<string>")
    files.export_segmented(df, str(tmp_path / "seg"))
    back = spark.read.option("header", True).csv(str(tmp_path / "seg"))
    assert {r.segment for r in back.collect()} == {"HOT", "COLD"} and back.where("segment = 'HOT'").first().tags == '["x"]'
    files.write_by_province(df, str(tmp_path / "prov"), ["company_id", "province"])
    assert {r.province_part for r in spark.read.option("header", True).csv(str(tmp_path / "prov" / "by_province")).collect()} == {"MI", "unknown"}
    files.export_leads(df, str(tmp_path / "leads"), "json", min_score=50)
    assert spark.read.json(str(tmp_path / "leads")).count() == 1


def test_search_json(spark):
    rows = [(1, json.dumps({"data": [{"title": "T", "url": "https://a.it"}]})), (2, json.dumps([{"url": "https://b.it", "content": "c"}])), (3, "see https://c.it/x and https://d.it"), (4, None)]
    got = files.parse_search_json(spark.createDataFrame(rows, "page_id long, body string")).orderBy("page_id", "place").collect()
    assert [(r.page_id, r.url) for r in got] == [(1, "https://a.it"), (2, "https://b.it"), (3, "https://c.it/x"), (3, "https://d.it")]


def test_breaker_and_cooldown(spark):
    t = datetime(2024, 1, 1)
    rows = [("r", t, 0.05, 0.0), ("r", t + timedelta(minutes=5), 0.0, 0.0), ("r", t + timedelta(minutes=10), 0.0, 0.0), ("r", t + timedelta(minutes=15), 0.0, 0.3)]
    health = spark.createDataFrame(rows, "run_id string, window_start timestamp, cost_per_company double, error_rate double")
    assert [r.open for r in telemetry.circuit_breaker(health).orderBy("window_start").collect()] == [True, True, False, True]
    events = spark.createDataFrame([(1, "k", t), (2, "k", t + timedelta(hours=23)), (3, "k", t + timedelta(hours=24)), (4, "j", t)], "event_id long, k string, ts timestamp")
    assert {r.event_id: r.approved for r in telemetry.cooldown(events, "k", 86_400).collect()} == {1: True, 2: False, 3: True, 4: True}


def test_streams_equal_batch(spark, tmp_path):
    t = datetime(2024, 1, 1)
    rows = [(i, t + timedelta(seconds=20 * i), "abc"[i % 3], f"d{i % 2}.it", ["CAPTCHA", "NONE", "WAF_403"][i % 3], i % 4 != 0, 10 * i, 0.01, i % 2 == 0, str(i % 5)) for i in range(40)]
    schema = "event_id long, ts timestamp, provider string, domain string, block_type string, success boolean, duration_ms long, cost_eur double, cache_hit boolean, company_id string"
    batch = spark.createDataFrame(rows, schema)
    batch.repartition(1).write.json(str(tmp_path / "in"))
    stream = jobs.read_ledger_stream(spark, str(tmp_path / "in"), schema)
    counted = jobs.drain(jobs.block_counts_stream(stream), str(tmp_path / "o1"), str(tmp_path / "c1"), "complete")
    want = {(r.domain, r.block_type): r.n for r in telemetry.block_profile(batch).collect()}
    assert {(r.domain, r.block_type): r.n for r in counted.collect()} == want
    health = jobs.drain(jobs.ledger_health_stream(stream, "60 seconds", "60 seconds"), str(tmp_path / "o2"), str(tmp_path / "c2"))
    exact = {r.window_start: r.total_calls for r in telemetry.health_snapshot(batch, "60 seconds").collect()}
    got = {r.window_start: r.total_calls for r in health.collect()}
    assert got and all(exact[k] == v for k, v in got.items())
    totals = jobs.drain(jobs.running_totals_stream(stream), str(tmp_path / "o3"), str(tmp_path / "c3"), "complete")
    assert sum(r.processed for r in totals.collect()) == 40
    runs = jobs.drain(jobs.failure_runs_stream(stream), str(tmp_path / "o4"), str(tmp_path / "c4"))
    assert {r.provider: r.consecutive_failures for r in runs.collect()} == {r.provider: r.consecutive_failures for r in telemetry.running_totals(batch).collect()}
    cool = jobs.drain(jobs.cooldown_stream(stream, "company_id", 300), str(tmp_path / "o5"), str(tmp_path / "c5"))
    want = {r.event_id: r.approved for r in telemetry.cooldown(batch, "company_id", 300).collect()}
    assert {r.event_id: r.approved for r in cool.collect()} == want


def test_campaigns_are_upserted(spark, tmp_path):
    """Files that come later in the same folder: known companies are passed over, new ones join the table."""
    folder, table, at = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "c")
    folder.mkdir()
    schema = "company_name string, city string, phone string, address string"
    head = "company_name,city,phone,address\n"
    (folder / "Roma_1.csv").write_text(head + " Acme ,Roma,06 1,Via A\nBeta,Roma,,\n,Roma,1,\n")

    def take():
        rows = jobs.campaign_stream(jobs.watch_campaigns(spark, str(folder), schema))
        jobs.upsert_stream(rows, table, at)
        return {(r.company_name, r.city, r.file_city) for r in jobs.upserted(spark, table).collect()}

    assert take() == {("Acme", "Roma", "Roma"), ("Beta", "Roma", "Roma")}
    (folder / "new.csv").write_text(head + "ACME,roma,061,via a\nGamma,Pisa,,\n")
    assert take() == {("Acme", "Roma", "Roma"), ("Beta", "Roma", "Roma"), ("Gamma", "Pisa", "unknown")}


def test_cascade_links_by_any_key(spark):
    schema = "row_id long, company_name string, city string, vat string, phone string, website string, address string, source string"
    rows = [
        (1, "Acme SRL", "Roma", "IT00743110157", "06 123456", None, "Via", "PG"), (2, "Other", "Pisa", None, "06-123456", "https://a.it", "", "Maps"), (3, "acme s.r.l.", "ROMA", None, None, "https://b.it", "Via Lunga 3", "Maps"),
        (4, "Beta", "Roma", "123", "1", None, None, None), (5, "", None, None, None, None, None, "PG"), (6, None, None, "123", None, "https://c.it", "x", "Maps"),
    ]
    got = {r.row_id: r for r in resolve.dedup_priority_cascade(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {1, 4, 5} and got[1].n_merged == 3 and got[4].n_merged == 2
    assert (got[1].website, got[1].source, got[1].address, got[1].phone) == ("https://a.it", "PG + Maps", "Via Lunga 3", "06 123456")
    assert (got[4].website, got[4].source, got[4].address) == ("https://c.it", " + Maps", "x") and got[5].website is None


def test_folds_go_on_over_batches(spark):
    """A key of more rows than a batch holds."""
    t = datetime(2024, 1, 1)
    rows = [(i, "hot" if i % 10 else "cold", t + timedelta(seconds=7 * i)) for i in range(2500)] + [(9999, None, t)]
    events = spark.createDataFrame(rows, "event_id long, company_id string, ts timestamp")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "300")
    try:
        got = {r.event_id: r.approved for r in telemetry.cooldown(events, "company_id", 60).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    last, want = {}, {}
    for i, key, ts in rows[:-1]:
        want[i] = key not in last or (ts - last[key]).total_seconds() >= 60
        if want[i]:
            last[key] = ts
    assert got == want


def test_common_numbers_make_no_pairs(spark):
    from quarrystone.operators.joins import match_phones

    entities = spark.createDataFrame([(i, ["+39021234567"] if i < 500 else ["+393331112222", "+393331112222"]) for i in range(503)], "row_id long, phones array<string>")
    found = spark.createDataFrame([(i, ["021234567"]) for i in range(400)] + [(900, ["3331112222", "00393331112222"]), (901, None)], "page_id long, found array<string>")
    got = {r.row_id: (r.page_id, r.n_pages) for r in match_phones(entities, found).collect()}
    assert got == {i: (0, 400) if i < 500 else (900, 2) for i in range(503)}


def test_shared_folder_is_named_on_clusters(spark):
    from quarrystone.session import shared_dir

    class Conf:
        def __init__(self, **held):
            self.held = held

        def get(self, key, default=None):
            return self.held.get(key.replace(".", "_"), default)

        def set(self, key, value):
            self.held[key.replace(".", "_")] = value

    class Session:
        def __init__(self, **held):
            self.conf = Conf(**held)

    assert shared_dir(Session(spark_checkpoint_dir="hdfs:///c/", spark_master="yarn")) == "hdfs:///c"
    local = Session(spark_master="local[4]")
    assert shared_dir(local).startswith("file://") and shared_dir(local) == shared_dir(local)
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", ""):
        with pytest.raises(ValueError):
            shared_dir(Session(spark_master=master))
