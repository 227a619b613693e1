"""CSV files of many headers in one scan, against Python's reader."""

import csv
import io
import random

from quarrystone.sources import files, records


def expected(text, sep):
    rows = [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=sep, skipinitialspace=True) if "".join(r).strip()]
    names = [n.strip() or f"_c{i}" for i, n in enumerate(rows[0])]
    return [{n: (x.strip() or None) for n, x in zip(names, r + [""] * len(names), strict=False)} for r in rows[1:]]


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.source_file, []).append({k: (v.strip() or None) if v else None for k, v in r.fields.items()})
    return out


def same(a, b):
    key = lambda d: sorted((k, v or "") for k, v in d.items())
    return sorted(map(key, a)) == sorted(map(key, b))


def test_line_breaks_in_fields_across_splits(spark, tmp_path):
    rng, texts = random.Random(3), {}
    parts = ["Rossi", 'il "Faro"', "a\nb", 'x\n\n"y"\n', "p;q", "t\tu", "1,2", "", 'fine"', "\n", 'a",\n"b', "  z "]
    for f in range(6):
        sep, out = ";,\t"[f % 3], io.StringIO()
        w = csv.writer(out, delimiter=sep, lineterminator="\n", quoting=csv.QUOTE_ALL if f > 2 else csv.QUOTE_MINIMAL)
        w.writerow(["Nome", "Citta", "Nota", f"extra {f}"])
        for i in range(30):
            w.writerow([f"n{i}", *(rng.choice(parts) for _ in range(3))])
        texts[f"f{f}.csv"] = out.getvalue()
        (tmp_path / f"f{f}.csv").write_text(out.getvalue())
    size, cost = (spark.conf.get(f"spark.sql.files.{c}") for c in ("maxPartitionBytes", "openCostInBytes"))
    for bytes_ in ("300", size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            got = found(records.read_csv_fields(spark, [f"{tmp_path}/*.csv"]))
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", cost)
        assert got.keys() == texts.keys()
        for name, text in texts.items():
            assert same(got[name], expected(text, ";,\t"[int(name[1]) % 3])), (bytes_, name)


def test_odd_files(spark, tmp_path):
    odd = {
        "short.csv": "a,b,c\n1\n1,2,3,4\n\n  \n",
        "twice.csv": "a;a;;b\n;x;y;z\nk;x;y;z\n",
        "bom.csv": '﻿"Nome";"Citta"\r\n"Acme ""Nord""";Roma\r\n',
        "inches.csv": 'a,b\n5" pipe,x\nq,"open\nr,s\n',
        "head.csv": "\n\na,b\na,b\n",
        "only.csv": "a,b\n",
        "blank.csv": "\n \n",
    }
    for name, text in odd.items():
        (tmp_path / name).write_bytes(text.encode())
    got = found(records.read_csv_fields(spark, [f"{tmp_path}/*.csv"]))
    assert same(got["short.csv"], [{"a": "1", "b": None, "c": None}, {"a": "1", "b": "2", "c": "3"}])
    assert same(got["twice.csv"], [{"a": "x", "_c2": "y", "b": "z"}, {"a": "k", "_c2": "y", "b": "z"}])
    assert same(got["bom.csv"], [{"Nome": 'Acme "Nord"', "Citta": "Roma"}])
    assert {r["a"] for r in got["inches.csv"]} == {'5" pipe', "q", "r"}  # what nothing closes swallows no row
    assert same(got["head.csv"], [{"a": "a", "b": "b"}])
    assert not {"only.csv", "blank.csv"} & got.keys()


def test_many_headers_make_one_plan(spark, tmp_path):
    for i in range(300):
        sep = ";,\t"[i % 3]
        name, city = ("Company_Name", "Ragione_Sociale", "name")[i % 3], ("CITY", "citta", "Comune")[i // 3 % 3]
        (tmp_path / f"{i}.csv").write_text(sep.join([name, f"note {i}", city]) + "\n" + sep.join([f"c{i}", "x", f"Roma  {i}"]) + "\n")
    (tmp_path / "MASTER_CONSOLIDATED.csv").write_text("company_name,city\nOld,Roma\n")
    got = files.unify_campaign_dir(spark, [str(tmp_path)])
    assert {(r.company_name, r.city, r.country, r.source_file) for r in got.collect()} == {(f"c{i}", f"Roma {i}", "IT", f"{i}.csv") for i in range(300)}
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation")
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "0.csv").write_text("name,city\nc0,Roma\n")
    assert scans(got) == scans(files.unify_campaign_dir(spark, [str(tmp_path / "one")])) <= 3
    wide = files.read_campaign_dir(spark, [str(tmp_path)])
    assert len(wide.columns) == 300 + 3 + 3 + 1 and wide.count() == 300


def test_written_files_are_read_again(spark, tmp_path):
    rows = [("1", 'il "Faro"'), ("2", '"'), ("3", "a\nb, \"c\""), ("4", "back\\slash"), ("5", None)]
    files.write_results_csv(spark.createDataFrame(rows, "row_id string, name string"), str(tmp_path / "out"))
    assert {(r.row_id, r.name) for r in files.read_companies_csv(spark, [f"{tmp_path}/out/*.csv"]).collect()} == set(rows)


def test_inner_quotes_read_with_defaults_too(spark, tmp_path):
    """Quotes within a value do not quote it; those at its beginning, separators and line breaks do."""
    rows = [("1", '["x"]'), ("2", '"a'), ("3", 'a,"b"'), ("4", '"a"b'), ("5", '"a\nb'), ("6", 'a""b'), ("7", '""')]
    files.write_results_csv(spark.createDataFrame(rows, "row_id string, name string"), str(tmp_path / "out"))
    assert {(r.row_id, r.name) for r in files.read_companies_csv(spark, [f"{tmp_path}/out/*.csv"]).collect()} == set(rows)
    assert spark.read.option("header", True).csv(f"{tmp_path}/out").where("row_id = '1'").first().name == '["x"]'
