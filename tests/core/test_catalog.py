"""Listings, reports, sources, sinks and the command line."""

from __future__ import annotations

import csv
import json
import zlib

import pytest

from orolog import cli
from orolog.operators import ledger, listing, timesheet
from orolog.sinks import files as sinks
from orolog.sources import documents, pdf, reports
from orolog.streaming import incremental
from tests.core.golden import DAYS, PAIRS, TEXT

FOLDER, PDF = listing.FOLDER, listing.PDF


@pytest.fixture(scope="module")
def tree(spark):
    rows = [
        ("a", "root", "Ada", FOLDER, False), ("b", "root", "Buste__Paga-", FOLDER, False), ("c", "root", "Old", FOLDER, True), ("f0", "root", "loose.pdf", PDF, False),
        ("a1", "a", "2022", FOLDER, None), ("a2", "a", "PAGA", FOLDER, False), ("a3", "a", "Paga 2023", FOLDER, False), ("a4", "a1", "deep", FOLDER, False),
        ("f1", "a1", "July.pdf", PDF, False), ("f2", "a4", "Propaganda.pdf", PDF, False), ("f3", "a2", "hidden.pdf", PDF, False), ("f4", "a3", "x.ZIP", "application/octet-stream", False),
        ("f5", "a", "x.docx", "application/msword", False), ("f6", "a", "gone.pdf", PDF, True), ("f7", "b", "never.pdf", PDF, False), ("f8", "a", "busta paga.pdf", PDF, False),
    ]
    return spark.createDataFrame(rows, "id string, parent_id string, name string, mime_type string, trashed boolean")


def test_scan(tree):
    employees, items, folders = listing.scan(tree, "root")
    assert sorted((r["section"], r["file_id"], r["container"], r["reason"]) for r in items.collect()) == [
        ("included", "f1", None, None), ("included", "f4", "zip", None), ("skipped", "f2", None, "paga"), ("skipped", "f8", None, "busta"),
    ] or sorted((r["section"], r["file_id"]) for r in items.collect()) == [("included", "f1"), ("included", "f4"), ("skipped", "f2"), ("skipped", "f8")]
    assert sorted((r["folder_id"], r["reason"]) for r in folders.collect()) == [("a2", "paga"), ("b", "buste paga")]
    assert sorted(tuple(r) for r in employees.collect()) == [("Ada", "a", 2, 2, 1), ("Buste__Paga-", "b", 0, 0, 1)]


def item(file_id, name="n", **more):
    return {"file_id": file_id, "file_name": name, **more}


def merged(spark, tmp_path, manifest, report):
    (tmp_path / "m.json").write_text(json.dumps({"root_id": "r", "employees": manifest}))
    (tmp_path / "r.json").write_text(json.dumps(report))
    m, r = reports.read_manifest(spark, str(tmp_path / "m.json")), reports.read_report(spark, str(tmp_path / "r.json"))
    newer = (reports.employees_of(r), reports.items_of(r)) if "employees" in report else ledger.legacy_report(reports.legacy_files_of(r))
    employees, items = ledger.merge(reports.employees_of(m), reports.items_of(m), *newer)
    rows = ledger.nested(employees, items).orderBy("place").collect()
    return [(e["employee"], e["employee_id"], [x["file_id"] for x in e["included"]], [(x["file_id"], x["file_name"]) for x in e["skipped"]], [x["folder_id"] for x in e["excluded_folders"]]) for e in rows], items


def test_older_report_lands_on_the_employee_of_that_name(spark, tmp_path):
    manifest = [{"employee": "Anna Blu", "employee_id": "1", "included": [item("a1")], "skipped": [], "excluded_folders": []}]
    got, items = merged(spark, tmp_path, manifest, {"files": [{"status": "success", "employee": " anna  BLU", **item("a2")}, {"status": "failed", "employee": "Else", **item("a3"), "reason": "x"}, {"status": "failed", "employee": None, **item(None)}]})
    assert got == [("Anna Blu", "1", ["a2"], [], []), ("Else", None, [], [("a3", "n")], []), ("unknown", None, [], [(None, "n")], [])]
    assert sorted(r["file_id"] for r in ledger.done_ids(items).collect()) == ["a2", "a3"]


def test_newer_report_upserts(spark, tmp_path):
    manifest = [
        {"employee": "A", "employee_id": "1", "skipped": [item("x"), item("y"), item("x", "twin"), item(None, "no id")], "excluded_folders": [{"folder_id": "f", "folder_name": "p", "reason": "paga"}]},
        {"employee": "B", "employee_id": "", "skipped": []},
    ]
    report = {
        "employees": [
            {"employee": "A", "employee_id": "1", "included": [item("b1"), item("b1", "again")], "skipped": [item("x", "new"), item(None, "more"), item("z")]},
            {"employee": "a", "employee_id": "9", "included": [item("c")]},
            {"employee": "New", "id": "7", "included": [item("d")], "excluded_folders": [{"folder_id": "g"}]},
            {"employee": "A", "employee_id": "7", "included": [item("e")], "excluded_folders": [{"folder_id": "h"}]},
        ]
    }
    got, items = merged(spark, tmp_path, manifest, report)
    assert got == [
        ("A", "1", ["b1", "c"], [("x", "new"), ("y", "n"), ("x", "twin"), (None, "no id"), (None, "more"), ("z", "n")], ["f"]),
        ("B", None, [], [], []),
        ("New", "7", ["d", "e"], [], ["g"]),
    ]
    todo = ledger.to_do(spark.createDataFrame([("b1",), ("q",), ("q",), (None,), ("",)], "file_id string"), ledger.done_ids(items)).collect()
    assert sorted(r["file_id"] or "" for r in todo) == ["", "", "q", "q"]


def test_missing_and_broken_reports(spark, tmp_path):
    assert reports.read_report(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "bad.json").write_text("{")
    with pytest.raises(Exception, match="(?i)malformed|parse|FAILFAST"):
        reports.read_report(spark, str(tmp_path / "bad.json")).collect()
    (tmp_path / "index.json").write_text(json.dumps({"result": {"matches": [{"id": "1", "name": "B", "path": "z", "mimeType": PDF}, {"id": "2", "name": "a", "mimeType": PDF}, {"id": "3", "name": "x", "path": "Y", "mimeType": PDF}, {"id": "4", "mimeType": "text/plain"}]}}))
    rows = listing.pdf_matches(reports.read_index(spark, str(tmp_path / "index.json"))).collect()
    assert [(r["id"], r["shown"]) for r in rows] == [("2", "a"), ("3", "Y"), ("1", "z")]
    (tmp_path / "index.json").write_text("{}")
    with pytest.raises(Exception, match="no result.matches"):
        reports.read_index(spark, str(tmp_path / "index.json")).collect()


def small_pdf(text: str, cmap: bool = False) -> bytes:
    """A one-page PDF that shows each line at its own height."""
    shown = lambda s: b"<" + s.encode("utf-16-be").hex().encode() + b"> Tj" if cmap else b"(" + s.encode("cp1252").replace(b"\\", b"\\\\").replace(b"(", b"\\(").replace(b")", b"\\)") + b") Tj"
    body = b"BT /F1 9 Tf 20 800 TD\n" + b"\n0 -12 TD ".join(shown(line) for line in text.splitlines()) + b"\nET"
    packed = zlib.compress(body)
    table = b"1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfrange <0020> <00FF> <0020> endbfrange"
    objects = [b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [3 0 R] /Count 1 >>", b"<< /Type /Page /Parent 2 0 R /Contents 4 0 R /Resources << /Font << /F1 5 0 R >> >> >>", b"<< /Length %d /Filter /FlateDecode >>\nstream\n" % len(packed) + packed + b"\nendstream", b"<< /Type /Font" + (b" /ToUnicode 6 0 R" if cmap else b"") + b" >>", b"<< /Length %d >>\nstream\n" % len(table) + table + b"\nendstream"]
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n" % i + o + b"\nendobj\n" for i, o in enumerate(objects, 1)) + b"%%EOF"


@pytest.mark.parametrize("cmap", [False, True])
def test_pdf_text(cmap):
    assert pdf.text_of(small_pdf(TEXT, cmap)) == TEXT.rstrip("\n")


def test_pdf_errors():
    for data in (b"", b"hello", b"%PDF-1.4 nothing"):
        with pytest.raises(pdf.PdfError):
            pdf.text_of(data)


def test_command_parse(spark, tmp_path, capsys):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "july 22.pdf").write_bytes(small_pdf(TEXT))
    (source / "other.txt").write_text("nothing here")
    assert cli.parse(spark, str(source), str(out)) == 1
    days = list(csv.reader((out / "july 22.days.csv").open()))
    assert days[0] == sinks.DAYS and len(days) == len(DAYS) + 1 and days[1][-1] == TEXT.splitlines()[3]
    pairs = list(csv.reader((out / "july 22.pairs.csv").open()))
    assert pairs[0] == sinks.PAIRS and len(pairs) == len(PAIRS) + 1 and pairs[1][5:9] == ["2022-07-01 06:45:00", "2022-07-01 14:35:00", "07:50", "Mattina"] and pairs[4][6] == ""
    report = json.loads((out / "july 22.report.json").read_text())
    assert report["meta"]["unit"] is None and report["validation"]["is_ok"] and "ore_lavorate" in json.loads((out / "july 22.totals.json").read_text())
    (tmp_path / "no suffix").write_bytes(small_pdf(TEXT))
    assert cli.parse(spark, str(tmp_path / "no suffix"), str(out)) == 0 and (out / "no suffix.days.csv").exists()
    assert not (out / "other.days.csv").exists() and "no day lines" in capsys.readouterr().out


def test_scan_then_run_twice(spark, tree, tmp_path):
    path = cli.catalog_scan(spark, tree, "root", str(tmp_path / "scan"))
    manifest = json.loads(open(path).read())
    assert [e["employee"] for e in manifest["employees"]] == ["Ada", "Buste__Paga-"] and manifest["employees"][0]["counts"] == {"included": 2, "skipped_files": 2, "excluded_folders": 1}
    content = tmp_path / "content"
    content.mkdir()
    (content / "f1.txt").write_text(TEXT)
    (content / "f4.txt").write_text("an archive")
    manifest["employees"][0]["included"].append({"file_id": None, "file_name": "lost.pdf"})
    (tmp_path / "scan/manifest.json").write_text(json.dumps(manifest))
    first = cli.run_manifest(spark, path, str(content), str(tmp_path / "done"), "report.json")
    ada = first["employees"][0]
    assert [x["file_id"] for x in ada["included"]] == ["f1"] and sorted((x["file_id"] or "", x["reason"]) for x in ada["skipped"]) == [("", "missing file_id"), ("f2", "paga"), ("f4", timesheet.NO_DAYS), ("f8", "busta")]
    assert (tmp_path / "done/Ada/July__f1/days.csv").exists() and ada["included"][0]["outputs"]["days_csv"].endswith("done/Ada/July__f1/days.csv")
    again = cli.run_manifest(spark, path, str(content), str(tmp_path / "done"), "report.json")
    assert [x["file_id"] for x in again["employees"][0]["included"]] == ["f1"] and len(again["employees"][0]["skipped"]) == 5 and again["employee_count"] == 2


def test_folder_tree_as_a_listing(spark, tmp_path):
    from orolog.sources import folder_tree

    for name in ("Ada/2022/July.pdf", "Ada/paga/hidden.pdf", "Ada/x.ZIP", "Ada/note.doc", "Bea/.gone.pdf", "top.pdf"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    folder_tree.register(spark)
    table = spark.read.format("folder_listing").load(str(tmp_path))
    assert table.count() == 10
    assert sorted(r["name"] for r in listing.children(table, "Ada").collect()) == ["2022", "note.doc", "paga", "x.ZIP"]
    employees, items, folders = listing.scan(table, "root")
    assert sorted(r["file_id"] for r in items.collect()) == ["Ada/2022/July.pdf", "Ada/x.ZIP"]
    assert [r["folder_id"] for r in folders.collect()] == ["Ada/paga"] and sorted(r["employee"] for r in employees.collect()) == ["Ada", "Bea"]


def test_tables_and_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text(TEXT)
    parsed = timesheet.parse_documents(documents.text_files(spark, str(tmp_path / "in")))
    sinks.write_tables(parsed, str(tmp_path / "tables"))
    assert spark.read.option("header", True).csv(f"{tmp_path}/tables/pairs").count() == len(PAIRS)
    for n, wanted in ((1, 1), (2, 2)):
        (tmp_path / f"in/b{n}.txt").write_text(TEXT)
        incremental.parse_stream(incremental.incoming_texts(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        assert spark.read.parquet(f"{tmp_path}/out").count() == wanted + 1


def _manifest(path, n: int) -> str:
    people = [{"employee": "Ada", "employee_id": "1", "included": [{"file_id": f"f{i}", "file_name": f"n{i}.pdf"} for i in range(n)]}]
    path.write_text(json.dumps({"root_id": "root", "employees": people}))
    return str(path)


def test_a_killed_run_goes_on_after_its_last_batch(spark, tmp_path, monkeypatch):
    content = tmp_path / "content/below"
    content.mkdir(parents=True)
    for i in range(3):
        (content / f"f{i}.txt").write_text(TEXT)
    path = _manifest(tmp_path / "manifest.json", 3)
    run, batches = cli._run_batch, []

    def killed(left, *rest):
        if batches:
            raise KeyboardInterrupt
        batches.append(sorted(r["file_id"] for r in left.collect()))
        return run(left, *rest)

    monkeypatch.setattr(cli, "_run_batch", killed)
    with pytest.raises(KeyboardInterrupt):
        cli.run_manifest(spark, path, str(tmp_path / "content"), str(tmp_path / "done"), "report.json", batch=2)
    assert [x["file_id"] for x in json.loads((tmp_path / "done/report.json").read_text())["employees"][0]["included"]] == ["f0", "f1"] == batches[0]
    monkeypatch.setattr(cli, "_run_batch", lambda left, *rest: batches.append(sorted(r["file_id"] for r in left.collect())) or run(left, *rest))
    done = cli.run_manifest(spark, path, str(tmp_path / "content"), str(tmp_path / "done"), "report.json", batch=2)
    assert batches[1:] == [["f2"]] and [x["file_id"] for x in done["employees"][0]["included"]] == ["f0", "f1", "f2"]


def test_a_broken_pdf_says_why(spark, tmp_path, capsys):
    content = tmp_path / "content"
    content.mkdir()
    (content / "f0.pdf").write_bytes(b"%PDF-1.4 broken")
    (content / "f1.pdf").write_bytes(small_pdf(TEXT))
    done = cli.run_manifest(spark, _manifest(tmp_path / "manifest.json", 3), str(content), str(tmp_path / "done"), "report.json")
    skipped = {x["file_id"]: x["reason"] for x in done["employees"][0]["skipped"]}
    assert skipped["f0"].startswith("PdfError: ") and skipped["f2"] == "not read" and [x["file_id"] for x in done["employees"][0]["included"]] == ["f1"]
    assert cli.parse(spark, str(content), str(tmp_path / "out")) == 1 and "PdfError: " in capsys.readouterr().out


def test_deep_trees_go_on_and_loops_are_found(spark, monkeypatch):
    schema = "id string, parent_id string, name string, mime_type string, trashed boolean"
    deep = [(f"d{i}", f"d{i - 1}" if i else "root", f"level {i}", listing.FOLDER, False) for i in range(9)]
    held: list = []
    _, items, _ = listing.scan(spark.createDataFrame([*deep, ("f", "d8", "July.pdf", listing.PDF, False)], schema), "root", held=held)
    assert [r["file_id"] for r in items.collect()] == ["f"] and len(held) == 10
    for df in held:
        df.unpersist()
    loop = [("a", "root", "A", listing.FOLDER, False), ("b", "a", "B", listing.FOLDER, False), ("c", "b", "C", listing.FOLDER, False), ("b", "c", "B", listing.FOLDER, False)]
    monkeypatch.setattr(listing, "LOOKED_AT", 2)
    with pytest.raises(ValueError, match="within itself"):
        listing.scan(spark.createDataFrame(loop, schema), "root")


def test_terms_may_be_given(spark, tree, tmp_path):
    path = cli.catalog_scan(spark, tree, "root", str(tmp_path / "scan"), ["july"])
    skipped = [x for e in json.loads(open(path).read())["employees"] for x in e["skipped"]]
    assert skipped and all(x["reason"] == "july" for x in skipped)
