"""The stages one after the other over a small catalog."""

from __future__ import annotations

import json
import os
from datetime import datetime

import pytest

from docweave import cli
from docweave.catalog import Catalog, ConflictError
from docweave.plans import stages
from docweave.streaming import landing
from stage_doubles import Reader


def test_whole_process(spark, tmp_path):
    for subject, text in (("094-000001", "Seen 2024-01-04 by Smith, mail a@b.org\n"), ("094-000002", "Seen 2024-03-01 by SMITH\n")):
        folder = tmp_path / "in" / subject / "deep"
        folder.mkdir(parents=True)
        (folder / "scan.pdf").write_text(text)
    (tmp_path / "in" / "other").mkdir()
    (tmp_path / "in" / "other" / "scan.pdf").write_text("x")
    root = str(tmp_path / "catalog")
    assert cli.main(["--catalog", root, "tables", "install"], spark) == 0
    catalog = Catalog(spark, root)
    assert stages.register(catalog, str(tmp_path / "in")) == 2
    assert stages.register(catalog, str(tmp_path / "in")) == 0
    assert stages.register(catalog, str(tmp_path / "in"), again=True) == 2
    assert catalog.read("transcription_metadata").count() == 4
    out = str(tmp_path / "out")
    first = stages.transcribe(catalog, out, engine=Reader)
    assert first.rows.count() == 4 and (first.done, first.failed) == (4, 0)
    assert stages.transcribe(catalog, out, engine=Reader)[1:] == (0, 0)
    (tmp_path / "names.csv").write_text("name\nsmith\n")
    assert cli.main(["--catalog", root, "replace", str(tmp_path / "names.csv"), "name", "<NAME>", out], spark) == 0
    assert cli.main(["--catalog", root, "scrub", out, "--strict-profile"], spark) == 0
    rows = catalog.read("transcription_output").collect()
    assert len(rows) == 4 and len({r.id for r in rows}) == 4
    texts = {open(r.pii_scrubber_output_file).read() for r in rows}
    assert texts == {"\nSeen <DATE_TIME> by <NAME>, mail <EMAIL_ADDRESS>\n", "\nSeen <DATE_TIME> by <NAME>\n"}
    records = [json.load(open(r.pii_scrubber_confidence_file)) for r in rows]
    assert all(x["Type"] in ("DATE_TIME", "EMAIL_ADDRESS") and x["Score"] >= 0.45 for r in records for x in r)
    assert stages.scrub(catalog, out) == (0, 0)
    os.unlink(rows[0].list_replacement_output_file)
    lost = sum(r.list_replacement_output_file == rows[0].list_replacement_output_file for r in rows)
    assert stages.replace(catalog, str(tmp_path / "names.csv"), "name", "-", str(tmp_path / "again")) == (4 - lost, lost)
    (tmp_path / "visits.tsv").write_text("grls_id\tsubject_id\tvisit_date\n1\t094-000001\t2024-01-02\n2\t094-000002\t2024-01-02\n")
    (tmp_path / "profiles.tsv").write_text("grls_id\tsubject_id\tbirth_date\tdeath_date\n1\t094-000001\t2012-05-06\t\n")
    pairs, done, failed = stages.mine(catalog, str(tmp_path / "visits.tsv"), str(tmp_path / "profiles.tsv"), datetime(2024, 12, 31), search_text=True)
    assert failed == 0 and done > 0
    assert {(r.subject_id, r.visit_date, r.extracted_date) for r in pairs.collect()} == {("094-000001", datetime(2024, 1, 2), datetime(2024, 1, 4))}
    filled = catalog.read("transcription_metadata").where("visit_date is not null").collect()
    assert {r.subject_id for r in filled} == {"094-000001"} and catalog.read("transcription_metadata").count() == 4
    assert cli.main(["--catalog", root, "tables", "drop"], spark) == 0
    assert not catalog.exists("transcription_input")


def test_scrub_by_model_and_failures(spark, tmp_path):
    """A classifier's spans are redacted with the patterns'; files that fail are counted, logged and give exit code 1."""
    for subject, name in (("094-000001", "scan.pdf"), ("094-000002", "broken.pdf")):
        folder = tmp_path / "in" / subject
        folder.mkdir(parents=True)
        (folder / name).write_text("Seen by Smith and SmithX, mail a@b.org")
    root, out = str(tmp_path / "catalog"), str(tmp_path / "out")
    catalog = Catalog(spark, root)
    catalog.install()
    stages.register(catalog, str(tmp_path / "in"))
    assert cli.main(["--catalog", root, "transcribe", out, "--engine", "stage_doubles:Reader"], spark) == 1
    assert stages.transcribe(catalog, out, engine=Reader)[1:] == (0, 1)
    (tmp_path / "settings.json").write_text(json.dumps({"labels": {"STAFF": "PERSON"}, "window": 4, "stride": 1}))
    assert cli.main(["--catalog", root, "scrub", out, "--config", str(tmp_path / "settings.json"), "--classifier", "stage_doubles:Names"], spark) == 0
    (row,) = catalog.read("transcription_output").collect()
    assert open(row.pii_scrubber_output_file).read() == "\nSeen by <PERSON> and SmithX, mail <EMAIL_ADDRESS>"
    assert [x["Type"] for x in json.load(open(row.pii_scrubber_confidence_file))] == ["PERSON", "EMAIL_ADDRESS"]
    os.unlink(row.pii_scrubber_confidence_file)
    for name, head in (("visits.tsv", "grls_id\tsubject_id\tvisit_date\n"), ("profiles.tsv", "grls_id\tsubject_id\tbirth_date\tdeath_date\n")):
        (tmp_path / name).write_text(head)
    lists = ["--visit-dates", str(tmp_path / "visits.tsv"), "--profiles", str(tmp_path / "profiles.tsv")]
    assert cli.main(["--catalog", root, "mine", *lists], spark) == 1
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["--catalog", "c", "scrub", "out", "--classifier", "nowhere:Nothing"])


def test_commits(spark, tmp_path):
    """Two tables change together, and of two writers from one state the second is refused."""
    one, two = Catalog(spark, str(tmp_path)), Catalog(spark, str(tmp_path))
    one.install()
    one.install()
    row = spark.createDataFrame([(1, "document", None, "/a")], "id long, document_type string, created timestamp_ntz, input_file string")
    holder = spark.createDataFrame([(1, 1)], "id long, input_id long").selectExpr("id", "input_id", "'s' subject_id", "null year_in_study", "null visit_date", "null extracted_date")
    both = {"transcription_input": one.appended("transcription_input", row), "transcription_metadata": one.appended("transcription_metadata", holder)}
    late = two.appended("transcription_input", row)
    one.commit(both)
    assert two.read("transcription_metadata").count() == 1
    two._seen["transcription_input"] = "v-older"
    with pytest.raises(ConflictError):
        two.write("transcription_input", late)
    assert one.read("transcription_input").count() == 1
    (tmp_path / "_commits" / "0000000003").write_text("")
    with pytest.raises(ConflictError):
        one.read("transcription_input")


def test_catalog_refuses(spark, tmp_path):
    with pytest.raises(ValueError):
        Catalog(spark, "")
    with pytest.raises(ValueError):
        Catalog(spark, str(tmp_path)).run("upgrade")
    with pytest.raises(ValueError):
        Catalog(spark, str(tmp_path)).read("transcription_input")
    with pytest.raises(ValueError):
        stages.transcribe(Catalog(spark, str(tmp_path)), "out", "word")


def test_cli_options():
    a = cli.parser().parse_args(["--catalog", "c", "mine", "--visit-dates", "v", "--profiles", "p"])
    assert (a.days, a.chunk_size, a.offset, a.search_texts) == (3, None, 0, False)
    a = cli.parser().parse_args(["--catalog", "c", "scrub", "out"])
    assert (a.threshold, a.chunk_size, a.document_type) == (0.0, 1000, "document")
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["--catalog", "c", "tables", "migrate"])


def test_landing(spark, tmp_path):
    def put(subject, name):
        folder = tmp_path / "in" / subject
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("x")

    def run():
        landing.write(landing.arriving(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(60)
        return sorted((r.subject_id, r.input_file.rsplit("/", 1)[1]) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    put("094-000001", "a.pdf")
    put("none", "b.pdf")
    assert run() == [("094-000001", "a.pdf")]
    put("094-000002", "c.pdf")
    assert run() == [("094-000001", "a.pdf"), ("094-000002", "c.pdf")]
