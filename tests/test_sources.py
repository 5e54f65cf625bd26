from __future__ import annotations

from pyspark.sql import functions as F

from docweave.sources.files import list_files, read_each, read_texts, write_texts


def test_listing_and_texts(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "x.txt").write_text("é\r\nline\n")
    (tmp_path / "a" / "b" / "y.bin").write_bytes(b"\xff\xfe")
    found = {(r.path, r.directory) for r in list_files(spark, str(tmp_path)).collect()}
    assert found == {(str(tmp_path / "a" / "x.txt"), str(tmp_path / "a")), (str(tmp_path / "a" / "b" / "y.bin"), str(tmp_path / "a" / "b"))}
    texts = read_texts(spark, str(tmp_path / "a" / "x.txt")).collect()
    assert [(r.path, r.text) for r in texts] == [(str(tmp_path / "a" / "x.txt"), "é\r\nline\n")]


def test_each_file_fails_alone(spark, tmp_path):
    (tmp_path / "x.txt").write_text("ok")
    (tmp_path / "y.txt").write_bytes(b"\xff\xfe")
    rows = spark.createDataFrame([(1, str(tmp_path / "x.txt")), (2, str(tmp_path / "y.txt")), (3, str(tmp_path / "z.txt")), (4, None)], "id int, path string")
    out = {r.id: (r.text, r.error is None) for r in read_each(rows).collect()}
    assert out == {1: ("ok", True), 2: (None, False), 3: (None, False), 4: (None, False)}


def test_write(spark, tmp_path):
    rows = spark.createDataFrame([("a", "one"), ("b", ""), ("c", None)], "name string, text string")
    write_texts(rows.withColumn("path", F.concat(F.lit(f"{tmp_path}/new/"), "name")))
    assert [p.name for p in (tmp_path / "new").iterdir()] == ["a"] and (tmp_path / "new" / "a").read_text() == "one"


def test_many_files_are_dealt_evenly(spark, tmp_path):
    """Spark's own listing puts 32 files into a task, however small they are."""
    for i in range(400):
        (tmp_path / f"f{i % 3}" / ("deep/er" if i % 2 else "")).mkdir(parents=True, exist_ok=True)
        (tmp_path / f"f{i % 3}" / ("deep/er" if i % 2 else "") / f"t{i}.txt").write_text(str(i))
    found = list_files(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() <= 4
    assert sorted(int(r.text) for r in read_each(found).collect()) == list(range(400))


def test_listing_is_as_sparks(spark, tmp_path):
    """The same paths as by Spark's reader: spaces, hidden and empty files, links; and with a scheme, a slash, a pattern or one file."""
    root = tmp_path / "a b%20é"
    for name in ("x 1.txt", "p%q.TXT", ".h", "_h", "_h=1", "_metadata", "_m._COPYING_", "z._COPYING_", "d/.e/x", "d/_f/x", "d/k=_1/x", "d/y", "d/_metadata/x", "g/"):
        path = root / name
        (path if name.endswith("/") else path.parent).mkdir(parents=True, exist_ok=True)
        if not name.endswith("/"):
            path.write_text("x")
    (root / "empty").touch()
    (root / "link").symlink_to(root / "d")
    (root / "gone").symlink_to(root / "nothing")
    by_spark = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(root)).select(F.regexp_replace("path", "^file:/+", "/").alias("path"))
    expected = sorted(r.path for r in by_spark.collect())
    for given in (str(root), f"file://{root}", f"{root}/", f"{tmp_path}/a*"):
        assert sorted(r.path for r in list_files(spark, given).collect()) == expected
    assert [r.path for r in list_files(spark, str(root / "d" / "y")).collect()] == [str(root / "d" / "y")]
    assert list_files(spark, str(root / "g")).count() == 0
