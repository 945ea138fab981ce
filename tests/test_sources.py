"""Readers and writers on files made for the test."""

import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from loreweave.functions import hooks
from loreweave.operators import files
from loreweave.session import bounded_rows, shared_folder, small_rows, spread
from loreweave.sources import flags, readers


def test_read_instructions(spark, tmp_path):
    rows = [{"instruction": "a", "input": "", "output": "龙\nx"}, {"instruction": "b", "input": "c", "output": "d"}]
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, rows)) + '\n{"instruction": "broken\n')
    (tmp_path / "array.json").write_text(json.dumps(rows))
    lines = readers.read_instructions(spark, str(tmp_path / "lines.json"))
    assert {(r.instruction, r.output) for r in readers.good_records(lines.cache()).collect()} == {("a", "龙\nx"), ("b", "d")}
    assert lines.where("_corrupt_record is not null").count() == 1
    array = readers.read_instructions(spark, str(tmp_path / "array.json"), array_file=True)
    assert array.select("instruction", "input", "output").collect() == lines.where("_corrupt_record is null").select("instruction", "input", "output").collect()


def test_load_template(spark, tmp_path):
    (tmp_path / "t.txt").write_text("a {b}\n\nc\n")
    assert readers.load_template(spark, str(tmp_path / "t.txt")) == "a {b}\n\nc\n"
    assert readers.load_template(spark, str(tmp_path / "none.txt"), "x") == "x"
    with pytest.raises(FileNotFoundError):
        readers.load_template(spark, str(tmp_path / "none.txt"))


def test_registry_defaults(spark, tmp_path):
    (tmp_path / "m.json").write_text('[{"name": "A", "model_id": "a"}, {"model_id": "b", "lora_id": "l"}]')
    got = readers.read_model_registry(spark, str(tmp_path / "m.json")).orderBy("model_id").collect()
    assert [tuple(r) for r in got] == [("A", "a", None), ("model_rating", "b", "l")]


def test_index_is_built_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert readers.index_build_or_load(spark, str(tmp_path / "i"), build).count() == 3
    assert len(calls) == 1
    # a write that broke off is built again
    (tmp_path / "i" / "_SUCCESS").unlink()
    assert readers.index_build_or_load(spark, str(tmp_path / "i"), build).count() == 3
    assert len(calls) == 2


def test_documents_whole(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n")
    (tmp_path / "b.txt").write_text("z")
    got = {r.path.rsplit("/", 1)[1]: r.text for r in readers.read_documents(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": "x\ny\n", "b.txt": "z"}


def test_flag_log_round_trip(spark, tmp_path):
    at = dt.datetime(2023, 5, 17, 12, 53, 38, 943283)
    texts = ['say "hi", ok', "two\nlines\r\nthree", "早上好 🙂", "back\\slash \\\" end", " spaces "]
    rows = [(t, t, t[::-1], "f", "u", at) for t in texts]
    df = spark.createDataFrame(rows, "input string, answer_a string, answer_b string, flag string, username string, ts timestamp_ntz")
    path = str(tmp_path / "log")
    flags.flag_log_append(flags.log_rows(df), path)
    flags.flag_log_append(flags.log_rows(df), path)
    got = sorted(tuple(r) for r in flags.flag_log_read(spark, path).collect())
    assert got == sorted(rows * 2)


def test_manifest_of_files(spark, tmp_path):
    names = ["ok.bin", "bad.bin", "gone.bin"]
    manifest = []
    for n in names:
        (tmp_path / n).write_bytes(n.encode() * 1000)
        manifest.append(("m", n, hashlib.sha256(n.encode() * 1000).hexdigest()))
    (tmp_path / "bad.bin").write_bytes(b"x")
    (tmp_path / "gone.bin").unlink()
    seen = files.hash_files(spark, str(tmp_path), "*.bin").withColumn("path", F.regexp_extract("path", "([^/]+)$", 1))
    checked = files.verify_manifest(spark.createDataFrame(manifest, "model string, path string, sha256 string"), seen)
    assert {r.path: r.status for r in checked.collect()} == {"ok.bin": "ok", "bad.bin": "failed", "gone.bin": "missing"}
    total = files.manifest_summary(checked).first()
    assert (total.files, total.ok, total.failed, total.missing, total.validated) == (3, 1, 1, 1, False)


def test_files_of_any_size_are_hashed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "MAX_FILE_BYTES", 10)
    (tmp_path / "a.bin").write_bytes(b"x" * 9)
    (tmp_path / "b.bin").write_bytes(b"x" * 10)
    (tmp_path / "c.bin").write_bytes(b"y" * 1_000_000)
    got = {r["size"]: r.sha256 for r in files.hash_files(spark, str(tmp_path)).collect()}
    assert got == {n: hashlib.sha256(x * n).hexdigest() for n, x in ((9, b"x"), (10, b"x"), (1_000_000, b"y"))}
    assert files.streamed_sha256(f"file://{tmp_path}/c.bin", 999) == got[1_000_000]


def test_generated_records(spark):
    good = [{"instruction": "I", "input": f"q{i}", "output": f"a{i}"} for i in range(10)]
    odd = [dict(good[0], instruction="J"), {"instruction": "I", "input": "q"}, *good[2:]]
    rows = [(1, json.dumps(good)), (2, json.dumps(good[:9])), (3, "sorry"), (4, json.dumps(odd)), (5, None)]
    df = spark.createDataFrame(rows, "k int, t string")
    got = readers.parse_generated_records(df, F.col("t"), "I").drop("t").collect()
    count = {}
    for r in got:
        count[(r.k, r.reason)] = count.get((r.k, r.reason), 0) + 1
    assert count == {
        (1, None): 10, (2, "wrong size"): 1, (3, "not a JSON array"): 1,
        (4, "other instruction"): 1, (4, "missing field"): 1, (4, None): 8, (5, "not a JSON array"): 1,
    }


def test_hook_keeps_errors(spark):
    def client():
        def ask(prompts):
            if "bad" in prompts:
                raise RuntimeError("no")
            return [p.upper() for p in prompts]

        return ask

    df = spark.createDataFrame([("a",), ("bad",), ("c",)], "p string").coalesce(1)
    got = hooks.generate_text(df, "p", "x", client, keep=True)
    assert {(r.p, r.x, r.error) for r in got.collect()} == {("a", "A", None), ("bad", None, "RuntimeError: no"), ("c", "C", None)}
    assert hooks.answered(got).count() == 2


def test_size_checks(spark):
    assert small_rows(spark.range(5), 4) is None and len(small_rows(spark.range(4), 4)) == 4
    with pytest.raises(ValueError):
        bounded_rows(spark.range(5), "things", 4)
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert spread(spark.range(10, numPartitions=4), "id").rdd.getNumPartitions() == 4
    assert spread(spark.range(10, numPartitions=2), "id").rdd.getNumPartitions() == 4
