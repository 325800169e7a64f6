from __future__ import annotations

import hashlib
from datetime import datetime

import pytest

import tableprofile as tp
from tableprofile.functions.tidy import TIDY_SCHEMA
from tableprofile.sources import versions


def tidy(spark, *values):
    return spark.createDataFrame([("s", None, "m", float(v), None) for v in values], TIDY_SCHEMA)


def numbers(df):
    return sorted(r["num_value"] for r in df.collect())


def test_a_reader_keeps_its_version(spark, tmp_path):
    uri = str(tmp_path / "store")
    assert tp.latest_version(spark, uri) is None
    assert tp.read_version(spark, uri).count() == 0
    assert tp.publish_results(tidy(spark, 1, 2), uri, "a b/c%") == 1
    before = tp.read_version(spark, uri)
    assert tp.publish_results(tidy(spark, 3), uri, "a b/c%") == 2
    assert tp.publish_results(tidy(spark, 4), uri, "d", name="other") == 3
    assert numbers(before) == numbers(tp.read_version(spark, uri, 1)) == [1.0, 2.0]
    assert numbers(tp.read_version(spark, uri)) == [3.0, 4.0]
    assert numbers(tp.read_version(spark, uri, job_id="a b/c%")) == [3.0]
    assert numbers(tp.read_version(spark, uri, job_id="d", name="other")) == [4.0]
    assert tp.read_version(spark, uri, job_id="absent").count() == 0
    assert tp.publish_results(tidy(spark), uri, "d", name="other") == 4
    assert numbers(tp.read_version(spark, uri)) == [3.0]
    assert tp.published_versions(spark, uri) == [1, 2, 3, 4]
    assert tp.read_version(spark, uri).columns == versions.RESULT_SCHEMA.names
    with pytest.raises(ValueError, match="No version"):
        tp.read_version(spark, uri, 9)
    with pytest.raises(ValueError, match="empty"):
        tp.publish_results(tidy(spark, 1), uri, "")


def test_a_change_is_made_again_on_a_newer_version(spark, tmp_path):
    uri = str(tmp_path / "store")
    tp.publish_results(tidy(spark, 1), uri, "a")
    met = []

    def change(parts):
        if not met:
            met.append(tp.publish_results(tidy(spark, 2), uri, "b"))
        return parts.where("job_id != 'a'")

    assert versions._publish(spark, uri, change) == 3
    assert met == [2]
    assert numbers(tp.read_version(spark, uri)) == [2.0]
    assert numbers(tp.read_version(spark, uri, 2)) == [1.0, 2.0]


def test_retention_publishes_a_version_without_expired_jobs(spark, tmp_path):
    uri = str(tmp_path / "store")
    for job, name, day in (("old", "x", 1), ("mixed", "x", 1), ("mixed", "y", 20), ("new", "x", 19)):
        tp.publish_results(tidy(spark, day), uri, job, name, datetime(2024, 1, day))
    before = tp.read_version(spark, uri)
    number = tp.publish_retained(spark, uri, days=7, as_of=datetime(2024, 1, 21))
    assert {r["job_id"] for r in tp.read_version(spark, uri, number).collect()} == {"mixed", "new"}
    assert tp.read_version(spark, uri).count() == 3 and before.count() == 4


def test_files_are_copied_byte_for_byte(spark, tmp_path):
    source, target = tmp_path / "from", tmp_path / "to here"
    contents = {"a.bin": bytes(range(256)) * 40_000, "deep/_hidden": b"\xff\x00", "deep/.dot": b"", "x y%20.txt": b"z"}
    for name, data in contents.items():
        path = source / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    (source / "nothing").mkdir()
    copied = tp.transfer_files(spark, f"file://{source}", str(target))
    assert {(r["path"], r["length"], r["sha256"]) for r in copied.collect()} == {
        (n, len(d), hashlib.sha256(d).hexdigest()) for n, d in contents.items()}
    assert {str(p.relative_to(target)): p.read_bytes() for p in target.rglob("*") if p.is_file()} == contents
    with pytest.raises(FileExistsError):
        tp.transfer_files(spark, str(source), str(target))
    (source / "a.bin").write_bytes(b"new")
    assert tp.transfer_files(spark, str(source), str(target), overwrite=True).count() == 4
    assert (target / "a.bin").read_bytes() == b"new"
    single = tp.transfer_files(spark, str(source / "a.bin"), str(tmp_path / "one.bin"))
    assert (single.first()["path"], (tmp_path / "one.bin").read_bytes()) == ("", b"new")
    with pytest.raises(FileNotFoundError):
        tp.transfer_files(spark, str(tmp_path / "absent"), str(target))
    assert tp.transfer_files(spark, str(source / "nothing"), str(tmp_path / "none")).count() == 0
