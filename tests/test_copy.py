from __future__ import annotations

import hashlib
import os
import pickle
import random
from datetime import datetime

import pytest
from helpers import rows
from pyspark import cloudpickle

from tidemark.operators import copy
from tidemark.operators.copy import copy_files
from tidemark.operators.landing import land
from tidemark.operators.listing import changed_files
from tidemark.session import scratch_path
from tidemark.sources import files, stores
from tidemark.sources.files import file_inventory, read_files


def digests(root):
    found = {}
    for folder, _, names in os.walk(root):
        for name in names:
            with open(os.path.join(folder, name), "rb") as file:
                found[os.path.relpath(os.path.join(folder, name), root)] = hashlib.sha256(file.read()).hexdigest()
    return found


@pytest.fixture
def tree(tmp_path):
    root, rng = tmp_path / "in put", random.Random(3)
    for name, size in {"a.bin": 5_000_000, "p=1/b c.csv": 10, "p=2/deep/d%20e.json": 1, "z": 1_048_576}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(rng.randbytes(size))
    for name in ("_SUCCESS", "empty.txt", "_hidden.csv", ".dot.csv", "sub/_b.csv", "sub/b c.csv", "_sub2/d.csv", ".git/x"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"" if name in ("_SUCCESS", "empty.txt") else name.encode())
    return str(root)


def test_bytes_names_and_sizes_are_preserved(spark, tree, tmp_path):
    target = str(tmp_path / "out")
    manifest = copy_files(spark, tree, target, chunk_bytes=1 << 20)
    before, after = digests(tree), digests(target)
    assert before == after and "_SUCCESS" in after
    sizes = {os.path.relpath(r.dst.removeprefix("file:"), target): r.bytes for r in manifest.collect()}
    assert sizes == {name: os.path.getsize(f"{tree}/{name}") for name in before}
    assert sizes["a.bin"] == 5_000_000 and sizes["empty.txt"] == 0 and {"_hidden.csv", "_sub2/d.csv", ".git/x"} <= set(sizes)


def test_copy_overwrites_longer_files_and_can_be_repeated(spark, tree, tmp_path):
    target = tmp_path / "out"
    target.mkdir()
    (target / "z").write_bytes(b"x" * 3_000_000)
    copy_files(spark, tree, str(target), chunk_bytes=1 << 19)
    copy_files(spark, tree, f"file://{target}")
    assert digests(tree) == digests(target)


def test_whole_file_streams_go_through_a_temporary_name(tmp_path, monkeypatch):
    """The way taken on file systems that cannot write at an offset."""
    source, target = tmp_path / "a", tmp_path / "sub" / "a"
    source.write_bytes(b"new bytes")
    monkeypatch.setattr(copy, "is_posix", lambda uri: False)
    for _ in range(2):
        assert copy._copy_chunk(f"file://{source}", f"file://{target}", 0, 9, 9) == 9
        assert target.read_bytes() == b"new bytes" and os.listdir(target.parent) == ["a"]


def test_a_source_that_changes_fails_the_copy(tmp_path):
    (tmp_path / "a").write_bytes(b"grown")
    with pytest.raises(OSError, match="changed"):
        copy._copy_chunk(str(tmp_path / "a"), str(tmp_path / "b"), 0, 3, 3)


def test_executors_need_no_installed_package(spark):
    """A worker that cannot import the package still runs the task function."""
    shipped = pickle.loads(cloudpickle.dumps(copy._copier))
    assert shipped is not copy._copier and shipped.__module__ == copy.__name__


def test_single_file(spark, tree, tmp_path):
    copy_files(spark, f"{tree}/a.bin", str(tmp_path / "one"))
    assert digests(tmp_path / "one")["a.bin"] == digests(tree)["a.bin"]


def test_modification_window(spark, tree, tmp_path):
    old, new = datetime(2024, 1, 1).timestamp(), datetime(2024, 2, 1).timestamp()
    for folder, _, names in os.walk(tree):
        for name in names:
            os.utime(os.path.join(folder, name), (old, old))
    os.utime(f"{tree}/z", (new, new))
    target = str(tmp_path / "late")
    copy_files(spark, tree, target, modified_after="2024-01-15", modified_until="2024-03-01")
    assert set(digests(target)) == {"z", "_SUCCESS"}


def test_nothing_to_copy(spark, tree, tmp_path):
    manifest = copy_files(spark, tree, str(tmp_path / "none"), modified_after="2999-01-01")
    assert manifest.count() == 0


def test_copied_rows_read_back(spark):
    source = land(spark.range(100).repartition(5), scratch_path(spark, "src"))
    target = scratch_path(spark, "dst")
    assert copy_files(spark, source, target).where("dst rlike '/part-'").count() == 5
    assert rows(read_files(spark, target)) == [(i,) for i in range(100)]


def test_settings_of_the_bucket_reach_the_client(spark, monkeypatch):
    from pyarrow import fs

    from tidemark.sources import stores
    from tidemark.sources.storage import configure_s3a

    secret = {"aws_access_key_id": "me", "aws_secret_access_key": "s/+", "aws_region": "xx-1", "aws_endpoint": "http://store:9000"}
    configure_s3a(spark, secret, bucket="own-bucket")
    found = stores.store_settings(spark, "s3a://own-bucket/a b.csv")
    seen = {}
    monkeypatch.setattr(fs, "S3FileSystem", lambda **known: seen.update(known))
    assert stores.open_store("s3a://own-bucket/a b%20.csv", found)[1] == "own-bucket/a b%20.csv"
    assert seen == {"access_key": "me", "secret_key": "s/+", "region": "xx-1", "endpoint_override": "store:9000", "scheme": "http"}


def test_uris_are_taken_apart_as_written():
    from tidemark.sources.stores import split_uri

    assert split_uri("hdfs://n:8020/a b#c?d") == ("hdfs", "n:8020", "/a b#c?d")
    assert split_uri("/x/y:z") == ("", "", "/x/y:z") and split_uri("file:/x") == ("file", "", "/x")


def test_a_task_walks_so_many_folders_and_hands_on_the_rest(spark, tmp_path, monkeypatch):
    want = {}
    for i in range(60):
        folder = tmp_path / "deep" / f"a{i % 7}" / f"b{i % 11}" / f"_c{i}"
        folder.mkdir(parents=True)
        (folder / f"f{i}").write_bytes(b"x" * i)
        want[f"file:{folder}/f{i}"] = i
    (tmp_path / "deep" / "empty").mkdir()
    monkeypatch.setattr(files, "tree_lister", lambda settings, recursive: stores.tree_lister(settings, recursive, 3))
    got = file_inventory(spark, str(tmp_path / "deep"), recursive=True).collect()
    assert {r.path: r.length for r in got} == want and len(got) == 60
    assert file_inventory(spark, str(tmp_path / "deep")).collect() == []
    assert [r.length for r in file_inventory(spark, f"{tmp_path}/deep/a3/b3/_c3/f3", recursive=True).collect()] == [3]


def test_changed_files_are_new_paths_and_other_sizes_or_times(spark):
    ddl = "path string, modificationTime timestamp, length bigint"
    day = [datetime(2024, 1, d) for d in range(1, 10)]
    seen = spark.createDataFrame([("a", day[1], 1), ("b", day[1], 1), ("c", day[1], 1), ("d", None, 1), ("gone", day[1], 1)], ddl)
    now = spark.createDataFrame([("a", day[1], 1), ("b", day[0], 1), ("c", day[1], 2), ("d", None, 1), ("old", day[0], 1), ("same", day[1], 1)], ddl)
    assert [r.path for r in changed_files(now, seen).orderBy("path").collect()] == ["b", "c", "old", "same"]
    assert changed_files(now, seen.limit(0)).count() == 6 and changed_files(now.limit(0), seen).count() == 0


def test_a_listing_made_before_is_not_made_again(spark, tree, tmp_path, monkeypatch):
    found = file_inventory(spark, tree, recursive=True)
    monkeypatch.setattr(copy, "file_inventory", None)
    copy_files(spark, tree, str(tmp_path / "some"), files=found.where("length > 100"))
    assert set(digests(tmp_path / "some")) == {"_SUCCESS", "a.bin", "z"}
