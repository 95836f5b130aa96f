import pytest

import drayage


@pytest.mark.parametrize("uri,bucket,key,error", [
    ("s3://b/k", "b", "k", None), ("s3://b/dir/", "b", "dir/", None), ("s3://b/", "b", "", None),
    ("s3://b", None, None, "ambiguous"), ("s3:///k", None, None, "no_bucket"), ("s3://b_1/a%20b", "b_1", "a b", None),
    ("s3://b/a+b", "b", "a+b", None), ("s3://b/a b", None, None, "syntax"), ("s3://", None, None, "syntax"),
    ("mailto:x", None, None, "syntax"), ("s3://u@b:1/k?q=1#f", "u@b:1", "k", None)])
def test_uris(spark, uri, bucket, key, error):
    row = drayage.parse_object_uri(spark.createDataFrame([(uri,)], "uri string")).first()
    assert (row["bucket"], row["key"], row["uri_error"]) == (bucket, key, error)


def test_prefix_equal_to_the_key_is_left_out(objects):
    found = drayage.filter_prefix(objects([("a/", 0), ("a/x", 1), ("ab", 1), ("a/ü/y", 1)]), "a/")
    assert {(r["key"], r["relative_path"]) for r in found.collect()} == {("a/x", "x"), ("a/ü/y", "ü/y")}


@pytest.mark.parametrize("prefix,dest,expected", [
    ("a/b/", ".", "./b/x"), ("a/", ".", "./a/b/x"), ("", ".", "./bucket/a/b/x"), ("a/b/", "out", "out/x"),
    ("a/b/", "/abs/", "/abs/x"), ("a/", "./", "./a/b/x")])
def test_recursive_targets(objects, prefix, dest, expected):
    row = drayage.map_download_targets(objects([("a/b/x", 1)]), prefix, "bucket", dest).first()
    assert row["target"] == expected


def test_marker_target_is_the_directory(objects):
    assert drayage.map_download_targets(objects([("a/sub/", 0)]), "a/", "b", "out").first()["target"] == "out/sub"


@pytest.mark.parametrize("key,is_dir,expected", [("a/b/x", True, "d/x"), ("x", True, "d/x"), ("a/b/x", False, "d")])
def test_single_targets(objects, key, is_dir, expected):
    found = drayage.map_download_targets(objects([(key, 1), ("other", 1)]), key, "b", "d", is_dir, recursive=False)
    assert [r["target"] for r in found.collect()] == [expected]


@pytest.mark.parametrize("prefix,mode,expected", [
    ("in/", "list", "in/f.txt"), ("in", "list", "inf.txt"), ("in/", "recursive", "in/d/e/f.txt"),
    ("in/", "single", "in/f.txt"), ("", "single", "f.txt"), ("in/name", "single", "in/name")])
def test_upload_keys(spark, prefix, mode, expected):
    paths = spark.createDataFrame([("d/e/f.txt",)], "source string")
    row = drayage.map_upload_keys(paths, prefix, mode).first()
    assert (row["target"], row["n_sources"]) == (expected, 1)


def test_sources_that_overwrite_each_other_are_reported(spark):
    paths = spark.createDataFrame([("a/f",), ("b/f",), ("c/g",)], "source string")
    got = {(r["source"], r["n_sources"]) for r in drayage.map_upload_keys(paths, "", "list").collect()}
    assert got == {("a/f", 2), ("b/f", 2), ("c/g", 1)}
    with pytest.raises(ValueError):
        drayage.map_upload_keys(paths, "", "other")


def test_null_sources_are_kept(spark):
    paths = spark.createDataFrame([("a/f",), (None,), (None,)], "source string")
    got = sorted(map(str, (tuple(r) for r in drayage.map_upload_keys(paths, "in/", "list").collect())))
    assert got == sorted(map(str, [("a/f", "in/f", 1), (None, None, None), (None, None, None)]))


def test_metadata(objects):
    row = drayage.attach_metadata(objects([("k", 1)]), [("a", "1"), ("b", "2"), ("a", "3")], True).first()
    assert row["metadata"] == {"a": "3", "b": "2"} and row["storage_class"] == "REDUCED_REDUNDANCY"
    row = drayage.attach_metadata(objects([("k", 1)])).first()
    assert row["metadata"] == {} and row["storage_class"] == "STANDARD"


def test_path_list_without_empty_lines(spark, tmp_path):
    (tmp_path / "list").write_bytes(b"a/b\n\nc\r\n\nd/e/\n")
    found = drayage.read_path_list(spark, str(tmp_path / "list"))
    assert {tuple(r) for r in found.collect()} == {("a/b", "b"), ("c", "c"), ("d/e/", "e")}


def test_head(objects):
    wanted = objects([("a", 0), ("a", 0), ("x", 0)]).select("key")
    got = {tuple(r) for r in drayage.head_objects(wanted, objects([("a", 3), ("b", 1)])).collect()}
    assert got == {("a", 3, "found"), ("x", None, "not_found")}


def test_table_objects_count_bytes(spark):
    df = spark.createDataFrame([("a", "é"), ("d/", "")], "key string, body string")
    got = {(r["key"], r["size"], r["is_marker"]) for r in drayage.objects_from_table(df, "key", "body").collect()}
    assert got == {("a", 2, False), ("d/", 0, True)}
