import bisect
import datetime
import random

import pytest
from pyspark.sql import functions as F

import drayage
from drayage.sources import pages as paged
from drayage.sources.pages import BucketPages, LAST, list_pages

TIME = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)


class Keys:
    """Sorted keys in memory."""

    def __init__(self, keys):
        self.keys = sorted(set(keys))

    def page(self, prefix, after, limit):
        assert limit <= 1000
        low = bisect.bisect_right(self.keys, after) if after >= prefix else bisect.bisect_left(self.keys, prefix)
        found = self.keys[low:low + limit]
        return [(key, len(key), TIME) for key in found if key.startswith(prefix)]


class Numbered:
    """A million keys of one folder."""
    n = 1_000_000

    def __len__(self):
        return self.n

    def __getitem__(self, i):
        return f"run/read-{i:07d}.fastq"

    def page(self, prefix, after, limit):
        assert limit <= 1000
        low = bisect.bisect_right(self, after)
        return [(self[i], i, TIME) for i in range(low, min(self.n, low + limit))]


def listed(df):
    return sorted(r["key"] for r in df.collect())


CASES = {
    "random": [f"p/{random.Random(i).randrange(1 << 30):x}" for i in range(800)],
    "chain": ["a" * i for i in range(1, 300)],
    "long common part": [f"x/{'y' * 200}/{i}" for i in range(500)],
    "two characters": [f"{i:012b}" for i in range(600)],
    "wide characters": [chr(0x4e00 + i) + suffix for i in range(900) for suffix in ("", "a", LAST)],
    "last characters": [LAST * i + "x" for i in range(40)] + [LAST * i for i in range(1, 40)],
    "folders": [f"{a}/{b}/" for a in "abc" for b in range(100)] + ["a", "b", "b/1", "b/1/2"],
    "one": ["k"], "none": [],
}


@pytest.mark.parametrize("name", CASES)
def test_each_key_once(spark, name):
    keys = CASES[name]
    assert listed(list_pages(spark, Keys(keys), page_size=7, pages_per_range=5)) == sorted(set(keys))


@pytest.mark.parametrize("prefix", ["", "b/", "b/1", "zz", "a"])
def test_prefixes(spark, prefix):
    keys = CASES["folders"]
    found = list_pages(spark, Keys(keys), prefix, page_size=9, pages_per_range=1)
    assert listed(found) == sorted({key for key in keys if key.startswith(prefix) and key != prefix})


def test_cuts_have_keys_on_both_sides():
    rng = random.Random(4)
    for _ in range(300):
        store = Keys("".join(rng.choices("ab" + LAST, k=rng.randint(1, 6))) for _ in range(rng.randint(1, 40)))
        after = rng.choice(store.keys)
        upto = rng.choice([None, *[key for key in store.keys if key > after]])
        cuts = paged._cuts(store, "", after, upto)
        bounds = [after, *cuts, upto or LAST * 9]
        assert bounds == sorted(set(bounds))
        if cuts:
            assert all(any(low < key <= high for key in store.keys) for low, high in zip(bounds, bounds[1:]))


def test_a_million_keys_of_one_folder(spark):
    found = list_pages(spark, Numbered(), "run/")
    row = found.agg(F.count("*").alias("n"), F.countDistinct("key").alias("keys"), F.sum("size").alias("total")).first()
    assert (row["n"], row["keys"], row["total"]) == (Numbered.n, Numbered.n, Numbered.n * (Numbered.n - 1) // 2)
    per_file = [r["count"] for r in found.groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) > 20 and max(per_file) < Numbered.n // 8


def test_markers_and_failures(spark):
    class Failing(Keys):
        def page(self, prefix, after, limit):
            raise OSError("no answer")

    rows = {r["key"]: (r["is_marker"], r["mtime"]) for r in drayage.list_pages(spark, Keys(["d/", "f"])).collect()}
    assert not rows["d/"][0] and rows["f"][1] is not None     # sizes are the lengths of the keys
    with pytest.raises(Exception, match="no answer"):
        list_pages(spark, Failing(["a"]))
    with pytest.raises(ValueError):
        list_pages(spark, Keys([]), page_size=0)


class Client:
    """Answers with three keys at most, whatever is asked for."""

    def __init__(self, keys):
        self.keys = Keys(keys)

    def list_objects_v2(self, Bucket, Prefix, MaxKeys, StartAfter="", ContinuationToken=None):
        assert Bucket == "b" and MaxKeys > 0
        found = self.keys.page(Prefix, ContinuationToken or StartAfter, min(3, MaxKeys))
        answer = {"Contents": [{"Key": key, "Size": 0, "LastModified": time} for key, _, time in found]} if found else {}
        rest = bool(found and self.keys.page(Prefix, found[-1][0], 1))
        return {**answer, "IsTruncated": rest, **({"NextContinuationToken": found[-1][0]} if rest else {})}


def test_pages_of_a_client(spark):
    keys = [f"logs/{i}" for i in range(50)] + ["logs/", "other"]
    store = BucketPages(lambda: Client(keys), "b")
    found = list_pages(spark, store, "logs/", page_size=10, pages_per_range=2)
    assert listed(found) == sorted(key for key in keys if key.startswith("logs/") and key != "logs/")
