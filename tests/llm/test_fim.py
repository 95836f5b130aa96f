"""Fill-in-middle against plain slicing of strings."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from drayage.llm import fim

UNIT = {"characters": r"(?s).", "words": r"(?s)^[\t-\r ]+|[^\t-\r ]+[\t-\r ]*", "lines": r"(?s)[^\n]*\n|[^\n]+"}


def brute(doc_id, text, unit):
    units = re.findall(UNIT[unit], text)
    assert "".join(units) == text
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    head, middle, tail = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(head), len(middle), f"<S>{tail}<P>{head}<M>{middle}"
    return n, "psm", len(head), len(middle), f"<P>{head}<S>{tail}<M>{middle}"


def texts():
    rnd = random.Random(7)
    letters = "abc é日𝄞\n \t<>PSM'"
    out = [(i, "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60)))) for i in range(150)]
    out += [(200, "x" * 9000 + " y\n" + "é" * 9000), (201, None), (202, ""), (203, "a<M>b"), (204, "<P"), (205, "\n"), (206, "  "),
            (None, "no id at all"), (207, "word " * 5000), (3, out[3][1]), (3, "another text"), (208, "𝄞" * 5000)]
    return out


@pytest.mark.parametrize("unit,block", [("characters", 4096), ("characters", 4), ("words", 7), ("lines", 5), ("words", 4096)])
def test_forms(spark, unit, block):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, form string, n int").repartition(3)
    got = fim.fill_in_middle(docs, unit, block=block).withColumn("back", fim.restored()).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *brute(i, t or "", unit), t or "") for i, t in rows), key=str)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_tree_finds_every_block():
    rnd = random.Random(8)
    for blocks in (1, 2, 3, 7, 8, 9, 33):
        counts = [(rnd.choice([0, 0, 1, 4]), rnd.randint(1, 5)) for _ in range(blocks)]
        import numpy as np
        tree = fim.Fenwick(np.array(counts, np.int64))
        starts = [(b, sum(c[0] for c in counts[:b]), sum(c[1] for c in counts[:b])) for b in range(blocks) for _ in range(counts[b][0])]
        assert [tree.before(u) for u in range(len(starts))] == starts


def test_every_cut_of_a_text():
    text = "añ\n日本 x𝄞 yy\n\n z"
    for unit in fim.UNITS:
        units = re.findall(UNIT[unit], text)
        held = fim.Text(text.encode(), unit, 4)
        assert held.units == len(units) and held.points == len(text)
        for n in range(len(units) + 1):
            head = "".join(units[:n])
            assert held.cut(n) == (len(head.encode()), len(head))


def test_other_markers_and_no_rows(spark):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(40)], "doc_id long, text string")
    marks = ("[[", "]]", "$^")
    got = fim.fill_in_middle(docs, plain=0, spm=50, salt="other", markers=marks)
    back = got.join(docs, "doc_id").where(fim.restored(markers=marks) != F.col("text"))
    assert back.count() == 0 and got.where("form = 'plain'").count() == 0 and got.where("form = 'spm'").count() > 5
    assert fim.fill_in_middle(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs, "tokens")
