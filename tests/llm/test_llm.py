"""The operators against brute force, on small tables with nulls, empty texts, ties, repeated rows and clashing columns."""

import hashlib
import io
import math
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from drayage.llm import contexttree, decontaminate, hosts, maintext, nearcopies, packing, quality, simhash, suffixes, topk, warc

LONG = "many words that go on and on, one after the other, until there are more than a hundred bytes of them in a row "


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(3)
    words = ["la", "the", "Äh", "on", "re", "ÉT", "und", "it", "zu", "x9"]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 120))) for _ in range(30)]
    near = [base[0] + " end", base[1].replace("la", "le", 1), LONG + base[2], base[3][:40] + LONG + base[3][40:], "aa " * 150]
    texts = base + near + base[:4] + [None, "", " \t\n", "one", "two words", LONG * 3]
    rows = [(i, t, 7.0, "k") for i, t in enumerate(texts)] + [(3, base[3], 1.0, "k"), (3, "another text", 1.0, "k"), (None, base[5], 1.0, "k")]
    return spark.createDataFrame(rows, "doc_id long, text string, score double, key_id string").repartition(3)


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_simhash(docs):
    got = simhash.near_duplicates(docs).collect()
    texts = rows(docs)
    assert len(got) == len(texts)
    prints = {simhash.fingerprint((t or "").encode()) for _, t in texts}
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in prints:
        for b in prints:
            if bin(a ^ b).count("1") <= 2:
                parent[find(a)] = find(b)
    least = {}
    for i, t in texts:
        root = find(simhash.fingerprint((t or "").encode()))
        least[root] = min(x for x in (least.get(root), i) if x is not None) if (least.get(root), i) != (None, None) else None
    want = sorted((str(i), least[find(simhash.fingerprint((t or "").encode()))]) for i, t in texts)
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in got) == want
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({find(p) for p in prints})


def test_fingerprint_by_hand():
    import xxhash
    words = "a B c d".lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(2)]
    assert simhash.fingerprint(b"a B\tc  d") == hashes[0] & hashes[1]
    assert simhash.fingerprint(b"") == 0 and simhash.fingerprint(b"x Y") == xxhash.xxh64_intdigest(b"x y", 42)


@pytest.mark.parametrize("pairwise", [64, 1])
def test_links_by_pairs_and_by_variants(spark, pairwise):
    rnd = random.Random(1)
    centres = [rnd.getrandbits(64) for _ in range(5)]
    prints = {c ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) ^ (rnd.random() < 0.5) for c in centres for _ in range(30)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = simhash.components(simhash.close_links(spark.createDataFrame([(p,) for p in signed], "fp long"), pairwise)).collect()
    label = {r["node"]: r["component"] for r in got}
    want = {p: p for p in signed}
    for _ in range(len(signed)):
        new = {a: min(want[b] for b in signed if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 2) for a in signed}
        if new == want:
            break
        want = new
    assert {p: label.get(p, p) for p in signed} == want


@pytest.mark.parametrize("pairwise", [32, 12])
def test_near_copies_of_the_pipeline(spark, docs, pairwise):
    """One word of 150 replaced far from the others: similar by five-word shingles, more than two bits apart."""
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = dict(enumerate(" ".join(rnd.choice(vocabulary) for _ in range(150)) for _ in range(4)))
    for i in range(40):
        words = texts[i % 4].split()
        for j in range(i // 4 % 5):
            words[20 + 25 * j] = f"new{i}x{j}"
        texts[10 + i] = " ".join(words)
    given = spark.createDataFrame(list(texts.items()), "doc_id long, text string").unionByName(docs.select("doc_id", "text"))

    def brute(text):
        words = (text or "").encode().lower().split()
        return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()
    sets = list({brute(t) for _, t in rows(given)})
    parent = {s: s for s in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in sets:
        for b in sets:
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                parent[find(a)] = find(b)
    least = {}
    for i, t in rows(given):
        root = find(brute(t))
        least[root] = min(x for x in (least.get(root), i) if x is not None) if (least.get(root), i) != (None, None) else None
    found = nearcopies.near_copies(given, pairwise).collect()
    assert len({r["component"] for r in found}) == len(least) and len(found) == len(rows(given))
    if pairwise == 32:
        import corpus_pipeline
        kept = corpus_pipeline.drop_near_duplicates(spark, given, "")
        assert sorted(str(i) for i, _ in rows(kept)) == sorted(str(i) for i in least.values())


def test_fingerprints_of_the_pipeline(spark):
    """Sets at two or fewer bits are linked by their fingerprints if they are similar, and only then."""
    from drayage.llm.common import row_key, utf8
    from drayage.materialize import Scratch
    rnd = random.Random(11)
    texts = {}
    for i in range(6):
        words = [f"w{rnd.randrange(900)}" for _ in range(1500)]
        for j in range(5):
            texts[10 * i + j] = " ".join(words + [f"tail{j}"] * (j > 0))
    texts[100], texts[101] = "", "few words"
    given = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    given = given.select("doc_id", utf8("text").alias("t"), *row_key(given))
    scratch = Scratch(spark)
    _, sets = nearcopies.distinct_sets(scratch, given)
    found = {nearcopies._set_id(x): x for x in (nearcopies.shingles(t.encode()) for t in texts.values())}
    prints = {r["set_id"]: r["fp"] & (2 ** 64 - 1) for r in sets.collect()}
    assert prints == {k: sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in x) > len(x)) for k, x in found.items()}

    def parts(links):
        label = {k: k for k in found}
        for _ in found:
            for a, b in links:
                label[a] = label[b] = min(label[a], label[b])
        return label
    near = [(a, b) for a in found for b in found if a != b and bin(prints[a] ^ prints[b]).count("1") <= 2]
    assert near and all(nearcopies.similar(found[a], found[b]) for a, b in near)
    links = [(r["a"], r["b"]) for r in nearcopies.fingerprint_links(scratch, sets, given).collect()]
    assert parts(links) == parts(near)
    first = min(found)
    alike = {(first, k) for k in found if k != first and nearcopies.similar(found[first], found[k])}
    assert {(r["a"], r["b"]) for r in nearcopies.fingerprint_links(scratch, sets.withColumn("fp", F.lit(5).cast("long")), given).collect()} == alike


def test_parities_of_long_sets(spark, monkeypatch):
    """Long sets that aren't similar don't pass the bound, and sets whose parities have unlike lengths can be held together."""
    from drayage import materialize
    rnd = random.Random(12)
    words = [[f"w{rnd.randrange(3000)}" for _ in range(1040)] for _ in range(8)]
    texts = dict(enumerate([" ".join(w) for w in words] + [" ".join(w[:1010]) for w in words[:4]]))
    given = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    from drayage.llm.common import row_key, utf8
    given = given.select("doc_id", utf8("text").alias("t"), *row_key(given))
    scratch, sizes, keep = materialize.Scratch(spark), {}, materialize.Scratch.keep

    def counted(self, df, label):
        kept = keep(self, df, label)
        sizes[label] = kept.count()
        return kept
    monkeypatch.setattr(materialize.Scratch, "keep", counted)
    _, sets = nearcopies.distinct_sets(scratch, given)
    found = {i: nearcopies.shingles(t.encode()) for i, t in texts.items()}
    of = {i: nearcopies._set_id(x) for i, x in found.items()}
    assert {len(nearcopies.parity(x, nearcopies.parity_longs(len(x)))) for x in found.values()} == {16, 32}
    pairs = spark.createDataFrame([(of[i], of[j]) for i in found for j in found if i < j], "a long, b long")
    got = {(r["a"], r["b"]) for r in nearcopies._verified(scratch, pairs, sets, given).collect()}
    assert got == {(of[i], of[i + 8]) for i in range(4)} and sizes["close-pairs"] == 4


def test_texts_of_kept_rows_are_not_shuffled(docs):
    """Only rows that go or repeat, and what shares their bits, are dealt out by key."""
    whole = docs.unionByName(docs.where("doc_id in (3, 5)"))
    kept = simhash.representatives(whole)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    stay = [line for line in plan.splitlines() if line.startswith(":")]
    assert plan.startswith("Union") and stay and not any("Aggregate" in line or "Join" in line for line in stay)
    got = [tuple(r) for r in kept.collect()]
    assert len(got) == len(set(got)) == len(set(r["component"] for r in simhash.near_duplicates(whole).collect()))
    assert set(got) <= {tuple(r) for r in docs.collect()} and kept.columns == docs.columns


def test_near_copies_with_a_common_head(spark, monkeypatch):
    """Keys that many sets share which aren't similar: hubs until nothing is open."""
    monkeypatch.setattr(nearcopies, "COMMON", 1 << 30)
    rnd = random.Random(9)
    head, texts = [f"h{i}" for i in range(40)], []
    for i in range(24):
        body = [f"b{rnd.randrange(6)}x{j}" for j in range(rnd.choice([2, 6, 16, 30]))]
        texts.append(" ".join(head[:rnd.choice([30, 38, 40])] + body))
    sets = [frozenset(nearcopies.shingles(t.encode()).tolist()) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        label = [min(label[j] for j in range(len(texts)) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])) for i in range(len(texts))]
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in nearcopies.near_copies(given, 6).collect():
        got.setdefault(r["component"], set()).add(r["doc_id"])
    want = {}
    for i, c in enumerate(label):
        want.setdefault(c, set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values())) and 1 < len(want) < len(texts)


def test_large_groups_of_near_copies_are_not_held_all_against_all(spark, monkeypatch):
    """Up to six words of 150 replaced, each in another place: many pairs of the group aren't similar, the hubs still join it."""
    from drayage import materialize
    rnd, keep, asked = random.Random(13), materialize.Scratch.keep, []
    base, edits = [f"w{i}" for i in range(150)], [1] * 10 + [2] * 7 + [3] * 5 + [4] * 4 + [5] * 2 + [6]

    def counted(self, df, label):
        kept = keep(self, df, label)
        if label == "candidates":
            asked.append(kept.count())
        return kept
    monkeypatch.setattr(materialize.Scratch, "keep", counted)
    many = 600
    texts = []
    for i in range(many):
        words = list(base)
        for j in rnd.sample(range(150), rnd.choice(edits)):
            words[j] = f"new{i}x{j}"
        texts.append(" ".join(words))
    parts = [frozenset(nearcopies.shingles(t.encode()).tolist()) for t in texts]
    label, old = list(range(many)), None
    alike = [[j for j in range(many) if 9 * len(parts[i] & parts[j]) >= 4 * (len(parts[i]) + len(parts[j]))] for i in range(many)]
    while label != old:
        label, old = [min(label[j] for j in alike[i]) for i in range(many)], label
    got = {}
    for r in nearcopies.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 8).collect():
        got.setdefault(r["component"], []).append(r["doc_id"])
    assert sorted(min(x) for x in got.values()) == sorted(set(label))
    assert many < sum(asked) <= 6 * many


def test_parity_is_a_lower_bound():
    rnd = np.random.default_rng(10)
    for _ in range(50):
        a, b = (np.unique(rnd.integers(0, 1 << 62, rnd.integers(1, 900)).astype(np.uint64)) for _ in range(2))
        b = np.union1d(b[:rnd.integers(0, 80)], a)
        differ = sum(bin(int(x) & (2 ** 64 - 1)).count("1") for x in nearcopies.parity(a) ^ nearcopies.parity(b))
        assert differ <= len(np.setxor1d(a, b))


def brute_suffixes(texts):
    seen, out = set(), {}
    for key in sorted(texts):
        data = texts[key]
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            piece = data[s:s + 100]
            if piece in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(piece)
        out[key] = bytes(b for b, g in zip(data, gone) if not g)
    return out


def test_suffixes(docs):
    got = suffixes.remove_repeats(docs).withColumn("h", F.hash(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))).collect()
    texts = {(-(1 << 63) if r["doc_id"] is None else r["doc_id"], r["h"]): (r["text"] or "").encode() for r in got}
    want = brute_suffixes(texts)
    assert len(got) == docs.count() and set(docs.columns) < set(got[0].asDict())
    for r in got:
        key = (-(1 << 63) if r["doc_id"] is None else r["doc_id"], r["h"])
        assert bytes(r["repeats"]["kept"]) == want[key], key
        assert r["repeats"]["n_removed"] == len(texts[key]) - len(want[key])
    assert suffixes.without_repeats(docs).columns == docs.columns


def test_suffixes_in_pieces_and_tiny_batches(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 300)
    rnd = random.Random(2)
    texts = {(i, i): bytes(rnd.choice(b"ab") for _ in range(rnd.randint(90, 900))) for i in range(12)}
    texts[12, 12] = texts[3, 3][50:400] + b"zz" + texts[4, 4][:150]
    texts[13, 13] = b"a" * 700
    ids = np.arange(14)
    want = brute_suffixes(texts)
    found = list(suffixes._sampled([texts[i, i] for i in range(14)]))
    removed = {i: [] for i in range(14)}
    for batch in suffixes._reduced(found, ids, ids * 0, ids, suffixes.SPAN):
        for kind, context, doc in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3))):
            if kind == suffixes.REPEAT:
                removed[doc].append(context)
    for i in range(14):     # contexts only: never more than what repeats
        assert len(suffixes._cut(texts[i, i], removed[i])[0]) >= len(want[i, i])
    assert suffixes._cut(texts[13, 13], removed[13])[0] == want[13, 13]


def brute_contamination(texts, items):
    import re
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans(decontaminate.UPPER, decontaminate.LOWER)

    def words(t):
        return pattern.findall((t or "").translate(low))
    windows = {}
    for item, t in items:
        w = words(t)
        n = min(len(w), 13)
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for i, t in texts:
        w, hit, found = words(t), set(), set()
        for line, of in windows.items():
            for s in range(len(w) - len(line) + 1):
                if tuple(w[s:s + len(line)]) == line:
                    hit |= set(range(s, s + len(line)))
                    found |= of
        out.append((str(i), len(w), len(hit), sorted(str(x) for x in found)))
    return sorted(out)


@pytest.mark.parametrize("bound", [100_000, 0])
def test_decontaminate(spark, docs, bound):
    texts = rows(docs)
    long = [t for _, t in texts if t and len(t.split()) > 40]
    items = [(1, " ".join(long[0].split()[3:30])), (2, LONG), (3, "Two words"), (4, None), (5, "!!"), (10, LONG.upper()), (6, "AA aa")]
    got = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string"), max_broadcast=bound)
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], list(r["item_ids"])) for r in got.collect()) == brute_contamination(texts, items)
    if bound:
        assert "Python" not in got._jdf.queryExecution().toString() and "Arrow" not in got._jdf.queryExecution().toString()
        clean = decontaminate.uncontaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
        assert clean.columns == docs.columns and clean.count() < docs.count()


def test_packing(docs):
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(packing.public_vocabulary())
    got = packing.pack(docs, packing.public_vocabulary, packing.public_ranks, packing.public_pattern, size=64).collect()
    by_doc = {}
    for i, t in rows(docs):
        by_doc.setdefault(i, []).append(exact.encode(t or "", add_special_tokens=False).ids + [1])
    sequences, pieces = {}, {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault(r["doc_id"], []).append(r)
        assert any(zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]
                   and len(ids) == r["doc_tokens"] for ids in by_doc[r["doc_id"]])
    for doc_id, all_ids in by_doc.items():
        assert sum(r["length"] for r in pieces[doc_id]) == sum(map(len, all_ids))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64 and at & (at - 1) == 0


def test_fill_finds_the_closest_sum():
    import itertools
    rnd = random.Random(4)
    for _ in range(60):
        lengths = [rnd.randint(1, 30) for _ in range(7)]
        counts = {x: lengths.count(x) for x in lengths}
        capacity = rnd.randint(1, 80)
        best = max(sum(c) for n in range(8) for c in itertools.combinations(lengths, n) if sum(c) <= capacity)
        used = packing.fill(counts, capacity)
        assert sum(k * n for k, n in used.items()) == best and all(n <= counts[k] for k, n in used.items())


def test_tokens_agree_with_the_exact_library():
    tokens = packing.Tokens(packing.public_vocabulary(), packing.public_ranks(), packing.public_pattern())
    for text in ("plain  text\n\n it's 12", "É où ß x", "a <|endoftext|> b", "日本 x", "\x1c\x85 y", ""):
        assert tokens(text.encode()).tolist() == tokens.exact.encode(text, add_special_tokens=False).ids


def test_quality_learns_and_scores_in_pieces(monkeypatch):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("aeioulnrst") for _ in range(rnd.randint(2, 9)))
    good = [" ".join(word() for _ in range(rnd.randint(20, 200))) + "." for _ in range(120)]
    bad = [" ".join(word().upper() + "!!" for _ in range(rnd.randint(20, 200))) for _ in range(120)]
    texts = [t.encode() for t in good + bad]
    net = quality.fit(texts[:100] + texts[120:220], [1] * 100 + [0] * 100, 0.5)
    got = quality.scores(texts, net)
    assert (got[100:120] > 0.5).mean() > 0.9 and (got[220:] < 0.5).mean() > 0.9
    long = b" ".join(texts[:60])
    whole = quality.scores([long], net)[0]
    monkeypatch.setattr(quality, "PIECE", 4 * quality.BLOCK)
    assert quality.scores([long], net)[0] == pytest.approx(whole, abs=0.02)
    assert 0 <= quality.scores([b""], net)[0] <= 1
    assert quality.scores([b"", b"x"], quality.fit([], [], 0.5)) == pytest.approx(0.5)


def test_gradients_are_right():
    texts = [b"abc def " * 40, b"x", b"QQ!! " * 100]
    net = quality.fit(texts, [1, 1, 1], 0.7)    # one class: parameters as they begin
    net.weights[:] = np.random.default_rng(0).normal(0, 1, len(net.weights))
    codes, first, valid = quality._laid_out(texts)
    labels, loads = np.array([1, 0, 0], np.float32), np.ones(3, np.float32)

    def loss():
        p = quality._sigmoid(quality._forward(codes, first, valid, net)[0] @ net.weights + net.bias)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))
    grads = quality._gradients(codes, first, valid, labels, loads, net)
    for p, g in zip(net.parameters(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, size = p[at], 1e-2
        p[at] = old + size
        up = loss()
        p[at] = old - size
        down = loss()
        p[at] = old
        assert (up - down) / (2 * size) == pytest.approx(g[at], rel=0.1, abs=1e-3)


def test_topk(spark):
    rnd = np.random.default_rng(6)
    vectors = [(i, [float(x) for x in rnd.normal(0, 1, 20)]) for i in range(300)]
    vectors += [(300, vectors[5][1]), (301, None), (302, [float("nan")] * 20), (303, [float("inf")] + [0.0] * 19),
                (304, [None] + [1.0] * 19), (400, []), (500, [1e20] * 20), (501, [1.0] * 3), (None, [1.0] * 20), (7, vectors[7][1])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = {}
    for r in topk.top_k(df, df.where("vec_id % 100 = 0"), k=5, step=4).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    usable = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for i, q in usable:
        if i % 100 == 0:
            scores = sorted(((min(max(sum(x * y for x, y in zip(q, v)), -(1 << 63)), (1 << 63) - 1), j) for j, v in usable if j != i and len(v) == len(q)),
                            key=lambda s: (-s[0], s[1]))[:5]
            assert sorted(got.get(i, [])) == [(n, s, j) for n, (s, j) in enumerate(scores, 1)], i


def test_topk_of_repeated_queries_with_unusable_vectors(spark):
    rows = [(100, [1.0, 2.0]), (100, [float("nan"), 1.0]), (100, [float("inf"), 1.0]), (100, [0.5, 9.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(df, df.where("vec_id = 100")).orderBy("rank").collect()]
    assert got == [(100, 1, 2, 2 * 1024 ** 2), (100, 2, 1, 1024 ** 2)]


def test_trust_reaches_hosts_sixty_links_away(spark):
    hosts_ = [f"h{i:02d}" for i in range(61)]
    links = spark.createDataFrame([(a, b, 1) for a, b in zip(hosts_, hosts_[1:])] + [("h10", "h40", 3)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("h00", 1.0, 0.0), ("h60", 0.0, 1.0)], "host string, good double, bad double")
    got = {r["host"]: (r["trust"], r["distrust"]) for r in hosts.propagate(seeds, links).collect()}
    edges = [(i, i + 1, 1) for i in range(60)] + [(10, 40, 3)]
    t, d = [0.0] * 61, [0.0] * 61
    for _ in range(400):
        t = [0.15 * (h == 0) + 0.85 * sum(t[a] * n / sum(m for x, _, m in edges if x == a) for a, b, n in edges if b == h) for h in range(61)]
        d = [0.15 * (h == 60) + 0.85 * sum(d[b] * n / sum(m for _, y, m in edges if y == b) for a, b, n in edges if a == h) for h in range(61)]
    for h, name in enumerate(hosts_):
        assert got[name] == pytest.approx((t[h], d[h]), rel=1e-6, abs=1e-9)
    assert got["h00"][1] > 0
    with pytest.raises(RuntimeError):
        hosts.propagate(seeds, links, rounds=5)


def test_sample_is_filled_from_usable_texts_and_says_when_it_cannot(spark):
    folds = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame([(i, "x" * 20_000 if i % 3 else f"short {i}") for i in folds[:300]] + [(None, "no id")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(folds[:600])] + [(folds[0], 0), (None, 1)], "doc_id long, quality int")
    texts, marks, share = quality.labelled_sample(docs, labels, per_class=20)
    assert len(texts) == 40 and sum(marks) == 20 and all(t.startswith(b"short") for t in texts) and 0.4 < share < 0.6
    with pytest.warns(UserWarning):
        texts, _, share = quality.labelled_sample(docs, labels.where("quality = 1"))
    assert texts == [] and share == 1.0


def test_scores_are_those_of_a_plain_loop():
    """The forward pass, written out byte by byte and chunk by chunk."""
    rnd = random.Random(11)
    texts = [bytes(rnd.randrange(32, 127) for _ in range(rnd.choice([0, 1, 7, 255, 256, 300, 1200]))) for _ in range(12)]
    net = quality.fit([b"abc def " * 40, b"QQ!! " * 100] * 10, [1, 0] * 10, 0.5)
    got = quality.scores(texts, net)
    single = [quality.scores([t], net)[0] for t in texts]
    assert got == pytest.approx(single, abs=1e-5)


def test_stage_three_with_a_column_of_its_own_name(spark):
    docs = spark.createDataFrame([(1, "ab" * 90, "x", 7), (2, "cd" + "ab" * 90, "y", 8), (3, None, "z", 9)], "doc_id long, text string, repeats string, Repeats_ int")
    got = {r["doc_id"]: (r["text"], r["repeats"]) for r in suffixes.without_repeats(docs).collect()}
    want = brute_suffixes({(i, 0): (t or "").encode() for i, t in [(1, "ab" * 90), (2, "cd" + "ab" * 90)]})
    assert got[1] == (want[1, 0].decode(), "x") and got[2] == (want[2, 0].decode(), "y") and got[3] == (None, "z")


def test_warc(spark, tmp_path):
    pages = [(i, f"http://h/{i}", h) for i, h in enumerate(["<p>a</p>", "", None, "<p>a</p>", "é" * 5000, "", "\r\n\r\nWARC/1.1\r\n"])]
    df = spark.createDataFrame(pages + [(1, "x", ""), (None, None, "<p>a</p>")], "page_id long, url string, html string").coalesce(1)
    archives, root = warc.archive_pages(df, str(tmp_path))
    got = sorted(((r["page_id"] is None, r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                  for r in warc.read_archives(archives, root).collect()), key=str)
    first = {}
    want = []
    for i, _, h in pages + [(1, "x", ""), (None, None, "<p>a</p>")]:
        data = (h or "").encode()
        digest = warc.base32(hashlib.sha1(data).digest())
        known = first.get(digest)
        want.append((i is None, i or 0, len(data), digest, "response" if known is None else "revisit", known))
        first.setdefault(digest, i)
    assert got == sorted(want, key=str)
    # the monolithic stream and the members hold the same number of records
    name = archives.first()["archive"]
    stream = io.BufferedReader(warc.Inflated(open(f"{root}/stream/{name}", "rb")))
    assert sum(1 for _ in iter(lambda: warc.read_record(stream), None)) == len(want)
    assert len(open(f"{root}/members/{name}.idx").readlines()) == len(want)


def test_hosts(spark):
    good, bad = "http://a.com/x", "http://b.net/es/1"
    pages = [(1, good, '<a href="http://c.org/">'), (2, bad, '<a href=/x>'), (3, "http://C.org/", ""), (4, "http://d.org/?q", "<A HREF='//b.net/'>"),
             (5, None, None), (6, "nothing", "x"), (7, "https://www.example.com/en/1#a", ""), (8, "http://x.example.com/en/2", ""), (9, "http://com", ""),
             (10, "http://b.net/de", "")]
    df = spark.createDataFrame(pages + [(11, bad, "")], "page_id long, url string, html string")
    judged = hosts.judge(df)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judged.collect()}
    assert got[1] == ("a.com", "/x", "com/", "allow") and got[2] == ("b.net", "/es/1", "net/es/", "block")
    assert got[3][3] == "allow" and got[4] == ("d.org", "/", None, "block") and got[5] == ("", "", None, "allow")
    assert got[6] == ("", "", None, "allow") and got[7][2] == "www.example.com/en/" and got[8][2:] == ("example.com/en/", "block")
    assert got[9] == ("com", "", None, "allow") and got[10] == ("b.net", "/de", None, "block")
    seeds = spark.createDataFrame([("a", 1.0, 0.0), ("b", 0.0, 1.0)], "host string, good double, bad double")
    links = spark.createDataFrame([("a", "c", 2), ("c", "d", 1), ("c", "b", 3), ("d", "b", 1)], "src string, dst string, n long")
    got = {r["host"]: (r["trust"], r["distrust"]) for r in hosts.propagate(seeds, links).collect()}
    t, d = dict.fromkeys("abcd", 0.0), dict.fromkeys("abcd", 0.0)
    edges = [("a", "c", 2), ("c", "d", 1), ("c", "b", 3), ("d", "b", 1)]
    for _ in range(50):
        t = {h: 0.15 * (h == "a") + 0.85 * sum(t[s] * n / sum(m for x, _, m in edges if x == s) for s, e, n in edges if e == h) for h in t}
        d = {h: 0.15 * (h == "b") + 0.85 * sum(d[e] * n / sum(m for _, x, m in edges if x == e) for s, e, n in edges if s == h) for h in d}
    for h in t:
        assert got[h] == pytest.approx((t[h], d[h]), abs=1e-7)


def test_main_text(spark):
    article = "<article><h1>T &amp; x</h1><p>First   para\n here.<p>Second <b>bold</b> one.</article>"
    page = f"<html><head><title>no</title><style>p{{}}</style></head><body><nav><a href=/>Home</a></nav>{article}<footer>&copy; foot</footer></body></html>"
    pages = [(i, "u", page) for i in range(5)] + [(9, None, None), (10, "u", "<p"), (11, "u", "< <<>>"), (12, "u", page[:page.index("Second")])]
    got = {r["page_id"]: r for r in maintext.main_texts(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[0]["text"] == "T & x\nFirst para here.\nSecond bold one." and got[0]["n_chars"] == len(got[0]["text"])
    assert got[9]["text"] == "" and got[12]["text"] == "T & x\nFirst para here."


def test_marginals_are_those_of_all_labellings():
    import itertools
    model = maintext.fit([(*maintext._hand_labelled(x), 1) for x in maintext.BY_HAND])
    page = maintext.Page("<div class=content><p>words here<a href=x>link</a></p></div><nav>menu</nav>")
    totals, n = [0.0] * len(page.tags), len(page.tags)
    for labels in itertools.product((0, 1), repeat=n):
        log = model.root[labels[0]]
        for i, values in enumerate(page.seen()):
            log += sum((model.seen.get(v) or model.unseen[v[0]])[labels[i]] for v in values)
            log += model.child.get(page.pair_kinds()[i], model.any)[labels[page.parents[i]]][labels[i]] if i else 0
        totals = [t + math.exp(log) * y for t, y in zip(totals, labels)] + [0] * 0
        totals_all = locals().get("totals_all", 0.0) + math.exp(log)
    assert model.marginals(page) == pytest.approx([t / totals_all for t in totals], rel=1e-6)


def brute_tree(texts, depth=contexttree.DEPTH):
    """Probabilities from counts per (context, bits before), by plain recursion over the contexts met in training."""
    counts = {}
    for text in texts:
        data = contexttree.START + text.lower() + contexttree.END
        for i in range(depth, len(data)):
            for bit in range(8):
                prefix, one = (1 << bit) | data[i] >> (8 - bit), data[i] >> (7 - bit) & 1
                for d in range(depth + 1):
                    counts.setdefault((data[i - d:i], prefix), [0, 0])[one] += 1
    children = {}
    for context, prefix in counts:
        if context:
            children.setdefault((context[1:], prefix), []).append((context, prefix))

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(node):
        own = kt(*counts[node])
        if len(node[0]) == depth:
            return own, 1.0
        below = sum(weighted(c)[0] for c in children[node])
        both = np.logaddexp(own, below)
        return both - math.log(2), math.exp(own - both)

    def probability(history, prefix, one, d=0):
        node = (history[len(history) - d:], prefix)
        if node not in counts:
            return 0.5 if d == 0 else None
        n = counts[node]
        own = (n[one] + 0.5) / (sum(n) + 1)
        deeper = probability(history, prefix, one, d + 1) if d < depth else None
        share = weighted(node)[1] if deeper is not None else 1.0
        return share * own + (1 - share) * (deeper or 0.0)

    def score(text):
        data = contexttree.START + text.lower() + contexttree.END
        return sum(math.log10(probability(data[i - depth:i], (1 << b) | data[i] >> (8 - b), data[i] >> (7 - b) & 1))
                   for i in range(depth, len(data)) for b in range(8))
    return score


@pytest.mark.parametrize("lookup_rows", [4_000_000, 0])
def test_context_tree(spark, lookup_rows):
    texts = [(i, t) for i, t in enumerate(["the cat", "the hat", "A bat ate", "", None, "the cat", "zz top", "tha catalog", "x", "bat bat"])]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r for r in contexttree.score(df, lookup_rows, frequent=4).collect()}
    held = {i for i, _ in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    assert held and len(got) == len(texts)
    tree = brute_tree([(t or "").encode() for i, t in texts if i not in held])
    train = [w for i, t in texts if i not in held for w in (t or "").lower().split() + [None]]
    for i, t in texts:
        words = (t or "").lower().split() + [None]
        r = got[i]
        assert r["held_out"] == (i in held) and r["n_tokens"] == len(words) and r["train_tokens"] == len(train)
        assert r["n_known"] == sum(w in train for w in words)
        assert r["base_score"] == pytest.approx(sum(math.log10((train.count(w) + 1) / (len(train) + len(set(train)) + 1)) for w in words))
        assert r["score"] == pytest.approx(tree((t or "").encode()), rel=1e-9)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert suffixes.remove_repeats(docs).count() == 0
    assert decontaminate.contamination(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert packing.pack(docs, packing.public_vocabulary).count() == 0
    assert nearcopies.near_copies(docs).count() == 0
    assert quality.accepted(docs, spark.createDataFrame([], "doc_id long, quality int")).count() == 0
    assert contexttree.score(docs).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(vectors, vectors).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    archives, root = warc.archive_pages(pages)
    assert warc.read_archives(archives, root).count() == 0
    assert hosts.judge(pages).count() == 0 and maintext.main_texts(pages).count() == 0


def test_main_text_survives_controls_and_apostrophes():
    model = maintext.fit([(*maintext._hand_labelled(x), 1) for x in maintext.BY_HAND])
    words = "Words of the article that go on for a while, and then some more of them."
    article = f'<article class="content"><p>{words}</p></article>'
    for head in ('<svg class="logo"/>', "<button>Menu", "<svg><path d='M0'>", "<select><option>One", "<p title=it's>", "<template>"):
        assert words in model.main_text(f"<html><body><header>{head}</header>{article}<p class=x>it's</p></body></html>"), head
        assert words in model.main_text(f"<html><body>{head}{article}</body></html>"), head
    inside = model.main_text(article.replace("a while", "a <math><mi>while</mi></math>").replace(
        "</p>", "<button><b>Press</b></button><svg><text>Drawn</text></svg><template><p>Inert</p></template></p>"))
    assert inside == words
    page = maintext.Page("<button><p>in</p></button><button>b<p>after</p>")
    assert page.text([h for h in page.hidden()]) == "in\nb"


@pytest.mark.parametrize("length", [200, 1500])
def test_packing_of_one_length_is_bounded(length):
    packer, placed, most = packing._Packer(0, 2048), [], 0
    for i in range(500):
        placed += packer.add(i, np.full(length, i, np.uint32))
        if len(packer.pieces) >= 64:
            placed += packer.pack(last=False, most=32)
        most = max(most, len(packer.pieces))
    assert most <= 64
    placed += packer.pack(last=True)
    sizes, of_doc = {}, {}
    for doc_id, start, n, _, _, sequence, offset in placed:
        assert offset == sizes.get(sequence, 0)
        sizes[sequence] = offset + n
        of_doc.setdefault(doc_id, []).append((start, n))
    assert all(sorted(v)[0][0] == 0 and sum(n for _, n in v) == length for v in of_doc.values()) and len(of_doc) == 500
    tails = sorted(n for n in sizes.values() if n != 2048)
    assert len(set(tails)) == len(tails) and all(n & n - 1 == 0 for n in tails)


def test_main_text_keeps_lists_and_drops_what_stands_around():
    pages = [f"<html><body><nav><ul><li><a href=/>Home {i}</a></li></ul></nav><article><h1>T</h1><p>Words of page {i}.</p><p>And more.</p></article>"
             f"<footer><p>Foot</p></footer></body></html>" for i in range(200)]
    model = maintext.fit([(p, p.labels(), 1) for p in map(maintext.Page, pages)] + [(*maintext._hand_labelled(x), maintext.HAND_WEIGHT) for x in maintext.BY_HAND])
    text = "<p>What the article says, in a sentence of usual length.</p>"
    for inside, wanted in [
            ("<h1>T</h1><ul><li>milk</li><li>eggs</li></ul><p>x</p>", "T\nmilk\neggs\nx"), ("<p><a href=/x>One link only</a></p>", "One link only"),
            ("<table><tr><td>a</td><td>b</td></tr></table>", "a\nb"), ('<div id="disqus_thread"><p>I disagree entirely with this.</p></div>', ""),
            ('<section id="comments"><ol><li><p>First comment here.</p></li></ol></section>', ""),
            ('<div class="cookie-banner"><p>We use cookies on this site.</p></div>', ""), ('<div class="kommentare"><p>Das sehe ich anders.</p></div>', ""),
            ('<div class="commentaires"><p>Je ne suis pas d\'accord.</p></div>', ""), ('<div id="comentarios"><ul><li>No lo creo.</li></ul></div>', "")]:
        for tag in ("article", "main"):
            got = model.main_text(f"<html><body><nav><ul><li><a href=/>Home</a></li></ul></nav><{tag}>{text}{inside}{text}</{tag}><footer>foot</footer></body></html>")
            line = "What the article says, in a sentence of usual length."
            assert got == "\n".join(x for x in (line, wanted, line) if x), (tag, inside)


def test_unmatched_tags_cost_little():
    begin = time.time()
    page = maintext.Page("<b>" * 100_000 + "</i>" * 100_000 + "<p>" + "</u>" * 1000)
    assert len(page.tags) == 100_002 and time.time() - begin < 10
