"""Benchmark decontamination by winnowing, with DataFrame functions only.

Words are hashed, GRAM of them at a time, and each window of WINDOW words keeps the least of its hashes. Equal windows
have equal least hashes, so every span of WINDOW words that a document shares with an item is found by a join on them.
A hit is then extended: the windows of the document that kept the hash are compared word by word with the windows of the
items. Documents are read once and never shuffled; what is shuffled are hits.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..materialize import BROADCAST_ROWS, snapshot
from .common import matching, row_key, table

WINDOW, GRAM = 13, 5
SHARE = 20          # contaminated: at least one word in so many is hit
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"   # what isn't a digit, an ASCII letter or beyond ASCII


def words(text) -> Column:
    """The words as they are written; null has none. Only the first and last piece of a split can be empty."""
    return F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SEPARATORS, -1), "")


def word_hashes(of) -> Column:
    """Hashes of lower-cased words. ``lower`` turns letters beyond ASCII too, so words that are equal once A-Z is turned
    have equal hashes, and some others do as well; windows are compared by their words."""
    return F.transform(of, lambda w: F.xxhash64(F.lower(w)))


def _upto(last) -> Column:
    """0, 1, ... last; empty below zero."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def gram_hashes(hashes, gram: int) -> Column:
    hashes = F.col(hashes)
    return F.transform(_upto(F.size(hashes) - gram), lambda i: F.xxhash64(
        *[F.get(hashes, i + F.lit(j)) for j in range(gram)]))


def window_minima(grams, window: int, gram: int) -> Column:
    """The least gram hash of each window."""
    span = window - gram + 1
    return F.transform(_upto(F.size(F.col(grams)) - span), lambda i: F.array_min(F.slice(F.col(grams), i + 1, span)))


def runs(minima) -> Column:
    """``(at, mark)`` where the kept hash changes: the windows from ``at`` to the next run keep ``mark``."""
    kept = F.col(minima)
    return F.transform(F.filter(_upto(F.size(kept) - 1), lambda i: (i == 0) | (F.get(kept, i) != F.get(kept, i - 1))),
                       lambda i: F.struct(i.alias("at"), F.get(kept, i).alias("mark")))


def _winnowed(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """Rows with w (words), runs; each step is a column of its own, so that it is computed once."""
    return (texts.withColumn("_w", words("_text")).withColumn("_h", word_hashes("_w"))
            .withColumn("_g", gram_hashes("_h", gram)).withColumn("_m", window_minima("_g", window, gram))
            .withColumn("_runs", runs("_m")))


def _text_of(span) -> Column:
    """Words joined and lower-cased, A-Z only."""
    return F.translate(F.array_join(span, " "), UPPER, LOWER)


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(item_id, n, line, words)``: each window of each item once; an item of fewer words, but not none, is one."""
    split = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words("text").alias("w")).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(window))
    return split.select("item_id", n.alias("n"), F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.slice(F.col("w"), i, n))).alias("words")).select(
        "item_id", "n", _text_of("words").alias("line"), "words").dropDuplicates(["item_id", "line"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM,
                  max_broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """``docs(doc_id, text)``, ``benchmark(item_id, text)`` -> ``(doc_id, n_words, n_hit, item_ids, key_id, key_hash)``.

    One row per row of ``docs``; rows that repeat are judged one by one. A word is hit if it lies in an occurrence of an
    item's window. Null and empty texts have no words and no hits; a null item_id takes part but isn't listed in
    ``item_ids``. Without items, or without documents, nothing is hit. ``item_ids`` is sorted as strings.
    """
    windows = snapshot(item_windows(benchmark, window), "item-windows")
    lines = windows.select("n", "line", "words").dropDuplicates(["line"])
    # a window of the full length is marked by its least hash, a shorter item by the hash of all its words
    full = _winnowed(lines.where(F.col("n") == window).select(F.array_join("words", " ").alias("_text")), window, gram)
    marks = full.select(F.lit(window).alias("n"), F.explode("_m").alias("mark")).distinct()
    short = [row["n"] for row in lines.where(F.col("n") < window).select("n").distinct().collect()]  # at most window - 1
    if short:
        marks = marks.unionByName(lines.where(F.col("n") < window).select(
            "n", F.xxhash64("n", word_hashes("words")).alias("mark")).distinct())
    marks = snapshot(marks, "item-marks")
    small = marks.count() <= max_broadcast

    read = _winnowed(docs.select("doc_id", docs["text"].alias("_text"), F.monotonically_increasing_id().alias("_row"),
                                 *row_key(docs)), window, gram)
    # one entry of length 0 stands for the document itself, so that it is kept without hits
    entries = [F.array(F.struct(F.lit(0).alias("n"), F.lit(0).alias("at"), F.lit(0).alias("to"), F.col("_row").alias("mark"))),
               F.transform("_runs", lambda r, i: F.struct(
                   F.lit(window).alias("n"), r["at"].alias("at"),
                   F.coalesce(F.get(F.col("_runs"), i + 1)["at"], F.size("_m")).alias("to"), r["mark"].alias("mark")))]
    for n in short:
        entries.append(F.transform(_upto(F.size("_w") - n), _short_entry(n)))
    own = ["doc_id", "_row", "key_id", "key_hash"]
    spread = read.select(*own, "_w", F.explode(F.concat(*entries)).alias("e")).select(*own, "_w", "e.*")
    context = F.slice("_w", F.col("at") + 1, F.col("to") - F.col("at") + F.col("n") - 1)
    entry = [*own, "n", "at", "mark", F.when(F.col("n") == 0, F.size("_w")).alias("n_words")]
    marked = marks.select("n", "mark", F.lit(True).alias("marked"))
    if small:
        met = spread.join(F.broadcast(marked), ["n", "mark"], "left").where("marked or n = 0").select(
            *entry, F.when(F.col("n") > 0, context).alias("near"))
    else:
        met = spread.select(*entry, F.when(F.col("n") > 0, context).alias("near")).join(
            marked, ["n", "mark"], "left").where("marked or n = 0")
    met = snapshot(met.drop("mark"), "marked-runs")

    # extend: the windows of each run, compared by their words
    near = met.where("n > 0").select("_row", "n", "at", "near")
    starts = near.select("_row", "n", "at", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size("near") - F.col("n") + 1), lambda i: F.slice(F.col("near"), i, F.col("n"))))
        .alias("shift", "span")).select("_row", "n", (F.col("at") + F.col("shift")).alias("at"), _text_of("span").alias("line"))
    known = lines.select("line", "n")
    if small and windows.count() <= max_broadcast:
        known, items = F.broadcast(known), F.broadcast(windows.select("item_id", "line"))
    else:
        items = windows.select("item_id", "line")
    found = snapshot(starts.join(known, ["line", "n"]).select("_row", "at", "n", "line").distinct(), "shared-windows")
    reach = found.groupBy("_row").agg(F.sort_array(F.collect_set(F.struct("at", "n"))).alias("spans"))
    covered = reach.select("_row", F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda done, s: F.struct((done["n"] + F.greatest(F.lit(0), s["at"] + s["n"] - F.greatest(done["to"], s["at"]))).alias("n"),
                                 F.greatest(done["to"], s["at"] + s["n"]).alias("to")))["n"].alias("n_hit"))
    hit_items = found.select("_row", "line").distinct().join(items, "line").groupBy("_row").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    return met.where("n = 0").select(*own, "n_words").join(covered, "_row", "left").join(
        hit_items, "_row", "left").select(
        "doc_id", F.col("n_words").cast("bigint"), F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), "key_id", "key_hash")


def _short_entry(n):
    return lambda i: F.struct(F.lit(n).alias("n"), i.alias("at"), (i + 1).alias("to"),
                              F.xxhash64(F.lit(n), F.slice(F.col("_h"), i + 1, n)).alias("mark"))


def is_contaminated(n_words="n_words", n_hit="n_hit", share: int = SHARE) -> Column:
    return (F.col(n_hit) > 0) & (F.lit(share) * F.col(n_hit) >= F.col(n_words))


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that aren't contaminated."""
    judged = contamination(docs, benchmark)
    hit = snapshot(judged.where(is_contaminated()).select("key_id", "key_hash").distinct(), "contaminated")
    return matching(docs, hit, "anti")


def op4_decontaminate(spark, sf_dir):
    judged = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                         F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
                         is_contaminated().alias("contaminated"))


ORACLE = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS line FROM
        (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM i WHERE len(w) > 0)),
dw AS (SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS line FROM
        (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw))),
f AS (SELECT r, s, dw.n, item_id FROM dw JOIN iw ON dw.line = iw.line AND dw.n = iw.n),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM f) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id COLLATE "C") AS ids FROM
        (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM f) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""
