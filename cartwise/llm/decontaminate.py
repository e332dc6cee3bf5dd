"""Benchmark decontamination with a positional inverted index (operator 4).

1. The words of all documents are written once.
2. Corpus frequencies of the benchmark's words order the terms of every
   benchmark window; each window is looked up by its rarest terms.
3. The index holds, for those terms, a posting list per document: the places
   of the term. Postings of one document come from one row, so the index is
   built without moving words that no window looks up.
4. The lists of a window's rarest terms, each moved by the term's place in the
   window, are intersected: equal starts are exact candidates, starts that lie
   within ``slop`` words are proximity matches.
5. Exact candidates are compared word by word with the document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import lower_az, words
from cartwise.session import small_side, stage

WINDOW = 10
RAREST = 2  # lists that are intersected for a window


def benchmark_windows(benchmark: DataFrame, item_id: str, text: str, size: int = WINDOW) -> DataFrame:
    """(item_id string, window words): every run of ``size`` words; a shorter item is one window.

    Items without a word have none. A null id counts as the empty string.
    """
    rows = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"),
        words(lower_az(F.col(text))).alias("w"),
    ).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    rows = rows.withColumn("start", F.explode(starts))
    return rows.select("item_id", F.slice("w", F.col("start") + 1, size).alias("window")).distinct()


def word_rows(docs: DataFrame, doc_id: str, text: str, row: str | None = None) -> DataFrame:
    """Documents as word arrays, written once: (_row, doc_id, w, n_words); ``row``: a column with the row's number."""
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    rows = docs.select(F.col(doc_id).alias("doc_id"), words(lower_az(F.col(text))).alias("w"), number.alias("_row"))
    return stage(rows.withColumn("n_words", F.size("w").cast("long")))


def lookup_terms(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """For each distinct window: its words and its ``RAREST`` rarest (term, place) pairs in the corpus.

    Columns: win (hash of the words), window, t1, o1, t2, o2; a window of one
    word looks up the same term twice.
    """
    distinct = stage(windows.select("window").distinct().withColumn("win", F.xxhash64("window")))
    vocabulary = stage(distinct.select(F.explode("window").alias("term")).distinct())
    tokens = rows.select(F.explode("w").alias("term"))
    counts = tokens.join(small_side(vocabulary), "term").groupBy("term").agg(F.count("*").alias("n"))
    places = distinct.select("win", "window", F.posexplode("window").alias("place", "term"))
    ranked = places.join(counts, "term", "left").select(
        "win", "window", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "place").alias("at")
    )
    lists = ranked.groupBy("win", "window").agg(F.array_sort(F.collect_list("at")).alias("at"))
    one, two = F.get("at", F.lit(0)), F.coalesce(F.get("at", F.lit(1)), F.get("at", F.lit(0)))
    found = lists.where(one["n"] > 0)  # a word that no document has: the window occurs nowhere
    return stage(
        found.select(
            "win", "window", one["term"].alias("t1"), one["place"].alias("o1"), two["term"].alias("t2"), two["place"].alias("o2")
        )
    )


def posting_lists(rows: DataFrame, lookups: DataFrame) -> DataFrame:
    """The index, written once: (term, _row, at) with the places of each looked-up term in a document."""
    terms = stage(lookups.select(F.col("t1").alias("term")).union(lookups.select("t2")).distinct())
    tokens = rows.select("_row", F.posexplode("w").alias("pos", "term"))
    found = tokens.join(small_side(terms), "term")
    return stage(found.groupBy("_row", "term").agg(F.array_sort(F.collect_list("pos")).alias("at")))


def find_matches(rows: DataFrame, windows: DataFrame, slop: int = 0, size: int = WINDOW) -> DataFrame:
    """Places of windows in documents: (_row, win, start, gap), gap 0 for exact phrases.

    With ``slop`` > 0, also the places where the two rarest words of a window
    lie in the document at distances that differ from those in the window by 1
    to ``slop`` words; they are proximity matches, not compared further. No
    window is longer than ``size`` words.
    """
    lookups = lookup_terms(rows, windows)
    index = posting_lists(rows, lookups)
    first = index.join(small_side(lookups.drop("window")), index["term"] == F.col("t1")).drop("term")
    second = index.select(F.col("_row"), F.col("term").alias("t2"), F.col("at").alias("at2"))
    both = first.join(second, ["_row", "t2"])
    starts = F.transform("at", lambda p: p - F.col("o1"))
    others = F.transform("at2", lambda p: p - F.col("o2"))
    if slop <= 0:
        exact = both.select("_row", "win", F.explode(F.array_intersect(starts, others)).alias("start"))
        near = None
    else:
        pairs = both.select("_row", "win", starts.alias("starts"), F.explode(others).alias("other"))
        around = F.filter("starts", lambda s: F.abs(s - F.col("other")) <= slop)
        pairs = pairs.select("_row", "win", "other", F.explode(around).alias("start"))
        pairs = pairs.withColumn("gap", F.abs(F.col("start") - F.col("other")))
        exact = pairs.where("gap = 0").select("_row", "win", "start")
        near = pairs.where("gap > 0").select("_row", "win", "start", "gap").where("start >= 0")
    exact = exact.where("start >= 0")
    # Word by word: the candidates of a document meet its words once.
    cands = exact.groupBy("_row").agg(F.collect_list(F.struct("win", "start")).alias("c"))
    # Only documents with a candidate are moved: up to a checked number their rows are told to all scans.
    cands = stage(cands)
    texts = rows.select("_row", "w").join(small_side(cands.select("_row")), "_row", "left_semi").join(cands, "_row")
    shown = F.transform("c", lambda c: F.struct(c["win"], c["start"], F.slice("w", c["start"] + 1, F.lit(size)).alias("shown")))
    held = texts.select("_row", F.explode(shown).alias("c")).select("_row", "c.*")
    shown = held.join(small_side(lookups.select("win", "window")), "win")
    shown = shown.where(F.slice("shown", F.lit(1), F.size("window")) == F.col("window"))
    exact = shown.select("_row", "win", "start", F.lit(0).alias("gap"))
    return exact if near is None else exact.unionByName(near)


def decontaminate(rows: DataFrame, benchmark: DataFrame, item_id: str, text: str, size: int = WINDOW, slop: int = 0) -> DataFrame:
    """Contamination of every row of ``word_rows``.

    Columns: _row, doc_id, n_words, n_hit (words inside any occurrence of a
    window), n_items, items_sha256 (of the sorted, comma-joined ids; of the
    empty text if none), contaminated. Null or empty texts have no words and
    no hits, repeated rows get equal results, an empty table or benchmark
    gives no hits; repeated items count once by their id. With ``slop`` > 0 there is
    also n_near: places of windows of two words or more that are proximity
    matches within ``slop`` words and no exact ones; the other columns stay those of exact phrases.
    """
    windows = stage(benchmark_windows(benchmark, item_id, text, size))
    by_window = windows.select("item_id", F.xxhash64("window").alias("win"), F.size("window").alias("len"))
    matches = find_matches(rows, windows, slop, size)
    if slop > 0:
        matches = stage(matches)
    found = stage(matches.where("gap = 0").select("_row", "win", "start"))
    spans = found.join(small_side(stage(by_window.select("win", "len").distinct())), "win")
    spans = spans.select("_row", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    hit = spans.select("_row", F.explode(F.sequence("start", F.col("end") - 1)).alias("at")).distinct()
    hit = hit.groupBy("_row").agg(F.count("*").alias("n_hit"))
    wins = found.select("_row", "win").distinct()
    items = wins.join(small_side(stage(by_window.select("win", "item_id").distinct())), "win")
    items = items.groupBy("_row").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    joined = rows.select("_row", "doc_id", "n_words").join(hit.join(items, "_row"), "_row", "left")
    named = F.coalesce(F.array_join("items", ","), F.lit(""))
    result = joined.select(
        "_row",
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(named.cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
    if slop <= 0:
        return result
    several = small_side(stage(by_window.where("len > 1").select("win").distinct()))
    near = matches.where("gap > 0").join(several, "win").select("_row", "win", "start").distinct()
    near = near.join(found, ["_row", "win", "start"], "left_anti").groupBy("_row").agg(F.count("*").alias("n_near"))
    return result.join(near, "_row", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0)).cast("long"))
