"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

Words are lower case (A-Z), ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A benchmark window is
``window`` consecutive words of an item, or a whole shorter item; a window occurs in a
document where all its words stand in order. Windows and documents are compared as sets of
placed shingles (``shingle`` consecutive words, as text, so equality is exact):

1. Documents are read once for the places of all shingles that any window has.
2. Shingles are ordered by rarity over all documents. Since a window must be contained
   whole, its prefix is one shingle, the rarest, and only its places are candidates.
3. A candidate must pass the positional bound (the window may not begin before the
   document) and the length bound (nor end after it), and then every shingle of the window
   must stand at its place.

The shingle table is broadcast if it is measured to be under ``BROADCAST`` bytes, else Spark
joins by shuffle, where adaptive execution splits frequent shingles. A document word inside
any occurrence is hit; a document is contaminated if at least one word in 20 is.

Defined cases: null texts have no words; null item ids are named ``null``; items without
words never occur; equal item ids are one item; rows with equal document ids are judged
singly; other columns are ignored; empty tables give no rows or no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ascii_lower, keyed, with_id
from riskloom.session import materialise

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST = 64 << 20


def words_of(c: str) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(F.col(c), F.lit(""))), F.lit(WORD), F.lit(0))


def _gram(words: str, at: Column, q: int) -> Column:
    return F.concat_ws(" ", *(F.get(F.col(words), at + k) for k in range(q)))


def windows_of(items: DataFrame, item_id: str, text_col: str, window: int) -> DataFrame:
    """(win, words, item): the distinct windows as joined words, and their items."""
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), words_of(text_col).alias("words")).where(F.size("words") > 0)
    rows = rows.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1))), lambda i: F.slice("words", i, window))).alias("words"))
    return rows.select(F.array_join("words", " ").alias("win"), "words", "item").distinct()


def _small(df: DataFrame) -> DataFrame:
    """``df``, broadcast if its measured size allows."""
    size = df.agg(F.sum(F.length("gram") + 64)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST else df


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, shingle: int = 3) -> DataFrame:
    """Per document: ``id_col``, n_words, n_hit, n_items, items_sha256 (of the sorted
    ids, comma-joined) and contaminated."""
    table, plain = keyed(docs, id_col, text_col)
    named = materialise(windows_of(items, item_id, item_text, window), "windows")
    wins = named.select("win", "words").distinct().withColumn("n", F.size("words"))
    wins = wins.withColumn("q", F.least(F.col("n"), F.lit(shingle)))
    grams = wins.select("win", "n", "q", F.posexplode(F.transform(F.sequence(F.lit(1), F.col("n") - F.col("q") + 1), lambda i: F.array_join(F.slice("words", i, F.col("q")), " "))).alias("off", "gram"))
    grams = materialise(grams, "grams")
    known = grams.select("gram", "q").distinct().select("gram", "q", F.monotonically_increasing_id().alias("gid"))
    known = materialise(known.withColumn("h", F.xxhash64("gram", "q")), "known")
    lengths = sorted(r["q"] for r in known.select("q").distinct().collect())

    words = table.select("_u", words_of(text_col).alias("words"))
    spots = words.select("_u", "words", F.size("words").alias("n"), F.posexplode("words").alias("pos", "word"))
    tables = _small(known)
    found = []
    for q in lengths:  # one or a few: windows shorter than a shingle have shingles of their own length
        here = spots.where(F.col("pos") + q <= F.col("n")).withColumn("text", _gram("words", F.col("pos"), q))
        here = here.withColumn("h", F.xxhash64("text", F.lit(q)))
        right = tables.where(F.col("q") == q).select("h", "gram", "gid")
        met = here.join(right, "h").where(F.array_contains(F.array("gram"), F.col("text")))
        found.append(met.select("_u", "pos", "n", "gid"))
    if not found:
        hits = table.select("_u").limit(0).selectExpr("_u", "0 AS pos", "0 AS n", "0L AS gid")
    else:
        hits = found[0]
        for more in found[1:]:
            hits = hits.union(more)
    hits = materialise(hits, "hits")

    rarity = hits.groupBy("gid").agg(F.count("*").alias("freq"))
    placed = materialise(grams.join(known.select("gram", "q", "gid"), ["gram", "q"]).join(rarity, "gid", "left").select("win", "n", "off", "gid", F.coalesce("freq", F.lit(0)).alias("freq")), "placed")
    prefix = placed.groupBy("win").agg(F.min(F.struct("freq", "off", "gid")).alias("rare"), F.max("n").alias("len"), F.count("*").alias("needed"))
    prefix = prefix.where("rare.freq > 0").select("win", "len", "needed", F.col("rare.off").alias("off"), F.col("rare.gid").alias("gid"))
    near = hits.join(prefix, "gid").select("_u", (F.col("pos") - F.col("off")).alias("start"), "n", "win", "len", "needed")
    near = near.where((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n")))
    asked = near.join(placed.select("win", "off", "gid"), "win").select("_u", "start", "win", "len", "needed", (F.col("start") + F.col("off")).alias("pos"), "gid")
    sure = asked.join(hits.select("_u", "pos", "gid"), ["_u", "pos", "gid"]).groupBy("_u", "start", "win", "len", "needed").agg(F.count("*").alias("met"))
    sure = materialise(sure.where("met = needed").select("_u", "start", "win", "len"), "occurrences")

    covered = sure.select("_u", "start", "len").distinct().select("_u", F.explode(F.expr("sequence(start, start + len - 1)")).alias("pos")).distinct()
    covered = covered.groupBy("_u").agg(F.count("*").alias("n_hit"))
    met = sure.select("_u", "win").distinct().join(named.select("win", "item"), "win").select("_u", "item").distinct()
    met = met.groupBy("_u").agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items"))
    out = table.select("_u", F.size(words_of(text_col)).cast("long").alias("n_words")).join(covered.join(met, "_u"), "_u", "left")
    out = out.select(
        "_u",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        F.coalesce((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")), F.lit(False)).alias("contaminated"),
    )
    return with_id(out, table, plain, id_col)
