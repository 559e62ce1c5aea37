"""Benchmark decontamination by a prefix-filtered containment join, in DataFrame operations only.

Words are runs of digits, letters and non-ASCII characters after lower-casing
A-Z. Each benchmark item is cut into windows of ``WINDOW`` consecutive words
(a shorter item is one window). A window lies in a document only if all its
word shingles do, so any one shingle is a sufficient prefix: shingles are
ordered by how often they stand in the documents and only each window's rarest
one is joined. The match fixes the window's place; places that do not fit the
document are discarded and the words there are compared exactly.

A null or empty text has no words. Items without words never occur; a null
``item_id`` marks words but is neither counted nor named, and an id that
repeats counts once. Repeated document rows give equal results. Other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstlight.llm.tables import discard, free_name, screened, stored

WINDOW = 10
SHINGLE = 4

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Words of lower-cased text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OTHER_UPPER = r"[\p{javaUpperCase}\p{javaTitleCase}&&[^A-Z]]"
NO_ID = -(2**63)


def lowered(text: Column) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` does that where no other capital letter stands."""
    return F.when(text.rlike(OTHER_UPPER), F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def words(text: Column) -> Column:
    return F.regexp_extract_all(lowered(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _shingle(array: str, position: Column, k: int) -> Column:
    return F.xxhash64(*[F.element_at(array, (position + 1 + i).cast("int")) for i in range(k)])


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with a key for rows of one id and text."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key_id"), F.xxhash64("text").alias("key_text"), "doc_id", "text"
    )


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id, window, size, shingles``: distinct windows of each item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    size = F.least(F.lit(window), F.size("w"))
    placed = items.select("item_id", "w", size.alias("size"), F.explode(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("at"))
    cut = placed.select("item_id", F.slice("w", F.col("at"), F.col("size")).alias("w"), "size").distinct()
    return cut.select("item_id", F.concat_ws(" ", "w").alias("window"), "w", "size")


def _window_shingles(found: DataFrame, shingle: int) -> DataFrame:
    """``window, size, k, offset, token`` of distinct windows."""
    one = found.select("window", "w", "size").distinct()
    placed = one.withColumn("k", F.least(F.lit(shingle), F.col("size")))
    placed = placed.withColumn("offset", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("k"))))
    token = F.coalesce(*[F.when(F.col("k") == k, _shingle("w", F.col("offset"), k)) for k in range(1, shingle + 1)])
    return placed.select("window", "size", "k", "offset", token.alias("token"))


def _tokenised(docs: DataFrame) -> DataFrame:
    """``key_id, key_text, doc_id, w``, stored: the words of each document; the texts are cut up this once."""
    return stored(_keyed(docs).select("key_id", "key_text", "doc_id", words(F.col("text")).alias("w")), "decontam-words")


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``key_id, key_text, start, size, window``: every place where a window stands in a document."""
    tokenised = _tokenised(docs)
    found = _occurrences(tokenised, benchmark, window, shingle)
    discard(tokenised)
    return found


def _occurrences(tokenised: DataFrame, benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    found = stored(windows(benchmark, window), "decontam-windows")
    pieces = stored(_window_shingles(found, shingle), "decontam-shingles")
    lengths = [r[0] for r in pieces.select("k").distinct().sort("k").collect()]  # at most `shingle` numbers
    if not lengths:
        discard(pieces)
        return found.select(F.lit(0).cast("long").alias("key_id"), F.lit(0).cast("long").alias("key_text"), F.lit(0).alias("start"), "size", "window")
    placed = tokenised.select("key_id", "key_text", "w", F.size("w").alias("n"), F.posexplode("w").alias("at", "word"))
    # The shingles of all lengths at one place, in one pass.
    here = [F.struct(F.lit(k).alias("k"), F.when(F.col("at") + k <= F.col("n"), _shingle("w", F.col("at"), k)).alias("token")) for k in lengths]
    cut = placed.select("key_id", "key_text", "n", "at", F.inline(F.array(*here)))
    hits = stored(cut.join(pieces.select("k", "token").distinct(), ["k", "token"]).select("key_id", "key_text", "n", "at", "k", "token"), "decontam-hits")
    counts = hits.groupBy("k", "token").agg(F.count("*").alias("n_places"))
    ordered = pieces.join(counts, ["k", "token"], "left").groupBy("window", "size").agg(
        F.min(F.struct(F.coalesce("n_places", F.lit(0)).alias("n_places"), "k", "token", "offset")).alias("rarest")
    )
    prefixes = ordered.filter("rarest.n_places > 0").select("window", "size", "rarest.k", "rarest.token", "rarest.offset")
    start = F.col("at") - F.col("offset")
    candidates = (
        hits.join(prefixes, ["k", "token"])
        .filter((start >= 0) & (start + F.col("size") <= F.col("n")))
        .select("key_id", "key_text", F.struct(start.alias("start"), F.col("size").cast("int").alias("size"), "window").alias("c"))
        .groupBy("key_id", "key_text").agg(F.collect_set("c").alias("candidates"))
    )
    candidates = stored(candidates, "decontam-candidates")
    key = [F.col("key_id"), F.col("key_text")]
    met = screened(tokenised.select(*key, "w"), key, candidates.select(*key))[1]
    checked = met.join(candidates, ["key_id", "key_text"]).select(
        "key_id", "key_text",
        F.explode(
            F.filter("candidates", lambda c: F.concat_ws(" ", F.slice(F.col("w"), c["start"] + 1, c["size"])) == c["window"])
        ).alias("c"),
    )
    places = stored(checked.select("key_id", "key_text", "c.*").distinct(), "decontam-occurrences")
    discard(found, pieces, hits, candidates)
    return places


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    tokenised = _tokenised(docs)
    found = _occurrences(tokenised, benchmark, window, shingle)
    key = ["key_id", "key_text"]
    hit = (
        found.select(*key, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("at"))
        .distinct().groupBy(*key).agg(F.count("*").alias("n_hit"))
    )
    owners = windows(benchmark, window).select("item_id", "window")
    items = (
        found.select(*key, "window").distinct().join(owners, "window").select(*key, "item_id").distinct()
        .groupBy(*key).agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    rows = tokenised.select("key_id", "key_text", "doc_id", F.size("w").cast("long").alias("n_words"))
    joined = rows.join(hit.join(items, key, "left"), key, "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed).cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with all their columns.

    Only rows that may have the id and text of one with a window are shuffled.
    """
    hit_id, hit_text = free_name(docs, "hit_id"), free_name(docs, "hit_text")
    hit = occurrences(docs, benchmark, window, shingle).select(F.col("key_id").alias(hit_id), F.col("key_text").alias(hit_text)).distinct()
    key_id, key_text = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.xxhash64("text")
    clean, several = screened(docs, [key_id, key_text], hit)
    return clean.unionByName(several.join(hit, (key_id == F.col(hit_id)) & (key_text == F.col(hit_text)), "left_anti"))
