"""Benchmark decontamination by size-partitioned MinHash containment search.

Items and documents are sets of shingles of ``shingle`` (5) words: runs of
letters and digits, lower case. A document is contaminated by an item if it
holds at least ``threshold`` (0.8) of the item's distinct shingles.

Short items in long documents have a tiny Jaccard similarity, so documents
aren't sketched. Items are partitioned by size, powers of two, and an item of a
partition with up to n shingles is sketched by its floor((1 - threshold) n) + 1
least shingle hashes. A document that holds enough of the item misses fewer
shingles than that, so it holds one of the sketch: the search loses no pair. How
many of the sketch it must hold follows from the item's own size. Candidates are
verified by exact shingle containment, on the shingles themselves.

Documents meet the benchmark in map-side joins while the benchmark's side is at
most ``broadcast_rows`` rows, which is counted; beyond that in shuffled joins,
with the same result. DataFrame functions only.

Defined cases: null and empty texts, and texts of fewer words than a shingle,
hold nothing and contaminate nothing; repeated rows give their pairs once; rows
with a null id are searched like any other; empty tables give an empty result;
other columns are ignored (and pass unchanged through ``drop_contaminated``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, though ``use`` has it in a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shingles(words: Column, size: int) -> Column:
    """The distinct shingles, as text."""
    at = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.array_join(F.slice(w, i, size), " "))
    return F.when(F.size(words) >= size, F.array_distinct(_once(words, at))).otherwise(F.array().cast("array<string>"))


def _hashes(words: Column, size: int) -> Column:
    """The distinct 63-bit hashes of the shingles, in the order of ``_shingles`` but for collisions."""
    def of(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - size)
        return F.transform(starts, lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(h, i + j) for j in range(size)]), 1))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) >= size, F.array_distinct(_once(hashed, of))).otherwise(F.array().cast("array<bigint>"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if it is counted to have at most ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df


def contaminations(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shingle: int = 5,
    threshold: float = 0.8,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """(doc, mark, item, matched, n_shingles): contaminated documents and the items they hold.

    ``doc`` is the id and ``mark`` a hash of the text, which together name a row.
    """
    tests = items.select(F.col(item_col).alias("item"), _words(F.col(item_text_col)).alias("w")).where(F.size("w") >= shingle)
    tests = materialize(tests.select("item", _shingles(F.col("w"), shingle).alias("s"), _hashes(F.col("w"), shingle).alias("h")).distinct(), "items")
    # the partition's largest size, the sketch it needs, and how much of it a match must hold
    top = F.pow(F.lit(2), F.floor(F.log2(F.size("h"))) + 1) - 1
    spare = lambda n: F.floor((1 - threshold) * n + 1e-9)
    sized = tests.withColumn("sketch", F.least(F.size("h").cast("long"), spare(top) + 1)).withColumn("needed", F.col("sketch") - spare(F.size("h")))
    sketches = materialize(
        sized.select("item", "needed", F.explode(F.slice(F.array_sort("h"), 1, F.col("sketch").cast("int"))).alias("h")), "sketches"
    )
    furthest = F.coalesce(F.lit(sketches.agg(F.max("h")).first()[0]), F.lit(-1))
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).withColumn("mark", F.xxhash64("text"))
    held = rows.select("doc", "mark", _words(F.col("text")).alias("w")).select("doc", "mark", _hashes(F.col("w"), shingle).alias("hs"))
    held = held.select("doc", "mark", F.explode(F.filter("hs", lambda h: h <= furthest)).alias("h"))
    hits = held.join(_small(sketches, broadcast_rows), "h").groupBy("doc", "mark", "item", "needed", "h").agg(F.lit(1))
    found = hits.groupBy("doc", "mark", "item", "needed").agg(F.count("*").alias("hits")).where(F.col("hits") >= F.col("needed"))
    candidates = materialize(found.select("doc", "mark", "item"), "candidates")

    # ---- exact containment of the candidates
    keys = candidates.select(F.col("doc").alias("cdoc"), F.col("mark").alias("cmark")).distinct()
    suspects = rows.join(keys, F.col("doc").eqNullSafe(F.col("cdoc")) & (F.col("mark") == F.col("cmark")), "left_semi")
    theirs = suspects.select("doc", "mark", _words(F.col("text")).alias("w")).select("doc", "mark", F.explode(_shingles(F.col("w"), shingle)).alias("s"))
    parts = materialize(tests.select("item", F.size("s").cast("long").alias("n_shingles"), F.posexplode("s").alias("at", "s")), "shingles")
    shared = theirs.join(_small(parts, broadcast_rows), "s").groupBy("doc", "mark", "item", "n_shingles", "at").agg(F.lit(1))
    matched = shared.groupBy("doc", "mark", "item", "n_shingles").agg(F.count("*").alias("matched"))
    matched = matched.where(F.col("matched") >= F.ceil(threshold * F.col("n_shingles") - 1e-9))
    a, b = matched.alias("a"), candidates.alias("b")
    same = F.col("a.doc").eqNullSafe(F.col("b.doc")) & (F.col("a.mark") == F.col("b.mark")) & F.col("a.item").eqNullSafe(F.col("b.item"))
    return a.join(b, same, "left_semi").select("doc", "mark", "item", "matched", "n_shingles")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated rows."""
    doc, mark = fresh(docs, "doc", "mark")
    found = contaminations(docs, items, id_col, text_col, **options).select(F.col("doc").alias(doc), F.col("mark").alias(mark)).distinct()
    found = materialize(found, "contaminated")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(doc)) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col(mark))
    return docs.join(found, same, "left_anti")
