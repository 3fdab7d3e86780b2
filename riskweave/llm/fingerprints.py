"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch holds the k smallest distinct hashes of a text's runs of five words
(lower case, split at white space; a shorter text is one run of all its words).
Sketches of parts merge into the sketch of the whole: the k smallest of the
union. So a text is sketched part by part, whatever its length, and the sketches
of many rows are merged by groups (:func:`merged`). Below the smaller of two
sketches' largest hashes both are complete, which gives unbiased estimates of
resemblance and containment; the place of the largest hash in the range of all
hashes gives the number of distinct shingles. A text of fewer than k shingles
has its whole set as sketch, and all estimates are exact.

Hashes are the first 16 hexadecimal digits of the shingle's MD5 sum, as text,
so fingerprints are the same in every engine. DataFrame functions only.

Edge cases: null and empty texts, and texts of white space, have an empty
sketch; two empty sketches resemble each other fully, an empty and another one
not at all; an empty set is contained in any. Equal texts have equal sketches.
Very long texts are hashed in parts of ``PART`` shingles. In :func:`edited`
repeated ids follow one another in the order of their texts' SHA-256 sums, null
ids come first, and a table of one row follows itself. Empty tables give no
rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import staged, text_column

WIDTH, DIGITS, PART = 5, 16, 4096


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[\t\n\x0b\f\r ]+"), "")


def _smallest(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch_of_words(held: Column, k: int, width: int = WIDTH) -> Column:
    """The k smallest hashes of the runs of ``width`` words, part by part. ``held`` should be a plain column (:func:`sketched`)."""
    n = F.greatest(F.size(held) - (width - 1), F.least(F.size(held), F.lit(1)))  # runs

    def hashed(part):
        places = F.sequence(part * PART + 1, F.least(n, (part + 1) * PART))
        # Places beyond the last word are null, which concat_ws leaves out.
        return F.transform(places, lambda i: F.substring(F.md5(F.concat_ws(" ", *(F.get(held, i + j - 1) for j in range(width)))), 1, DIGITS))
    none = F.array().cast("array<string>")
    parts = F.sequence(F.lit(0), F.floor((n - 1) / PART).cast("int"))
    return F.when(n > 0, F.aggregate(parts, none, lambda least, part: _smallest(F.concat(least, hashed(part)), k))).otherwise(none)


def sketched(df: DataFrame, text_col: str, name: str, k: int) -> DataFrame:
    """``df`` with the sketch of a text column; words are a column of their own, so a text is split once, not for every run."""
    held = f"{name}_words"
    return df.withColumn(held, words(F.col(text_col))).withColumn(name, sketch_of_words(F.col(held), k)).drop(held)


def merge(a: Column, b: Column, k: int) -> Column:
    """The sketch of two sketched parts together."""
    return _smallest(F.concat(a, b), k)


def resemblance(a: Column, b: Column, k: int) -> Column:
    """Estimated share of common shingles among all of both."""
    whole = merge(a, b, k)
    return F.when(F.size(whole) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(whole, F.array_intersect(a, b))) / F.size(whole))


def containment(a: Column, b: Column, k: int) -> Column:
    """Estimated share of the first text's shingles that the second holds."""
    whole = F.lit("g")  # above any hash: a sketch of fewer than k is complete
    last = F.least(F.when(F.size(a) < k, whole).otherwise(F.element_at(a, -1)), F.when(F.size(b) < k, whole).otherwise(F.element_at(b, -1)))
    known = F.size(F.filter(a, lambda h: h <= last))
    return F.when(known == 0, F.lit(1.0)).otherwise(F.size(F.filter(F.array_intersect(a, b), lambda h: h <= last)) / known)


def distinct_shingles(a: Column, k: int) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    place = (F.conv(F.substring(F.element_at(a, -1), 1, 13), 16, 10).cast("double") + 1) / float(16 ** 13)
    return F.when(F.size(a) < k, F.size(a).cast("long")).otherwise(F.round(F.lit(float(k - 1)) / place).cast("long"))


def merged(parts: DataFrame, by: list[str], k: int, sketch: str = "sketch") -> DataFrame:
    """One sketch for each group of sketched parts; a group of any size passes k hashes a task on."""
    hashes = parts.select(*by, F.explode(sketch).alias("hash")).distinct()
    order = Window.partitionBy(*by).orderBy("hash")
    least = hashes.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)
    found = least.groupBy(*by).agg(F.sort_array(F.collect_list("hash")).alias(sketch))
    alone = parts.select(*by).distinct()
    both = alone.alias("a").join(found.alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by], "left")
    return both.select(*(F.col(f"a.{c}") for c in by), F.coalesce(f"b.{sketch}", F.array().cast("array<string>")).alias(sketch))


def _blocks(ids: DataFrame, rows_per_block: int, intervals: int = 64, most: int = 1024) -> Column:
    """A number for ``id`` that never falls as the id rises, with about as many rows each.

    64 quantile intervals, each cut evenly: at most 65,536 blocks, null ids in one before them.
    """
    n = ids.count()
    bounds = sorted(set(ids.approxQuantile("id", [i / intervals for i in range(intervals + 1)], 0.002))) if n else []
    pieces = max(1, min(most, -(-n // (intervals * rows_per_block))))
    x = F.col("id").cast("double")
    if len(bounds) < 2:
        return F.when(F.col("id").isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("long")
    edges = F.array(*map(F.lit, bounds[:-1]))
    nth = F.greatest(F.size(F.filter(edges, lambda b: b <= x)), F.lit(1))
    low, high = F.element_at(edges, nth), F.element_at(F.array(*map(F.lit, bounds[1:])), nth)
    piece = F.greatest(F.lit(0), F.least(F.lit(pieces - 1), F.floor((x - low) / (high - low) * pieces)))
    return F.when(F.col("id").isNull(), F.lit(-1)).otherwise(nth * most + piece).cast("long")


def fingerprints(docs: DataFrame, k: int = 128, id_col: str = "doc_id", text_col: str = "text", rows_per_block: int = 32) -> DataFrame:
    """Every text and its edited text, with their sketches, beside the sketch of the next document.

    Edited: the last quarter of the text gives way to as many characters from
    the start of the next document, by ascending id; the last one's next is the
    first. Rows are dealt out once, in blocks of neighbouring ids; each block
    also gets a copy of the row that follows its last one.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_column(text_col).alias("text"))
    light = staged(rows.select("id", F.sha2("text", 256).alias("sha")), "fingerprint-ids")
    block = _blocks(light.select("id"), rows_per_block)
    firsts = light.groupBy(block.alias("block")).agg(F.min(F.struct("id", "sha")).alias("first"))  # at most 65,537 rows
    over = Window.orderBy("block")
    follows = firsts.select("first", F.lag("block").over(over).alias("before"), F.max("block").over(Window.partitionBy()).alias("last"))
    follows = follows.select(F.col("first.id").alias("first_id"), F.col("first.sha").alias("first_sha"), F.coalesce("before", "last").alias("block"))
    copies = (rows.join(F.broadcast(follows), F.col("id").eqNullSafe(F.col("first_id"))).filter(F.sha2("text", 256) == F.col("first_sha"))
              .groupBy("block").agg(F.first("id").alias("id"), F.first("text").alias("text")))
    dealt = (rows.select(block.alias("block"), F.lit(0).alias("copy"), "id", "text")
             .unionByName(copies.select("block", F.lit(1).alias("copy"), "id", "text")).repartition("block")
             .withColumn("sha", F.sha2("text", 256)).sortWithinPartitions("block", "copy", F.col("id").asc_nulls_first(), "sha"))
    order = Window.partitionBy("block").orderBy("copy", F.col("id").asc_nulls_first(), "sha")
    n = F.length("text")
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    beside = (sketched(dealt, "text", "sketch", k).select("*", n.cast("long").alias("n_chars"), F.lead("text").over(order).alias("next_text"),
                              F.lead("sketch").over(order).alias("next_sketch")).filter("copy = 0")
              .withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - quarter),
                                             F.substring(F.col("next_text"), F.lit(1), quarter))))
    return sketched(beside, "edited", "edited_sketch", k).select(
        F.col("id").alias(id_col), "text", "n_chars", "edited", "sketch", "edited_sketch", "next_sketch")
