"""Approximate join of names: a prefix-filtered set-similarity join on their words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clean import col

#: a word of a name, upper-cased
NAME_WORD = r"[\p{L}\p{N}]+"


def name_words(c: Column) -> Column:
    """The distinct words of a name in order: case, marks, word order and repeats do not tell names apart."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.upper(c), F.lit(NAME_WORD), F.lit(0))))


def best_matches(left: DataFrame, left_id: str, left_name: str, right: DataFrame, right_id: str, right_name: str,
                 percent: int = 60) -> DataFrame:
    """For every row of ``left`` the most similar name of ``right``: ``(left_id, match, similarity, n_links)``.

    Similarity is that of Jaccard between the names' word sets; a link is one of at least ``percent``
    hundredths.  ``n_links`` counts the rows of ``right`` linked, ``match`` is the smallest ``right_id`` of
    those most similar; without a link both ``match`` and ``similarity`` are null and ``n_links`` is 0.  A name
    without a word (null, empty) links with nothing.  No link is lost.

    Equal word sets are one row from the start, on both sides.  Words are ranked from rare to common over all
    sets; two sets of ``a`` and ``b`` words that link share at least ``ceil(percent * (a + b) / (100 +
    percent))``, so one of their shared words is among the first ``a`` (``b``) minus that, plus one.  Only
    these words are joined, and only with sets of the size they were chosen for: a word that a third of all
    names hold meets its like only where a name has hardly another one.  All comparisons are of integers.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent is a number from 1 to 100")
    rows = left.select(col(left_id).alias("_id"), F.concat_ws(" ", name_words(col(left_name))).alias("_set"))
    names = rows.select("_set", F.lit(True).alias("asks"), F.lit(0).alias("n"), F.lit(None).alias("rid")).unionByName(
        right.select(F.concat_ws(" ", name_words(col(right_name))).alias("_set"), F.lit(False).alias("asks"),
                     F.lit(1).alias("n"), col(right_id).alias("rid")))
    sets = (names.where("_set <> ''").groupBy("_set")
            .agg(F.bool_or("asks").alias("asks"), F.sum("n").alias("n"), F.min("rid").alias("rid")))
    words = sets.select("*", F.explode(F.split("_set", " ")).alias("word"))
    often = words.groupBy("word").agg(F.count(F.lit(1)).alias("often"))
    ranked = words.join(often, "word").groupBy("_set").agg(
        F.array_sort(F.collect_list(F.struct("often", "word"))).alias("ranked"),
        F.first("asks").alias("asks"), F.first("n").alias("n"), F.first("rid").alias("rid"))  # equal in the group

    size = F.col("size")
    # ceil by integers
    shared = F.expr(f"({percent} * (size + partner) + {99 + percent}) div {100 + percent}")
    index = (ranked.select("*", F.size("ranked").alias("size"))
             .select("*", F.explode(F.expr(f"sequence(greatest(1, ({percent} * size + 99) div 100), "
                                           f"100 * size div {percent})")).alias("partner"))
             .select("_set", "asks", "n", "rid", "size", "partner",
                     F.explode(F.slice("ranked", 1, (size - shared + 1).cast("int"))).alias("w")))
    asking = index.where("asks").select("_set", F.col("w.word").alias("word"), "size", "partner")
    asked = index.where("n > 0").select(F.col("_set").alias("_other"), "n", "rid", F.col("w.word").alias("word"),
                                        F.col("size").alias("partner"), F.col("partner").alias("size"))
    met = asking.join(asked, ["word", "size", "partner"]).select("_set", "_other", "n", "rid").distinct()
    both = F.size(F.array_intersect(F.split("_set", " "), F.split("_other", " ")))
    either = F.size(F.split("_set", " ")) + F.size(F.split("_other", " ")) - both
    links = met.select("_set", "n", "rid", both.alias("both"), either.alias("either")).where(
        F.col("both") * 100 >= F.col("either") * percent)
    best = links.groupBy("_set").agg(
        F.sum("n").alias("n_links"), F.min(F.struct((-F.col("both") / F.col("either")).alias("s"), "rid")).alias("b"))
    return rows.join(best, "_set", "left").select(
        F.col("_id").alias(left_id), F.col("b.rid").alias("match"), (-F.col("b.s")).alias("similarity"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))
