"""Benchmark decontamination with a positional inverted index.

DataFrame and SQL operations only.  The index has a posting (document,
position) for each occurrence of a term.  A test window is looked up from its
rarest terms (by their counts over all training text): their posting lists are
shifted by the terms' places in the item and intersected, and what is left is
compared word by word with the document's own token list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.scratch import settle, with_rest

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Test items of up to so many bytes of text are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 16 << 20
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def tokens(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null has none."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.filter(F.split(low, SEPARATORS), lambda w: w != "")


def items(benchmark: DataFrame, width: int) -> DataFrame:
    """(item, item_id, words, n): distinct items; n is the words of a window."""
    words = benchmark.select("item_id", tokens(F.col("text")).alias("words")).where("item_id is not null and size(words) > 0").distinct()
    return words.select(F.xxhash64("item_id", "words").alias("item"), "item_id", "words", F.least(F.size("words"), F.lit(width)).alias("n"))


def small(benchmark: DataFrame) -> bool:
    """Whether the test items may be broadcast."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return size <= BROADCAST_BYTES


def _side(df: DataFrame, broadcast: bool) -> DataFrame:
    return F.broadcast(df) if broadcast else df


def index(docs: DataFrame, terms: DataFrame | None = None, broadcast: bool = False) -> DataFrame:
    """Postings (term, doc_id, pos) of all terms, or of those in terms (term, and what it carries)."""
    postings = docs.select("doc_id", F.posexplode(tokens(F.col("text"))).alias("pos", "term"))
    return postings if terms is None else postings.join(_side(terms, broadcast), "term")


def stored_index(docs: DataFrame, terms: DataFrame, broadcast: bool = False) -> DataFrame:
    """The index of some terms, written to the shared folder: lookups read it, whatever they are and however often."""
    return settle(docs.sparkSession, index(docs, terms, broadcast), "postings")


def windows(known: DataFrame, counts: DataFrame, broadcast: bool) -> DataFrame:
    """known with lookups: for each window its rarest and second rarest place (first, second)."""
    places = known.select("item", "n", F.size("words").alias("len"), F.posexplode("words").alias("q", "term"))
    places = places.join(_side(counts, broadcast), "term", "left").select("item", "n", "len", "q", F.coalesce("count", F.lit(0)).alias("count"))
    by_item = places.groupBy("item", "n", "len").agg(F.array_sort(F.collect_list(F.struct("q", "count"))).alias("p"))
    # by count, then place
    own = "array_sort(transform(slice(p, k + 1, n), x -> struct(x.count as count, x.q as q)))"
    lookups = F.expr(f"array_distinct(transform(sequence(0, len - n), k -> named_struct('first', {own}[0].q, 'second', {own}[least(1, n - 1)].q)))")
    return known.join(by_item.select("item", lookups.alias("lookups")), "item")


def candidates(docs: DataFrame, known: DataFrame, broadcast: bool) -> DataFrame:
    """(doc_id, item, at): places of items in documents where both rare terms of a window stand as in the item: their posting lists, shifted by their places in the item, intersect."""
    places = known.select("item", "words", F.explode("lookups").alias("l")).select("item", F.explode(F.array_distinct(F.array("l.first", "l.second"))).alias("q"), "words")
    terms = places.select(F.expr("words[q]").alias("term"), "item", "q").distinct()
    grouped = terms.groupBy("term").agg(F.collect_list(F.struct("item", "q")).alias("uses"))
    postings = stored_index(docs, terms.select("term").distinct(), broadcast)
    hits = postings.join(_side(grouped, broadcast), "term").select("doc_id", "pos", F.explode("uses").alias("u"))
    met = hits.groupBy("doc_id", F.col("u.item").alias("item"), (F.col("pos") - F.col("u.q")).alias("at")).agg(F.collect_set("u.q").alias("qs"))
    both = met.join(_side(known.select("item", "lookups"), broadcast), "item")
    return both.where("exists(lookups, l -> array_contains(qs, l.first) and array_contains(qs, l.second))").select("doc_id", "item", "at")


def exact_matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Per input row: doc_id, rest (a struct of the other columns), text, n_words, n_hit, item_ids.

    A window is ``width`` consecutive words of an item (all words of a shorter
    one); n_hit counts the document's words inside any occurrence of a window,
    item_ids has the distinct items with one.  Null texts have no words; items
    without id or words are passed over; an item_id with several texts has the
    windows of all.  Repeated rows, and rows without doc_id, are judged each by
    its own text.  An empty benchmark hits nothing; an empty table gives an
    empty result.
    """
    docs = with_rest(docs)
    broadcast = small(benchmark)
    known = items(benchmark, width)
    vocabulary = known.select(F.explode("words").alias("term")).distinct()
    counts = docs.select(F.explode(tokens(F.col("text"))).alias("term")).join(_side(vocabulary, broadcast), "term").groupBy("term").count()
    known = windows(known, counts, broadcast)
    known = settle(spark, known, "items")
    found = candidates(docs, known, broadcast).join(_side(known.select("item", "item_id", "words", "n"), broadcast), "item")
    found = found.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "at", "words", "n")).alias("found")).withColumnRenamed("doc_id", "found_in")
    both = docs.join(found, F.col("doc_id").eqNullSafe(F.col("found_in")), "left")

    def compared(t: Column) -> Column:
        """Words and hits of a document with tokens t; a lambda, so that the tokens are made once, and after the join."""

        def of(c: Column) -> Column:
            fits = F.filter(F.sequence(F.lit(0), F.size(c["words"]) - c["n"]), lambda k: (c["at"] + k >= 0) & (c["at"] + k + c["n"] <= F.size(t)) & (F.slice(t, c["at"] + k + 1, c["n"]) == F.slice(c["words"], k + 1, c["n"])))
            return F.transform(fits, lambda k: F.struct(c["item_id"].alias("item_id"), (c["at"] + k).alias("start"), c["n"].alias("n")))

        return F.struct(F.size(t).alias("n_words"), F.flatten(F.transform(F.coalesce(F.col("found"), F.array()), of)).alias("hits"))

    both = both.select("doc_id", "rest", "text", F.element_at(F.transform(F.array(tokens(F.col("text"))), compared), 1).alias("c"))
    both = both.select("doc_id", "rest", "text", "c.n_words", "c.hits")
    covered = F.expr("size(array_distinct(flatten(transform(hits, h -> sequence(h.start, h.start + h.n - 1)))))")
    return both.select("doc_id", "rest", "text", F.col("n_words").cast("long").alias("n_words"), F.when(F.size("hits") > 0, covered).otherwise(0).cast("long").alias("n_hit"), F.expr("array_distinct(transform(hits, h -> h.item_id))").alias("item_ids"))


def proximity_matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, width: int = 10, slop: int = 5) -> DataFrame:
    """(doc_id, item_id, start): spans of a window's length plus slop, in a document, that hold all distinct words of a window of the item, in any order; start is the span's first word, the least one for each window's rarest word.

    Looked up from the posting lists of each window's rarest term.
    """
    broadcast = small(benchmark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = items(benchmark, width)
    vocabulary = known.select(F.explode("words").alias("term")).distinct()
    counts = docs.select(F.explode(tokens(F.col("text"))).alias("term")).join(_side(vocabulary, broadcast), "term").groupBy("term").count()
    each = windows(known, counts, broadcast).select("item_id", "n", F.explode(F.expr("transform(sequence(0, size(words) - n), k -> slice(words, k + 1, n))")).alias("window"))
    rare = each.select("item_id", "n", F.array_distinct("window").alias("window"), F.explode("window").alias("term"))
    rare = rare.join(_side(counts, broadcast), "term").groupBy("item_id", "n", "window").agg(F.min_by("term", F.struct("count", "term")).alias("term"))
    postings = stored_index(docs, rare.select("term").distinct(), broadcast)
    hits = postings.join(_side(rare.withColumnRenamed("window", "need"), broadcast), "term")
    both = hits.join(docs.select(F.col("doc_id").alias("d"), tokens(F.col("text")).alias("tokens")), F.col("doc_id").eqNullSafe(F.col("d")))
    spans = F.expr(f"filter(sequence(greatest(0, pos - n - {slop} + 1), pos), s -> size(array_except(need, slice(tokens, s + 1, n + {slop}))) = 0)")
    return both.select("doc_id", "item_id", F.array_min(spans).alias("start")).where("start is not null").distinct()
