"""Bottom-k document fingerprints, made and compared by built-in functions.

A fingerprint is the ``SIZE`` smallest distinct hashes of a text's shingles
(``WORDS`` words; a shorter text is one shingle) and is written as a string of
16 hex digits each, in ascending order. Fingerprints of parts merge into that
of the whole, and give resemblance, containment and the number of distinct
shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_key, partitions, scratch, table

SIZE = 128
WORDS = 5


def words_of(text: Column) -> Column:
    """Runs outside space and ``\\t\\n\\v\\f\\r``; null has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.array_remove(F.split(plain, " "), "")


def sketch(text: Column, size: int = SIZE, words: int = WORDS) -> Column:
    """The ``size`` smallest distinct shingle hashes, ascending (array of long)."""

    def of(w: Column) -> Column:
        n = F.size(w)
        starts = F.sequence(F.lit(0), F.greatest(n - words, F.lit(0)))
        # A place beyond the end is null, which the hash skips: a short text is one shingle.
        hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(words)]))
        return F.when(n == 0, F.array().cast("array<long>")).otherwise(F.slice(F.sort_array(F.array_distinct(hashes)), 1, size))

    # transform over one element, so that the words are split once
    return F.transform(F.array(words_of(text)), of)[0]


def merge(a: Column, b: Column, size: int = SIZE) -> Column:
    """The sketch of two parts' shingles together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, size)


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of common shingles in all; 1 if both have none."""
    union = merge(a, b, size)
    common = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(common / F.size(union)).cast("double")


def distinct_shingles(a: Column, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact below ``size``."""
    share = F.element_at(a, size).cast("double") / F.lit(2.0**64) + F.lit(0.5)
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise((size - 1) / share)


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has; 1 if ``a`` has none."""
    both = resemblance(a, b, size) * distinct_shingles(merge(a, b, size), size)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, size)))


def text_of(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def fingerprints(docs: DataFrame, size: int = SIZE, words: int = WORDS) -> DataFrame:
    """``docs`` and ``sketch``, ``fingerprint``, ``distinct_shingles`` of each text.

    Null counts as empty; such texts have an empty fingerprint. Columns of these
    names are replaced.
    """
    docs = docs.drop("sketch", "fingerprint", "distinct_shingles").withColumn("sketch", sketch(F.col("text"), size, words))
    return docs.withColumns({"fingerprint": text_of(F.col("sketch")), "distinct_shingles": distinct_shingles(F.col("sketch"), size)})


def next_documents(docs: DataFrame) -> DataFrame:
    """For each distinct (doc, th) of ``docs`` the one that follows by descending id.

    After the last comes the first. Ids are sorted by range, so no task holds
    more than its range: within it the next row is a window function, and
    the ranges' first rows (one for each partition) are linked to one another.
    """
    ids = docs.select("doc", "th", "n").distinct()
    ids = scratch(ids.repartitionByRange(partitions(docs.sparkSession), F.desc("doc"), "th").withColumn("part", F.spark_partition_id()))
    ends = ids.groupBy("part").agg(F.max(F.struct("doc", F.expr("-cast(th as decimal(38))").alias("minus"))).alias("e"))
    ends = ends.selectExpr("part", "e.doc as e_doc", "cast(-e.minus as long) as e_th")
    # One row for each partition of the range exchange.
    ends = ends.selectExpr("part", "coalesce(lead(struct(e_doc, e_th)) over (order by part), first(struct(e_doc, e_th)) over (order by part)) as after")
    inner = ids.selectExpr("doc", "th", "n", "part", "lead(struct(doc as e_doc, th as e_th)) over (partition by part order by doc desc, th) as inside")
    return inner.join(F.broadcast(ends), "part").selectExpr("doc", "th", "n", "coalesce(inside, after).e_doc as next_doc", "coalesce(inside, after).e_th as next_th")


def edited_fingerprints(docs: DataFrame, size: int = SIZE, words: int = WORDS) -> DataFrame:
    """Fingerprints of each text and of an edited one, whose last third comes from the next document.

    The last ``floor(n_chars / 3)`` code points give way to the first as many
    (or all) of the next document's, by descending id; after the last comes the
    first. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next (resemblances), distinct_shingles
    and contained_in_edited.

    Null text counts as empty, null ids come last. Of rows that share an id the
    order is that of the texts' hashes; equal rows count as one document and get
    the same result each. A single document is its own next. Other columns are
    ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), doc_key().alias("doc"))
    texts = texts.withColumns({"th": F.xxhash64("text"), "n": F.char_length("text").cast("long")})
    following = scratch(next_documents(texts), few=8)
    one_each = following.selectExpr("doc as p_doc", "th as p_th", "n as p_n", "next_doc as doc", "next_th as th")
    texts = texts.drop("n")
    # Both joins are on (doc, th): one exchange of the texts serves both. What the next document lends, with its
    # sketch, then goes to the document before it.
    lent = texts.select("doc_id", "doc", "th", "text").join(one_each, ["doc", "th"])
    lent = lent.dropDuplicates(["doc_id", "doc", "th", "p_doc", "p_th"])  # doc_id, so that the exchange is the same
    lent = lent.select(F.col("p_doc").alias("doc"), F.col("p_th").alias("th"), F.substring("text", F.lit(1), F.floor(F.col("p_n") / 3).cast("int")).alias("head"), sketch(F.col("text"), size, words).alias("next_sketch"))
    joined = texts.select("doc_id", "doc", "th", "text").join(lent, ["doc", "th"])
    n = F.char_length("text")
    edited = F.concat(F.substring("text", F.lit(1), n - F.floor(n / 3).cast("int")), F.col("head"))
    both = joined.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), sketch(F.col("text"), size, words).alias("a"), "next_sketch")
    both = both.withColumn("b", sketch(F.col("edited"), size, words))
    a, b = F.col("a"), F.col("b")
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), text_of(a).alias("fingerprint"), text_of(b).alias("edited_fingerprint"),
        resemblance(a, b, size).alias("near_edited"), resemblance(a, F.col("next_sketch"), size).alias("near_next"),
        distinct_shingles(a, size).alias("distinct_shingles"), containment(a, b, size).alias("contained_in_edited"),
    )


def op4_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
