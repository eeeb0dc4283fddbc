"""Document fingerprints by spot signatures: chains of content words that follow common words."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.linking import linked
from forecourt.llm.tables import among
from forecourt.sources.storage import written

# Common words of English, French, German and Spanish, in that order.
COMMON = tuple(
    "the of and to a in is that it for was on are as with be by this from or an at "
    "le la les de des du et un une en dans que qui pour est par au elle sur "
    "der die das und den von zu mit sich ist ein eine im dem nicht auf als auch "
    "el los las del y se por con para es una lo su al como".split())
#: Documents of one bucket of neighbours, about.
BUCKET = 1024
_RANGES = 32


def with_signatures(df: DataFrame, text: str, into: str, chain: int = 2, distance: int = 1) -> DataFrame:
    """Adds the sorted distinct hashes of a text's signatures: a common word with the next `chain` content words,
    `distance` content words apart. Words are runs of letters and digits in lower case.

    A text with words but no signature has its whole word sequence as one. Null texts and texts without words: none.
    """
    names = df.columns
    work = f"_{into}_"
    common = lambda w: w.isin(*COMMON)
    found = df.withColumn(f"{work}w", F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    found = found.withColumn(f"{work}c", F.filter(f"{work}w", lambda w: ~common(w)))
    # The k-th common word at place p of a text has p - k content words before it.
    found = found.withColumn(f"{work}p", F.filter(F.transform(f"{work}w", lambda w, i: F.when(common(w), i)), lambda p: p.isNotNull()))
    words, content = F.col(f"{work}w"), F.col(f"{work}c")
    reach = (chain - 1) * distance
    chains = F.transform(F.filter(F.transform(f"{work}p", lambda p, k: F.struct(p.alias("p"), (p - k).alias("at"))),
                                  lambda s: s["at"] + reach < F.size(content)),
                         lambda s: F.xxhash64(F.get(words, s["p"]), *[F.get(content, s["at"] + j * distance) for j in range(chain)]))
    found = found.withColumn(f"{work}s", F.array_sort(F.array_distinct(chains)))
    whole = F.when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))
    return found.select(*names, F.when(F.size(f"{work}s") > 0, F.col(f"{work}s")).otherwise(whole).alias(into))


def fingerprint(signatures: Column) -> Column:
    """128 bits in hex that stand for a set of signatures."""
    return F.lower(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(k), signatures)), 16, "0") for k in (1, 2)]))


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard similarity of two sets of signatures, 1 for two empty ones; 0 for sets whose sizes alone keep them
    below `at_least`, whose members are then not looked at."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return F.when(large == 0, F.lit(1.0)).when(small < at_least * large, F.lit(0.0)) \
        .otherwise(common / (F.size(a) + F.size(b) - common))


def near_groups(prints: DataFrame, at_least: float = 0.8) -> DataFrame:
    """(id, component) of sets (id, signatures) linked by a Jaccard similarity of `at_least`, smallest ids left out.

    Sets are partitioned by length so that linked sets lie in the same or neighbouring partitions, and meet there
    only if they share one of their first signatures by hash: a set of n can miss the threshold's share of them and
    still be linked, so n - ceil(at_least * n) + 1 suffice. Equal sets are one. Pairs are pruned by length, then
    compared whole. Ids are unique; empty sets are linked with nothing; no rows give no rows.
    """
    sets = prints.where(F.size("signatures") > 0)
    kinds = written(sets.groupBy("signatures").agg(F.min("id").alias("id")), "kinds")
    n = F.size("signatures")
    part = F.floor(F.log(n.cast("double")) / math.log(1 / at_least) + 1e-9).cast("int")
    first = F.slice("signatures", 1, (n - F.ceil(n * at_least - 1e-9) + 1).cast("int"))
    rows = kinds.select("id", part.alias("part"), F.explode(first).alias("s"))
    buckets = rows.select("id", "s", F.explode(F.array("part", F.col("part") + 1)).alias("part")) \
        .select(F.xxhash64("part", "s").alias("key"), "id").distinct()

    def confirm(pairs: DataFrame) -> DataFrame:
        side = lambda n: kinds.select(F.col("id").alias(n), F.col("signatures").alias(f"s_{n}"))
        return pairs.join(side("a"), "a").join(side("b"), "b") \
            .where(likeness(F.col("s_a"), F.col("s_b"), at_least) >= at_least).select("a", "b")

    groups = linked(buckets, confirm).withColumnRenamed("id", "kind")
    named = sets.join(kinds.withColumnRenamed("id", "kind"), "signatures").join(groups, "kind", "left") \
        .select("id", F.coalesce("component", "kind").alias("component"))
    return named.where("id <> component")


def _bucketed(docs: DataFrame) -> DataFrame:
    """(doc_id, version, text, bucket): about BUCKET neighbours by doc_id in each, a larger bucket having larger ids.

    32 ranges hold about as many ids each, by an approximate quantile that decides nothing but sizes; they are cut
    evenly. Rows without an id have negative buckets, by hash of their text.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("version", F.xxhash64("text"))
    n, low, high, cuts = rows.agg(
        F.count("*"), F.min("doc_id"), F.max("doc_id"),
        F.percentile_approx("doc_id", [k / _RANGES for k in range(1, _RANGES)], 1000)).first()
    each = max(1, n // BUCKET)
    none = -1 - F.floor((0.5 - F.col("version") / 2.0**64) * each).cast("bigint")
    if low is None:
        return rows.withColumn("bucket", none)
    bounds = sorted({low, *cuts})
    bucket = F.lit(0).cast("bigint")
    for k, (lo, hi) in enumerate(zip(bounds, [*bounds[1:], high + 1], strict=True)):
        width = max(1, (hi - lo) * _RANGES // each)
        bucket = F.when(F.col("doc_id") >= lo, F.lit(k << 40) + F.floor((F.col("doc_id") - lo) / F.lit(width)).cast("bigint")).otherwise(bucket)
    return rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), none).otherwise(bucket))


def with_next(docs: DataFrame, chain: int = 2, distance: int = 1) -> DataFrame:
    """(doc_id, text, signatures, next_text, next_signatures): each document with the next one by descending doc_id,
    the last with the first.

    Texts are shuffled once, to their bucket of neighbours. Only the last document of a bucket takes its neighbour
    from another one: the first documents of all buckets, one of about a thousand, are read apart and joined by
    bucket, where the texts already lie. Null texts count as empty. Ties and rows without an id (which come last):
    by descending hash of the text. A single row is its own neighbour; no rows give no rows.
    """
    rows = _bucketed(docs)
    firsts = rows.groupBy("bucket").agg(F.max(F.struct("doc_id", "version")).alias("first")).select("bucket", "first.*")
    # One row for a bucket of neighbours: small enough to be put in order as a whole.
    below = Window.orderBy(F.desc("bucket"))
    # The first document of a bucket follows the bucket above, that of the highest one the lowest bucket.
    above = F.coalesce(F.lag("bucket").over(below), F.min("bucket").over(Window.partitionBy()))
    firsts = written(firsts.select("doc_id", "version", above.alias("bucket")), "firsts")
    known = written(firsts.select("version").distinct(), "versions")
    heads = among(rows.select("doc_id", "version", "text"), known, ["version"]).dropDuplicates(["doc_id", "version"])
    heads = heads.join(firsts.withColumnsRenamed({"doc_id": "id", "version": "v"}),
                       F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("version") == F.col("v")))
    heads = with_signatures(heads.select(F.col("bucket").alias("under"), F.col("text").alias("head_text")), "head_text", "head_signatures", chain, distance)
    near = with_signatures(rows.repartition("bucket"), "text", "signatures", chain, distance)
    order = Window.partitionBy("bucket").orderBy(F.desc_nulls_last("doc_id"), F.desc("version"))
    near = near.withColumn("after", F.lead(F.struct("text", "signatures")).over(order))
    both = near.join(written(heads, "heads"), F.col("bucket") == F.col("under"), "left")
    return both.select("doc_id", "text", "signatures", F.coalesce("after.text", "head_text").alias("next_text"),
                       F.when(F.col("after").isNull(), F.col("head_signatures")).otherwise(F.col("after.signatures")).alias("next_signatures"))
