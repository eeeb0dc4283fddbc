"""Fuzzy copies of lines: SimHash of normalised lines, pigeonhole blocks, edit similarity, one line of a group."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.linking import linked
from forecourt.llm.tables import FEW_IDS, among
from forecourt.sources.storage import written

#: Bits that the SimHashes of two linked lines may differ in.
FAR = 3
_ROW = ["doc_id", "version"]
_PLACE = [*_ROW, "at"]


def keyed(docs: DataFrame) -> DataFrame:
    """Documents with a hash of their text: with doc_id it tells rows apart that share one or have none."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("version"), "text")


def plain_lines(rows: DataFrame, least_words: int) -> DataFrame:
    """Lines of at least `least_words` words, as letters and digits in lower case with one space for all else."""
    normal = F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}\n]+", " ")
    lines = rows.select(*_ROW, F.posexplode(F.split(normal, "\n")).alias("at", "line"))
    plain = lines.select(*_PLACE, F.trim("line").alias("plain"))
    return plain.where((F.substring_index("plain", " ", least_words - 1) != F.col("plain")) if least_words > 1
                       else F.col("plain") != "").withColumn("kind", F.xxhash64("plain"))


#: Characters that a line of more than 2^16 - 1 distinct words has at least.
_LONG = 2 * (1 << 16) - 1


def simhashed(lines: DataFrame, lanes: int = 16) -> DataFrame:
    """(doc_id, version, at, kind, hash): a 64-bit SimHash of each line's distinct words; a bit needs more than half.

    A word that fills most of a line would decide all bits, so each counts once. A long adds up four bits of the words' hashes, with 16 bits for a counter, or with `lanes` = 32 two bits with 32.
    A line's words follow each other, so their sums are merged before the shuffle.
    """
    words = lines.select(*_PLACE, "kind", F.explode(F.array_distinct(F.split("plain", " "))).alias("w")) \
        .select(*_PLACE, "kind", F.xxhash64("w").alias("word"))
    ones = F.lit(sum(1 << at for at in range(0, 64, lanes)))
    sums = words.groupBy(*_PLACE, "kind").agg(F.count("*").alias("n"), *[
        F.sum(F.shiftrightunsigned("word", j).bitwiseAND(ones)).alias(f"s{j}") for j in range(lanes)])

    def bit(j: int, at: int) -> Column:
        count = F.shiftrightunsigned(f"s{j}", at).bitwiseAND(F.lit((1 << lanes) - 1))
        value = (1 << at + j) - ((1 << 64) if at + j == 63 else 0)
        return F.when(count * 2 > F.col("n"), F.lit(value).cast("bigint")).otherwise(F.lit(0).cast("bigint"))

    bits = [bit(j, at) for j in range(lanes) for at in range(0, 64, lanes)]
    while len(bits) > 1:
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2], strict=True)]
    return sums.select(*_PLACE, "kind", bits[0].alias("hash"))


def hashed_lines(docs: DataFrame, least_words: int) -> DataFrame:
    """The SimHash of every line: those that may have more words than a narrow counter takes, apart."""
    usual = simhashed(plain_lines(docs, least_words).where(F.length("plain") < _LONG))
    long_ = plain_lines(docs.where(F.length("text") >= _LONG), least_words).where(F.length("plain") >= _LONG)
    return usual.unionByName(simhashed(long_, 32))


def block_keys(hash_: Column, kinds: int) -> list[Column]:
    """Keys of which any two hashes at most FAR bits apart share one.

    FAR of b blocks may differ, the other b - FAR agree: one key for each choice of them. b is the least with
    which a key has as many bits as the number of hashes, so that unlike lines seldom meet at any size.
    """
    b = next((b for b in range(FAR + 1, 12) if 64 * (b - FAR) // b >= kinds.bit_length()), 12)
    cuts = [64 * k // b for k in range(b + 1)]
    masks = [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [F.xxhash64(F.lit(i), hash_.bitwiseAND(F.lit(signed(sum(some))).cast("bigint")))
            for i, some in enumerate(combinations(masks, b - FAR))]


def spelled(words: Column) -> Column:
    """A string with one character for each word, of 55,000 by hash: an edit distance of these counts words."""
    codes = F.transform(words, lambda w: F.lpad(F.hex(F.pmod(F.xxhash64(w), F.lit(55_000)) + 256), 4, "0"))
    return F.decode(F.unhex(F.array_join(codes, "")), "UTF-16BE")


def repeated_lines(docs: DataFrame, least_words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, version, at) of every line that an earlier line of its group stands for; `docs` as from `keyed`.

    Lines of equal normal form are one kind (known by a 64-bit hash). Kinds are linked if their SimHashes differ
    in at most FAR bits and their edit similarity, 1 - distance / longer length, counted in words, is at least
    `percent` / 100.
    Kinds that share a block key are candidates (`linking.linked`), whatever their number. The first line of a
    connected group, by doc_id (null last), version and place, stays.
    """
    lines = written(hashed_lines(docs, least_words), "lines")
    kinds = written(lines.groupBy("kind").agg(F.first("hash").alias("hash"), F.count("*").alias("n")), "kinds")
    number = kinds.count()
    buckets = kinds.select(F.col("kind").alias("id"), "hash", F.explode(F.array(*block_keys(F.col("hash"), number))).alias("key"))

    held: dict[str, DataFrame] = {}

    def prepare(ids: DataFrame) -> None:
        """The words of the kinds that may be compared: one place of each, then the lines there, so that a text is
        read for few documents and once."""
        asked = written(ids.withColumnRenamed("id", "kind"), "asked")
        spot = written(among(lines, asked, ["kind"]).groupBy("kind").agg(F.min(F.struct(*_PLACE)).alias("p")).select("kind", "p.*"), "spots")
        here = among(docs.where("doc_id is not null"), written(spot.select("doc_id").distinct(), "documents"), ["doc_id"]) \
            .union(docs.where("doc_id is null"))
        forms = plain_lines(here, least_words).select("kind", spelled(F.split("plain", " ")).alias("form"))
        held["forms"] = written(among(forms, asked, ["kind"]).groupBy("kind").agg(F.first("form").alias("form")), "forms")

    def confirm(pairs: DataFrame) -> DataFrame:
        forms = held["forms"]
        named = lambda n: forms.select(F.col("kind").alias(n), F.col("form").alias(f"form_{n}"))
        longest = F.greatest(F.length("form_a"), F.length("form_b"))
        both = pairs.join(named("a"), "a").join(named("b"), "b") \
            .withColumn("most", F.floor(longest * (100 - percent) / 100).cast("int"))
        # The work of a bounded distance is the length times the bound: small bounds are tried first. A distance
        # beyond its bound is -1; lengths further apart than the largest one settle a pair.
        tries = [F.expr(f"nullif(levenshtein(form_a, form_b, least({bound}, most)), -1)") for bound in (4, 32, 1 << 30)]
        return both.where(F.abs(F.length("form_a") - F.length("form_b")) <= F.col("most")) \
            .where(F.coalesce(*tries).isNotNull()).select("a", "b")

    near = lambda a, b: F.bit_count(F.col(f"hash_{a}").bitwiseXOR(F.col(f"hash_{b}"))) <= FAR
    # Two unlike lines that share a key by chance are most of all crowds: what their hashes have in common tells.
    seen = [F.bit_and("hash").alias("both"), F.bit_or("hash").alias("either")]
    worth = (F.col("crowd") > 2) | (F.bit_count(F.col("both").bitwiseXOR(F.col("either"))) <= FAR)
    groups = linked(buckets, confirm, near, prepare=prepare, seen=seen, worth=worth)
    # Only kinds that occur again, or are linked, have lines to drop.
    live = kinds.where("n > 1").select("kind").union(groups.select("id")).union(groups.select("component")).distinct()
    live = written(live.join(groups.withColumnRenamed("id", "kind"), "kind", "left")
                   .select("kind", F.coalesce("component", "kind").alias("group")), "live")
    grouped = lines.join(F.broadcast(live) if live.count() <= FEW_IDS else live, "kind").select(*_PLACE, "group")
    order = F.struct(F.col("doc_id").isNull().alias("none"), *_PLACE)
    first = grouped.groupBy("group").agg(F.min(order).alias("first"))
    return grouped.join(first, "group").where(order != F.col("first")).select(*_PLACE)


def without_repeats(docs: DataFrame, least_words: int = 5, percent: int = 80, into: str = "lines") -> DataFrame:
    """`docs` with the lines of `text` that repeat an earlier line taken out, and a struct (n_lines, n_dropped).

    Lines end with a line feed. Lines of fewer than `least_words` words always stay. Null text: null, no lines.
    An empty text: one line, which stays. Rows that repeat doc_id and text are one document: they get the same
    result, a line is compared once. Rows without doc_id come last in order. Other columns are kept; one named
    as `into` is replaced. No rows: no rows.
    """
    plain = docs.drop(into)
    gone = repeated_lines(keyed(plain), least_words, percent).groupBy(*_ROW).agg(F.sort_array(F.collect_set("at")).alias("at"))
    names = plain.columns
    # The whole row is one column, so no name of its own can clash with the keys.
    rows = plain.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"),
                        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("version"))
    gone = written(gone, "repeats").select(F.col("doc_id").alias("gone_id"), F.col("version").alias("gone_version"), F.col("at").alias("gone"))
    # Texts stay where they are while the places to drop are few.
    places = gone.agg(F.count("*"), F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()
    gone = F.broadcast(gone) if sum(places) <= FEW_IDS else gone
    both = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("version") == F.col("gone_version")), "left")
    cut = F.split("row.text", "\n")
    kept = F.filter(cut, lambda x, i: ~F.array_contains(F.col("gone"), i))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n")).alias("text")
    info = F.when(F.col("row.text").isNull(), F.struct(F.lit(0).cast("bigint").alias("n_lines"), F.lit(0).cast("bigint").alias("n_dropped"))).otherwise(
        F.struct(F.size(cut).cast("bigint").alias("n_lines"),
                 F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("bigint").alias("n_dropped"))).alias(into)
    return both.select(*[text if n == "text" else F.col(f"row.`{n}`") for n in names], info)
