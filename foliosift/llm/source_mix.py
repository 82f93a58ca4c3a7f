"""Operator 10, mixing sources to target weights by Sainte-Laguë apportionment.

1. A document's size is its number of words (``[^\\x20\\x09-\\x0D]+``). The sources, in code
   point order with null last, weigh 5, 2, 1 and so on; together they share ``share`` times
   all words. No target exceeds ``ceiling`` times its source's size: the excess goes to the
   others by weight until none is above.
2. Each source's documents are dealt to shards of about ``shard_words`` words by a seeded
   hash. In a shard they stand in seeded order and form one stream of words, cut into blocks
   of ``block_words`` words.
3. Blocks are allotted by highest quotients: to the sources by target, then each source's
   blocks to its racks (of up to ``_RACK`` shards) and each rack's to its shards, by words.
   Every shard gets an integer quota.
4. A shard takes its whole stream as often as the quota allows and, for the rest, a run of
   blocks from a seeded position on, around the end. What a document gives follows from its
   place in the stream.

Words are counted once, into a narrow stage table; only ids, hashes and sizes are shuffled.
The source table has one row per source; shards spread a source with a third of the corpus
over many tasks. Documents with the same id and text are interchangeable in the order, so
reruns agree. Null and empty texts have size 0 and are never taken; an empty table gives an
empty result. Null ids and sources are ordinary values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliosift.llm.common import fresh_name, quoted, require_columns, row_key
from foliosift.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Shards whose quotients are ranked together.
_RACK = 1024


def highest_quotients(parties: DataFrame, group: str, party: str, weight: str, seats: str) -> DataFrame:
    """Sainte-Laguë: (group, party, quota), with ``seats`` (one value in a group) dealt by
    weight; ties go to the smaller party, parties without weight get nothing.

    Not all quotients are listed. Rounding the exact shares q leaves at most n/2 of H seats
    open among n parties, so a party gets between q(1 - n/H) - 1 and q(1 + n/H) + 1 seats;
    only the quotients in that range are ranked, about four a party.
    """
    totals = parties.groupBy(group).agg(
        F.sum(weight).cast("double").alias("all_weight"),
        F.count(F.lit(1)).alias("all_parties"),
        F.max(seats).alias("all_seats"),
    )
    share = F.col(weight) * F.col("all_seats") / F.col("all_weight")
    slack = F.col("all_parties") / F.col("all_seats")
    ranged = (
        parties.join(totals, group)
        .where((F.col(weight) > 0) & (F.col("all_seats") > 0))
        .select(
            group,
            party,
            F.col(weight).cast("double").alias("w"),
            "all_seats",
            F.greatest(F.lit(0), F.floor(share * (1 - slack)) - 1).cast("bigint").alias("sure"),
            F.least(F.col("all_seats"), F.ceil(share * (1 + slack)) + 1).cast("bigint").alias("most"),
        )
    )
    dealt = ranged.groupBy(group).agg(F.sum("sure").alias("dealt"))
    seat = F.explode(F.sequence(F.col("sure") + 1, F.greatest(F.col("most"), F.col("sure") + 1))).alias("seat")
    ranked = (
        ranged.select("*", seat)
        .withColumn("quotient", F.col("w") / (2 * F.col("seat") - 1))
        .withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("quotient"), party, "seat")))
        .join(dealt, group)
    )
    won = F.sum((F.col("rank") <= F.col("all_seats") - F.col("dealt")).cast("bigint"))
    return ranked.groupBy(group, party).agg((F.max("sure") + won).alias("quota"))


def source_targets(sizes: DataFrame, share: float, ceiling: int, weights: tuple[int, ...]) -> DataFrame:
    """source, place, source_size, target: one row per source of ``sizes`` (source, size).

    The windows see one row per source.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = (
        sources.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * float(ceiling))
    )
    # Filling up by weight: in the order of cap / weight, sources reach their cap one by one.
    before = Window.orderBy(F.col("cap") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    filled = ranked.withColumn("level", level)
    holds = F.col("level") <= F.col("cap") / F.col("weight")
    reached = F.min(F.when(holds, F.struct((F.col("cap") / F.col("weight")).alias("r"), "place", "level"))).over(everything)
    return filled.withColumn("reached", reached).select(
        "source", "place", "source_size",
        F.least("cap", F.coalesce(F.col("weight") * F.col("reached.level"), F.col("cap"))).alias("target"),
    )


def _number(text: Column, below: Column) -> Column:
    """A seeded whole number in [0, below)."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") % below


def place_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = 1.5,
    ceiling: int = 2,
    weights: tuple[int, ...] = (5, 2, 1),
    seed: int = 0,
    block_words: int = 32,
    shard_words: int = 1_000_000,
) -> DataFrame:
    """doc_id, seed_key, size, source_size, target, whole, parts: how often the mix takes a
    document whole, and which further word ranges [from, to) of it."""
    require_columns(docs, id_col, text_col, source_col)
    sized = materialise(
        docs.select(
            quoted(id_col).alias("doc_id"),
            quoted(source_col).cast("string").alias("source"),
            F.coalesce(F.regexp_count(quoted(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
            seed_key(quoted(id_col), quoted(text_col), seed).alias("seed_key"),
        ),
        "mix",
    )
    sources = materialise(source_targets(sized, share, ceiling, weights), "mix-sources")
    # The hot source is dealt by salt for this look-up; null-safe by an extra flag.
    salted = lambda df, salt: df.select("*", salt.alias("salt"), F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")).drop("source")  # noqa: E731, E501
    known = salted(sources, F.explode(F.sequence(F.lit(0), F.lit(7))))
    placed = salted(sized, _number(F.col("seed_key"), F.lit(8)).cast("int")).join(known, ["none", "name", "salt"])
    shards = F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))
    placed = placed.withColumn("shard", _number(F.concat(F.lit("shard|"), F.col("seed_key")), shards))
    by_shard = materialise(placed.groupBy("place", "shard").agg(F.sum("size").alias("words")), "mix-shards")

    # The narrow inputs of each level are stored, which keeps the plans short.
    blocks = sources.select(
        F.lit(0).alias("every"), "place", "target",
        F.round(F.sum("target").over(Window.partitionBy()) / block_words).cast("bigint").alias("seats"),
    )
    of_source = highest_quotients(materialise(blocks, "mix-level"), "every", "place", "target", "seats")
    of_source = of_source.select("place", F.col("quota").alias("seats"))
    # A rack's key holds its source, a shard's key its rack: both are single numbers.
    keyed = by_shard.withColumn("rack", F.col("place") * (1 << 32) + F.floor(F.col("shard") / _RACK))
    racks = keyed.groupBy("place", "rack").agg(F.sum("words").alias("words")).join(of_source, "place")
    of_rack = highest_quotients(materialise(racks, "mix-level"), "place", "rack", "words", "seats")
    dealt = keyed.join(of_rack.select("rack", F.col("quota").alias("seats")), "rack")
    quotas = highest_quotients(materialise(dealt, "mix-level"), "rack", "shard", "words", "seats")
    n = F.ceil(F.col("words") / block_words)
    quotas = keyed.join(quotas, ["rack", "shard"]).where("words > 0").select(
        "place",
        "shard",
        "words",
        F.least("quota", ceiling * n).alias("quota"),
        n.alias("blocks"),
        _number(F.concat_ws("|", F.lit("start"), F.lit(seed).cast("string"), "place", "shard"), n).alias("start"),
    )
    quotas = materialise(quotas, "mix-quotas")

    stream = Window.partitionBy("place", "shard").orderBy("seed_key").rowsBetween(Window.unboundedPreceding, 0)
    words = placed.where("size > 0").withColumn("end", F.sum("size").over(stream)).join(quotas, ["place", "shard"], "left")
    rest = F.col("quota") % F.col("blocks")
    last = F.col("start") + rest
    cut = lambda a, b: F.struct(
        F.greatest(a * block_words - F.col("end") + F.col("size"), F.lit(0)).cast("bigint").alias("from"),
        F.least(b * block_words - F.col("end") + F.col("size"), F.col("size")).cast("bigint").alias("to"),
    )
    around = cut(F.lit(0), F.greatest(last - F.col("blocks"), F.lit(0)))
    parts = F.array(around, cut(F.col("start"), F.least(last, F.col("blocks"))))
    nothing = F.expr("cast(array() as array<struct<from:bigint,to:bigint>>)")
    facts = ("doc_id", "seed_key", "size", "source_size", "target")
    used = words.select(
        *facts,
        F.coalesce(F.floor(F.col("quota") / F.col("blocks")), F.lit(0)).alias("whole"),
        F.when(F.col("quota").isNull(), nothing).otherwise(F.filter(parts, lambda p: p["to"] > p["from"])).alias("parts"),
    )
    # A source may consist of texts without words; those have no place in a stream.
    empty = placed.where("size = 0").select(*facts, F.lit(0).cast("bigint").alias("whole"), nothing.alias("parts"))
    return used.unionByName(empty)


def seed_key(doc_id: Column, text: Column, seed: int) -> Column:
    """The place of a document in the seeded order."""
    texts = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null")), texts).cast("binary"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted) for every document."""
    length = F.aggregate("parts", F.lit(0).cast("bigint"), lambda sum_, p: sum_ + p["to"] - p["from"])
    return place_words(docs, **options).select(
        "doc_id", "size", "source_size", "target",
        (F.col("whole") * F.when(F.col("size") > 0, F.col("size")).otherwise(0) + length).alias("taken"),
    )


def take(docs: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row per whole copy and per word range."""
    places = place_words(docs, id_col=id_col, text_col=text_col, seed=seed, **options)
    row, key, part = (fresh_name(docs, n) for n in ("row", "key", "part"))
    # Documents with one key are equal in id and text; of n of them each place is used once, in an
    # order that a task run again finds again: that of all their columns.
    nth = lambda df, k, by: df.withColumn("nth", F.row_number().over(Window.partitionBy(k).orderBy(by)))
    order = fresh_name(docs, "order")
    packed = docs.select(
        seed_key(quoted(id_col), quoted(text_col), seed).alias(key),
        row_key(docs, skip=(text_col,)).alias(order),
        F.struct(*[quoted(c) for c in docs.columns]).alias(row),
    )
    whole = F.when(F.col("whole") > 0, F.array_repeat(F.lit(None).cast("struct<from:bigint,to:bigint>"), F.col("whole").cast("int")))
    pieces = F.concat(F.coalesce(whole, F.expr("cast(array() as array<struct<from:bigint,to:bigint>>)")), F.col("parts"))
    taken = nth(places.where("size > 0 AND (whole > 0 OR size(parts) > 0)"), "seed_key", F.to_json(F.struct("whole", "parts"))).select(
        F.col("seed_key").alias(key), "nth", pieces.alias(part)
    )
    joined = nth(packed.where(F.col(row)[text_col].rlike(WORD)), key, F.col(order)).join(taken, [key, "nth"]).select(row, F.explode(part).alias(part))
    text = F.col(row)[text_col]
    ranged = F.regexp_extract_all(text, F.lit(rf"({WORD}[\x20\x09-\x0D]*)"), 1)
    cut = F.array_join(F.slice(ranged, F.col(part)["from"].cast("int") + 1, (F.col(part)["to"] - F.col(part)["from"]).cast("int")), "")
    text = F.when(F.col(part).isNull(), text).otherwise(cut)
    return joined.select(*[(text if c == text_col else F.col(row)[c]).alias(c) for c in docs.columns])
