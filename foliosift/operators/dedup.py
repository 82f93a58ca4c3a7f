"""Exact and near-duplicate removal: keep the document with the smallest id.

Shuffled rows are narrow (hashes and ids, never text) and every grouping is a ``min``
or ``count`` that Spark combines before the shuffle, so a group of copies that holds a
third of the corpus arrives as one row per input partition. No pairs are formed and
no bucket is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliosift import values
from foliosift.functions.measures import squeezed_lower, word_ngrams

_TEXT_KEY = "text_key"
_FIRST = "first_id"
# Types of fixed width: their minimum is found in a hash table, that of other types by a sort.
_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _known(id_col: str) -> Column:
    """The id, or an error for a null: verdicts return by id, so a null id would lose its row."""
    return F.coalesce(F.col(id_col), F.raise_error(F.lit("duplicate removal needs ids that are not null")))


def text_key(col: Column) -> Column:
    """Never null, so that texts can be found again by it; a missing text has a key of its own."""
    return F.coalesce(F.md5(col), F.lit(""))


def _keep(df: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``df`` named by (id, text key); of rows equal in both, one."""
    keys = [id_col, _TEXT_KEY]
    keyed = df.select("*", text_key(F.col(text_col)).alias(_TEXT_KEY))
    return keyed.join(kept.select(*keys), keys, "left_semi").dropDuplicates(keys).select(*df.columns)


def exact_first(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None
) -> DataFrame:
    """One row per distinct text: its key, its smallest id and its number of copies.

    With a stored ``key_col`` the texts are not read.
    """
    key = text_key(F.col(text_col)) if key_col is None else F.col(key_col)
    return df.groupBy(key.alias(_TEXT_KEY)).agg(
        F.min(_known(id_col)).alias(_FIRST), F.count(F.lit(1)).alias("copies")
    )


def drop_exact_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per distinct text. Ids may repeat, but must not be null."""
    kept = exact_first(df, id_col, text_col).withColumnRenamed(_FIRST, id_col)
    return _keep(df, kept, id_col, text_col)


def shingle_value(shingle: Column) -> Column:
    """The first 28 bits of the shingle's md5 as a number."""
    return F.conv(F.substring(F.md5(shingle), 1, 7), 16, 10).cast("bigint")


def minhash_signature(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = values.SHINGLE_WORDS,
    copies_gone: bool = False,
) -> DataFrame:
    """``text_key, first_id, m0 … m31``: one MinHash signature per distinct text.

    Grouping the shingles by text instead of by document makes this one aggregate do
    the exact stage as well: copies have equal shingles and fall into one row. Where every
    text has one id (``copies_gone``) the id is a key beside it. So it is for ids without a fixed
    width too, whose minimum would need all shingles sorted; that is then taken of the signatures.
    A text of fewer than ``n`` words is one shingle.
    """
    squeezed = squeezed_lower(F.col(text_col))
    texts = df.select(
        _known(id_col).alias(_FIRST), text_key(F.col(text_col)).alias(_TEXT_KEY),
        squeezed.alias("squeezed"),
    )
    grams = texts.select(_FIRST, _TEXT_KEY, "squeezed", word_ngrams(F.col("squeezed"), n).alias("g"))
    shingles = grams.select(
        _FIRST,
        _TEXT_KEY,
        F.explode(F.when(F.size("g") > 0, F.col("g")).otherwise(F.array("squeezed"))).alias("s"),
    )
    hashed = shingles.select(_FIRST, _TEXT_KEY, shingle_value(F.col("s")).alias("x"))
    minima = [
        F.min((F.lit(a) * F.col("x") + F.lit(b)) % F.lit(values.MINHASH_PRIME)).alias(f"m{i}")
        for i, (a, b) in enumerate(values.MINHASH_COEFFICIENTS)
    ]
    first = F.min(_FIRST).alias(_FIRST)
    if not copies_gone and isinstance(texts.schema[_FIRST].dataType, _FIXED):
        return hashed.groupBy(_TEXT_KEY).agg(first, *minima)
    signatures = hashed.groupBy(_FIRST, _TEXT_KEY).agg(*minima)
    columns = [F.min(name).alias(name) for name in signatures.columns[2:]]
    return signatures if copies_gone else signatures.groupBy(_TEXT_KEY).agg(first, *columns)


def band_keys(signatures: DataFrame, bands: int = values.MINHASH_BANDS) -> DataFrame:
    """``first_id, text_key, band, r0 … r3``: the LSH keys of every signature, one row per band."""
    rows = len(values.MINHASH_COEFFICIENTS) // bands
    per_band = [
        F.struct(
            F.lit(band).alias("band"),
            *[F.col(f"m{band * rows + r}").alias(f"r{r}") for r in range(rows)],
        )
        for band in range(bands)
    ]
    return signatures.select(_FIRST, _TEXT_KEY, F.inline(F.array(*per_band)))


def bucket_first(keys: DataFrame) -> DataFrame:
    """The smallest id of every LSH bucket; of two texts under one id, that with the smaller key."""
    rows = [name for name in keys.columns if name.startswith("r")]
    firsts = keys.groupBy("band", *rows).agg(F.min(F.struct(_FIRST, _TEXT_KEY)).alias("first"))
    return firsts.select("band", *rows, "first.*")


def near_first(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = values.SHINGLE_WORDS,
    bands: int = values.MINHASH_BANDS,
    key_col: str | None = None,
    copies_first: bool = False,
) -> DataFrame:
    """Ids and text keys of the documents that are kept, in ``id_col`` and ``text_key``.

    With ``copies_first`` exact copies go first, by their narrow keys (of a stored ``key_col``
    without reading a text), so that no copy is cut into shingles; that moves the texts once.
    Without it only hashes and ids are moved, and copies fall together in their signatures.
    A document is kept if no bucket of it holds a smaller id. It has one bucket per band,
    so that is the same as being the smallest id of ``bands`` buckets: counting wins
    replaces the join of every document with its buckets.
    """
    if copies_first:
        key = text_key(F.col(text_col)) if key_col is None else F.col(key_col)
        first = exact_first(df, id_col, text_col, key_col).select(F.col(_FIRST).alias(id_col), _TEXT_KEY)
        # The join's keys spread a group of copies by their ids.
        df = df.select(id_col, text_col, key.alias(_TEXT_KEY)).join(first, [id_col, _TEXT_KEY], "left_semi")
    firsts = bucket_first(band_keys(minhash_signature(df, id_col, text_col, n, copies_first), bands))
    winner = (F.col(_FIRST).alias(id_col), _TEXT_KEY)
    wins = firsts.groupBy(*winner).agg(F.count(F.lit(1)).alias("wins"))
    return wins.where(F.col("wins") == bands).select(id_col, _TEXT_KEY)


def drop_near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """Keep the documents of :func:`near_first`, exact copies dropped with the rest."""
    return _keep(df, near_first(df, id_col, text_col, **{"copies_first": True} | settings), id_col, text_col)


def mark_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    reason_col: str = "reject_reason",
    key_col: str | None = None,
    **settings,
) -> DataFrame:
    """Give accepted rows the reason ``exact_duplicate`` or ``near_duplicate``.

    Rows that already carry a reason take no part and keep it. Rows with equal id and text
    share one verdict. ``df`` is read several times (keys, signatures, result), so it should be a
    stored table.
    """
    keys = [id_col, _TEXT_KEY]
    columns = df.columns
    if key_col is None:
        df = df.withColumn(_TEXT_KEY, text_key(F.col(text_col)))
    elif key_col != _TEXT_KEY:
        df = df.withColumn(_TEXT_KEY, F.col(key_col))
    open_rows = df.where(F.col(reason_col).isNull())
    kept = near_first(open_rows, id_col, text_col, key_col=_TEXT_KEY, **{"copies_first": True} | settings).withColumn("_kept", F.lit(True))
    first = exact_first(open_rows, id_col, text_col, _TEXT_KEY).select(
        F.col(_FIRST).alias(id_col), _TEXT_KEY, F.lit(True).alias("_first")
    )
    reason = (
        F.when(F.col(reason_col).isNotNull(), F.col(reason_col))
        .when(F.col("_kept"), F.lit(None))
        .when(F.col("_first"), F.lit("near_duplicate"))
        .otherwise(F.lit("exact_duplicate"))
    )
    verdict = first.join(kept, keys, "left")
    return df.join(verdict, keys, "left").withColumn(reason_col, reason).select(*columns)
