"""Text chunks, their vectors, and nearest chunks within a deal."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.functions.text import strip
from quarterdeck.operators.contracts import ContractError, require_columns
from quarterdeck.operators.ordering import head_per_group, ordinal_blocks, positions

CHUNK_COLUMNS = ("chunk_id", "deal_id", "document")

Encoder = Callable[[list[str]], Sequence[Sequence[float]]]


def corpus_deals(transcripts: DataFrame, emails: DataFrame) -> DataFrame:
    """Sorted distinct deal ids of both sources."""
    ids = [df.select(strip(F.col("deal_id").cast("string")).alias("deal_id")) for df in (transcripts, emails)]
    return ids[0].union(ids[1]).distinct().orderBy("deal_id")


def corpus_chunks(transcripts: DataFrame, emails: DataFrame) -> DataFrame:
    """One chunk per turn and e-mail; ids are ``deal:source:i`` with i counted in file order.

    Rows without a deal id, or with a blank one, are numbered together under ids that
    begin with a colon.
    """

    def source(df: DataFrame, name: str, text: str) -> DataFrame:
        return df.select(
            strip(F.col("deal_id").cast("string")).alias("deal_id"),
            F.lit(name).alias("source"),
            F.col("ordinal").cast("long").alias("ordinal"),
            F.coalesce(F.col(text), F.lit("")).alias("document"),
        )

    rows = source(transcripts, "transcript", "turn_text").unionByName(source(emails, "email", "body"))
    named = rows.withColumn("deal_name", F.coalesce("deal_id", F.lit("")))
    numbered = positions(named, ["deal_name", "source"], ordinal_blocks("ordinal"), ["ordinal"])
    name = F.concat_ws(":", "deal_name", "source", "position")
    return numbered.select(name.alias("chunk_id"), "deal_id", "document")


def with_embeddings(
    df: DataFrame,
    text_column: str,
    encoder: Callable[[], Encoder] | None = None,
    dimensions: int = 256,
) -> DataFrame:
    """Adds ``embedding``: one unit-length vector per text.

    ``encoder`` builds the function that turns a batch of texts into vectors; it is
    called once per Python worker, so a model loads once.  Without it, hashed word
    counts are used, computed by Spark itself.
    """
    if encoder is not None:

        @F.pandas_udf(T.ArrayType(T.FloatType()))
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            run = encoder()
            for texts in batches:
                vectors = run(texts.fillna("").tolist())
                yield pd.Series([np.asarray(v, "float32") for v in vectors])

        return df.withColumn("embedding", encode(F.col(text_column)))
    words = RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"(?U)\W+")
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dimensions)
    unit = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0)
    plain = df.withColumn("_text", F.coalesce(F.col(text_column), F.lit("")))
    fitted = Pipeline(stages=[words, counts, unit]).fit(plain)
    return (
        fitted.transform(plain)
        .withColumn("embedding", vector_to_array("_unit", "float32"))
        .drop("_text", "_words", "_counts", "_unit")
    )


def query_table(spark: SparkSession, queries: Sequence[str]) -> DataFrame:
    """The questions asked of every deal, numbered from 0; blank ones are refused."""
    if not queries or any(not q.strip() for q in queries):
        raise ContractError("query is required")
    return spark.createDataFrame([(i, q.strip()) for i, q in enumerate(queries)], "query_no int, query string")


def squared_distances(embedding: str, questions: str) -> Column:
    """Squared Euclidean distance of each row's vector to each of its question vectors.

    2 - 2 cos on unit vectors; null where a vector is missing.  One batch is one
    array subtraction; folding the arrays element by element in higher-order
    functions took more than twice as long at 64 dimensions.
    """

    # Defined here so that workers get it by value and need no copy of this package.
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def measure(vectors: pa.Array, asked_of: pa.Array) -> pa.Array:
        def as_rows(lists: pa.Array) -> np.ndarray:
            lengths = set(lists.value_lengths().drop_null().to_pylist())
            if len(lengths) > 1:
                raise ValueError(f"vectors differ in length: {sorted(lengths)}")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            return flat.reshape(-1, lengths.pop() if lengths else 1)

        counts = asked_of.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        asked = asked_of.flatten()
        present = vectors.is_valid().to_numpy(zero_copy_only=False)
        asked_present = asked.is_valid().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(vectors)), counts)
        known = present[owner] & asked_present
        distances = np.zeros(len(owner))
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype("int32")
        if known.any():
            ours, theirs = as_rows(vectors), as_rows(asked)
            our_row, their_row = np.cumsum(present) - 1, np.cumsum(asked_present) - 1
            # One question position after the other, some rows at a time: copies stay small.
            for place in range(int(counts.max())):
                with_place = np.flatnonzero(counts > place)
                for start in range(0, len(with_place), 1024):
                    rows = with_place[start : start + 1024]
                    at = offsets[rows] + place
                    both = known[at]
                    apart = ours[our_row[rows[both]]].astype("float64") - theirs[their_row[at[both]]]
                    distances[at[both]] = (apart * apart).sum(axis=1)
        return pa.ListArray.from_arrays(offsets, pa.array(distances, mask=~known))

    return measure(F.col(embedding), F.col(questions))


def query_distances(chunks: DataFrame, queries: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Distance of every chunk to each query of its deal: (deal_id, query_no, chunk_id, distance), then ``carry``.

    ``queries`` has (query_no, embedding) for questions put to all deals, or a
    deal_id as well.  A deal's queries are few, so they travel as one array beside
    each chunk; chunks of one deal never meet each other, and their texts stay behind.
    """
    chunks = chunks.select("deal_id", "chunk_id", "embedding", *carry)
    packed = F.sort_array(F.collect_list(F.struct("query_no", "embedding"))).alias("_queries")
    if "deal_id" in queries.columns:
        asked = queries.groupBy("deal_id").agg(packed)
        paired = chunks.join(asked, "deal_id")
    else:
        paired = chunks.withColumn("_queries", queries.agg(packed).scalar())
    measured = paired.withColumn("_distances", squared_distances("embedding", "_queries.embedding"))
    each = F.arrays_zip(F.col("_queries.query_no").alias("query_no"), F.col("_distances").alias("distance"))
    told = measured.select("deal_id", "chunk_id", *carry, F.inline(each))
    return told.select("deal_id", "query_no", "chunk_id", "distance", *carry)


def nearest_chunks(chunks: DataFrame, queries: DataFrame, top_k: int, one_pass: bool = False) -> DataFrame:
    """The ``top_k`` nearest chunks for each deal and query, with ``hit_rank`` from 1 and their document.

    Ids and distances alone are ranked, and the few texts that are wanted are looked up
    afterwards.  ``one_pass`` carries the texts along, which is cheaper where ``chunks`` holds
    little but the asked deals: a map task still forwards no more than the hits.
    """
    distances = query_distances(chunks, queries, ["document"] if one_pass else [])
    order = [F.asc_nulls_last("distance"), F.col("chunk_id")]
    first = head_per_group(distances, ["deal_id", "query_no"], order, max(top_k, 1), rank="hit_rank")
    if not one_pass:
        first = first.join(chunks.select("deal_id", "chunk_id", "document"), ["deal_id", "chunk_id"])
    return first.select("deal_id", "query_no", "chunk_id", "document", "distance", "hit_rank")


def merge_hits(hits: DataFrame) -> DataFrame:
    """Each chunk once per deal with its smallest distance, ranked; unknown distances last.

    Equal distances keep the order in which the queries met the chunks.
    """
    once = hits.groupBy("deal_id", "chunk_id").agg(
        F.min_by(
            F.struct("document", "distance"),
            F.struct(F.col("distance").isNull().alias("unknown"), "distance", "query_no", "hit_rank"),
        ).alias("best"),
        F.min(F.struct("query_no", "hit_rank")).alias("first_met"),
    )
    flat = once.select("deal_id", "chunk_id", "best.document", "best.distance", "first_met")
    order = Window.partitionBy("deal_id").orderBy(F.asc_nulls_last("distance"), "first_met")
    return flat.withColumn("context_rank", F.row_number().over(order)).drop("first_met")


def context_blocks(merged: DataFrame) -> DataFrame:
    """Documents of each deal in rank order, parted by blank lines.

    A deal has at most queries x top_k merged hits, so the list is short.
    """
    entry = F.when(
        F.coalesce(F.col("document"), F.lit("")) != "", F.struct("context_rank", strip(F.col("document")).alias("text"))
    )
    ordered = F.sort_array(F.collect_list(entry))["text"]
    return merged.groupBy("deal_id").agg(F.array_join(ordered, "\n\n").alias("context_block"))


def deal_context(requested: DataFrame, chunks: DataFrame, queries: DataFrame, top_k: int) -> DataFrame:
    """``requested`` with the context block and retrieval status of every deal.

    Retrieval succeeds for a deal that has an id when every question that concerns it can
    be put, even when the deal has no chunks; the block is empty then.  Chunks of other deals
    are left out before any distance is taken, and the texts come from the same pass.
    """
    asked = chunks.join(requested.select("deal_id").distinct(), "deal_id", "left_semi")
    blocks = context_blocks(merge_hits(nearest_chunks(asked, queries, top_k, one_pass=True)))
    joined = requested.join(blocks, "deal_id", "left")
    return joined.withColumns(
        {
            "context_block": F.coalesce("context_block", F.lit("")),
            "retrieval_ok": askable(F.col("deal_id")) & _questions_ok(joined, queries),
        }
    )


def askable(deal_id: Column) -> Column:
    """Whether a question can be put to a deal: it has an id that is not blank."""
    return F.coalesce(strip(deal_id.cast("string")), F.lit("")) != ""


def _questions_ok(joined: DataFrame, queries: DataFrame) -> Column:
    """Whether there are questions, none of them blank or without a vector; asked of the few questions themselves."""
    whole = F.col("embedding").isNotNull()
    if "query" in queries.columns:
        whole = whole & (F.trim(F.coalesce("query", F.lit(""))) != "")
    return queries.agg(F.coalesce(F.bool_and(whole), F.lit(False)).alias("ok")).scalar()


def retrieval_outcomes(requested: DataFrame, queries: Sequence[str]) -> DataFrame:
    """Whether each question can be asked of each deal: neither side may be blank."""
    asked = F.array(*(F.struct(F.lit(i).alias("query_no"), F.lit(bool(q.strip())).alias("ok")) for i, q in enumerate(queries)))
    each = requested.select("deal_id", askable(F.col("deal_id")).alias("named"), F.explode(asked).alias("q"))
    return each.select("deal_id", "q.query_no", (F.col("named") & F.col("q.ok")).alias("success"))


def retrieval_status(outcomes: DataFrame) -> DataFrame:
    """By deal: all queries succeeded, and how many ran; ``outcomes`` has (deal_id, query_no, success)."""
    return outcomes.groupBy("deal_id").agg(
        F.bool_and("success").alias("retrieval_ok"), F.count("*").alias("query_count")
    )


def upsert_chunks(base: DataFrame, updates: DataFrame, key: str = "chunk_id") -> DataFrame:
    """``base`` with ``updates`` put in by key; the update with the highest ordinal wins.

    Every update needs a deal_id.
    """
    require_columns(updates, [*CHUNK_COLUMNS, "ordinal"])
    names = [c for c in base.columns if c != key]
    last = updates.groupBy(key).agg(F.max_by(F.struct(*names), "ordinal").alias("last")).select(key, "last.*")
    kept = base.join(updates.select(key).distinct(), key, "left_anti")
    return kept.unionByName(last)
