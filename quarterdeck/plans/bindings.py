"""The analytics tables, derived from the star-schema test tables.

Each function has a twin of the same name in ``oracles.VIEWS``, written in SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.params import ReviewRules, ToneRules

AS_OF = dt.date(2024, 1, 31)
MARKET_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
REVIEW = ReviewRules(segments=MARKET_SEGMENTS)
TONE = ToneRules(positive=("the", "ing", "re", ". e"), negative=("tion", "on", ". th"), decline_threshold=-0.05)
LETTERS = "aent"
RIVALS = ("Aldermoor", "Brightwater", "Cobalt Row", "Dunmere")
THEMES = ("pricing", "product fit")


# Columns read from each table.  With the schema stated, opening a table runs no job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_brand string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string",
    "documents": "doc_id long, text string, lang string, source string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "conversations": "conv_id long, turn long, role string, text string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def raw_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines under the headers of the sales export."""
    lines = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders")
    customers = table(spark, sf, "customer")
    nations = table(spark, sf, "nation")
    regions = table(spark, sf, "region")
    parts = table(spark, sf, "part")
    joined = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
    )
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return joined.select(
        F.col("o_orderdate").cast("date").alias("Order Date"),
        F.col("c_mktsegment").alias("Segment"),
        F.col("p_brand").alias("Product"),
        F.col("r_name").alias("Region"),
        F.col("n_name").alias("Subregion"),
        (price * (1 - discount)).alias("Sales"),
        (price * (F.lit(0.05) - discount)).alias("Profit"),
        F.col("l_quantity").alias("Quantity"),
    )


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    return orders.join(customers, orders.o_custkey == customers.c_custkey)


def bookings(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate")
    return _orders(spark, sf).select(
        F.col("o_orderkey").alias("opportunity_id"),
        F.col("c_mktsegment").alias("segment"),
        F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string")).alias("quarter"),
        F.col("o_totalprice").alias("booked_arr"),
        (F.col("o_orderkey") % 13).cast("double").alias("benchmark_growth_pct"),
        (F.col("o_custkey") % 14).cast("double").alias("actual_growth_pct"),
    )


def opportunities(spark: SparkSession, sf: str) -> DataFrame:
    """Order status stands for the stage; every third loss names no competitor."""
    key = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    stage = F.when(status == "F", "Closed Won").when(status == "P", "Closed Lost").otherwise("Proposal")
    rival = F.get(F.array(*(F.lit(r) for r in RIVALS)), key % 4)
    theme = F.get(F.array(*(F.lit(t) for t in THEMES)), (key / 4).cast("long") % 2)
    reason = (
        F.when(status == "F", "Won on product fit")
        .when((status == "P") & (key % 3 == 0), "Lost due to missing feature")
        .when(status == "P", F.concat(F.lit(" Lost to "), rival, F.lit(" on "), theme))
    )
    return _orders(spark, sf).select(
        key.alias("opportunity_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_name").alias("account_name"),
        F.col("o_totalprice").alias("arr"),
        stage.alias("stage"),
        reason.alias("win_loss_reason"),
    )


def benchmarks(spark: SparkSession, sf: str) -> DataFrame:
    """One benchmark per market segment: its mean account balance in thousands."""
    cents = F.sum(F.rint(F.col("c_acctbal") * 100).cast("long"))
    return (
        table(spark, sf, "customer")
        .groupBy(F.col("c_mktsegment").alias("segment"))
        .agg(F.round(cents / F.count("*") / 100000.0, 2).alias("benchmark_growth_pct"))
    )


def deal_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order; a customer's deal repeats with each order."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit(" DEAL-"), F.col("o_custkey").cast("string")).alias("deal_id"),
        F.col("o_orderstatus").alias("stage"),
        F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit(" ")).alias("close_date"),
        F.col("o_totalprice").alias("arr"),
        F.col("o_orderpriority").alias("rep_name"),
        F.concat(F.lit("Account "), F.col("o_custkey").cast("string")).alias("account_name"),
        F.col("o_orderkey").alias("ordinal"),
    )


def activity(spark: SparkSession, sf: str) -> DataFrame:
    """Events, dated back by user so that gaps differ."""
    day = F.date_sub(F.col("ts").cast("date"), (F.col("user_id") % 30).cast("int"))
    return table(spark, sf, "events").select(
        F.concat(F.lit("DEAL-"), F.col("user_id").cast("string")).alias("deal_id"),
        F.col("event_type").alias("activity_type"),
        day.cast("string").alias("activity_date"),
        F.lit(None).cast("string").alias("contact_role"),
    )


def transcripts(spark: SparkSession, sf: str) -> DataFrame:
    turn = F.col("turn")
    call = (F.floor(turn / 2) + 1).cast("int")
    role = F.col("role")
    speaker = F.when(role == "user", "Kim (Buyer)").when(role == "assistant", "Lee (Rep)").otherwise("System")
    return table(spark, sf, "conversations").select(
        F.concat(F.lit("DEAL-"), F.col("conv_id").cast("string")).alias("deal_id"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), call * 7).cast("string").alias("call_date"),
        call.alias("call_num"),
        (turn % 2 + 1).cast("int").alias("turn_num"),
        speaker.alias("speaker"),
        F.col("text").alias("turn_text"),
        turn.alias("ordinal"),
    )


def emails(spark: SparkSession, sf: str) -> DataFrame:
    """Ten documents to a deal; every seventeenth has no timestamp."""
    key = F.col("doc_id")
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (key % 40).cast("int")).cast("string")
    return table(spark, sf, "documents").select(
        F.concat(F.lit("DEAL-"), F.floor(key / 10).cast("string")).alias("deal_id"),
        F.col("text").alias("body"),
        F.when(key % 17 != 0, F.concat(day, F.lit(" 09:00:00"))).alias("timestamp"),
        key.alias("ordinal"),
    )


def vector_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.concat(F.lit("C"), F.col("vec_id").cast("string")).alias("chunk_id"),
        F.concat(F.lit("DEAL-"), F.col("label").cast("string")).alias("deal_id"),
        F.concat(F.lit("chunk "), F.col("vec_id").cast("string")).alias("document"),
        "embedding",
        F.col("vec_id").alias("ordinal"),
    )


def vector_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Three questions per deal: the vectors of its first three chunks."""
    from quarterdeck.operators.ordering import head_per_group

    first = head_per_group(vector_chunks(spark, sf), ["deal_id"], ["ordinal"], 3)
    ranked = first.groupBy("deal_id").agg(F.sort_array(F.collect_list(F.struct("ordinal", "embedding"))).alias("q"))
    return ranked.select("deal_id", F.posexplode("q").alias("query_no", "item")).select(
        "deal_id", "query_no", F.col("item.embedding").alias("embedding")
    )


def search_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Web pages as hits of one query per site host."""
    key = F.col("page_id")
    return table(spark, sf, "pages").select(
        F.concat(F.lit("query "), (F.floor(key / 25)).cast("string")).alias("query"),
        key.alias("ordinal"),
        F.when(key % 5 != 0, F.concat(F.lit("Page "), key.cast("string"))).alias("title"),
        F.when(key % 7 != 0, F.col("url")).alias("url"),
        F.date_sub(F.lit(AS_OF), (key % 300).cast("int")).alias("published"),
        F.when(key % 3 == 0, F.array(F.col("url"), F.lit("seen"))).alias("highlights"),
        F.col("html").alias("text"),
    )


def benchmark_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Model answers around document facts: plain, wrapped in prose, without the figure, broken."""
    key = F.col("doc_id")
    facts = F.concat(
        F.lit('"source_summary": "'), F.col("source"), F.lit('", "benchmark_growth_pct": '), (key % 30).cast("string")
    )
    answer = (
        F.when(key % 5 == 0, F.concat(F.lit(" {"), facts, F.lit(', "confidence": "high"}\n')))
        .when(key % 5 == 1, F.concat(F.lit("Here it is:\n{"), facts, F.lit("}\nas asked.")))
        .when(key % 5 == 2, F.concat(F.lit('{"source_summary": "'), F.col("source"), F.lit('"}')))
        .when(key % 5 == 3, F.concat(F.lit("{"), facts))
        .otherwise(F.concat(F.lit("no figure for "), F.col("source")))
    )
    return table(spark, sf, "documents").select("doc_id", answer.alias("answer"))


def action_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Model answers with action lists: fenced, plain, too short, without narrative, broken."""
    key = F.col("doc_id")

    def action(rank: int):
        return F.concat(F.lit(f'{{"rank":{rank},"segment":"'), F.col("lang"), F.lit('"}'))

    three = F.concat(F.lit('"actions":['), action(1), F.lit(","), action(2), F.lit(","), action(3), F.lit("]"))
    told = F.concat(F.lit('"narrative":"about '), F.col("source"), F.lit('"'))
    answer = (
        F.when(key % 6 == 0, F.concat(F.lit("Sure.\n```json\n{"), three, F.lit(","), told, F.lit("}\n```\nDone.")))
        .when(key % 6 == 1, F.concat(F.lit("{"), three, F.lit(","), told, F.lit("}")))
        .when(key % 6 == 2, F.concat(F.lit('{"actions":['), action(1), F.lit("],"), told, F.lit("}")))
        .when(key % 6 == 3, F.concat(F.lit("{"), three, F.lit(',"narrative":" "}')))
        .when(key % 6 == 4, F.concat(F.lit("{"), three, F.lit(',"narrative":7}')))
        .otherwise(F.concat(F.lit("{"), three))
    )
    return table(spark, sf, "documents").select("doc_id", answer.alias("answer"))


def signal_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Model answers on competitors: all fields, some fields, broken."""
    key = F.col("doc_id")
    answer = (
        F.when(
            key % 3 == 0,
            F.concat(
                F.lit('{"g2_sentiment":"positive","g2_summary":"'),
                F.col("source"),
                F.lit('","threat_level":"high","headline":"h'),
                key.cast("string"),
                F.lit('","recent_launches":["a",'),
                key.cast("string"),
                F.lit("]}"),
            ),
        )
        .when(key % 3 == 1, F.concat(F.lit('{"pricing_signal":"'), F.col("lang"), F.lit('"}')))
        .otherwise(F.lit("nothing found"))
    )
    return table(spark, sf, "documents").select("doc_id", answer.alias("answer"))


def letter_encoder():
    """A small text encoder both engines can compute: shares of four letters, at unit length."""
    letters = LETTERS

    def encode(texts: list[str]) -> list[list[float]]:
        vectors = []
        for text in texts:
            counts = [float(text.count(letter)) for letter in letters]
            length = sum(c * c for c in counts) ** 0.5
            vectors.append([c / length for c in counts] if length else counts)
        return vectors

    return encode
