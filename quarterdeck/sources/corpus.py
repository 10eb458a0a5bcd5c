"""The stored corpus: small updates at small cost, and reads that open only the files they need.

Under one folder lie

* ``data/version=N/deal_bucket=B``: the chunks that update N changed, by bucket of their deal,
* ``vectors/version=N/encoder=E``: vectors of texts that update N met for the first time,
* ``manifests/mN``: for every bucket the versions that make it up, oldest first.

An update writes changed chunks only.  A manifest counts once its success mark is there, the
last thing written, so readers never see half an update, and a run that fails is repeated
under the same number.  Readers take the newest version of each chunk.  ``compact`` brings
buckets of several versions into one, ``expire`` removes what no kept manifest names.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.operators.skew import may_hold
from quarterdeck.sources.writers import bucket_of, remove, write_table

CHUNKS = "chunk_id string, deal_id string, document string, text_key string, encoder string, embedding array<float>, deleted boolean"
LAYOUT = "version int, deal_bucket int"
VECTORS = "text_key string, embedding array<float>, version int, encoder string"

# Up to so many wanted values are written into the scan's filter; more go through a join.
LISTED_VALUES = 1000

# Texts and vectors are stored several times on their way; this takes less room than the default.
COMPRESSION = "zstd"

Layout = dict[int, list[int]]


def text_key(column: str) -> Column:
    """The name of a text by its content; null counts as empty."""
    return F.sha2(F.coalesce(F.col(column), F.lit("")).cast("binary"), 256)


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return sorted(f.getPath().toString() for f in found or ())


def manifests(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished manifests, oldest first."""
    marks = _glob(spark, f"{path}/manifests/m*/_SUCCESS")
    return sorted(int(m.rsplit("/", 2)[1].removeprefix("m")) for m in marks)


def layout(spark: SparkSession, path: str, number: int | None = None) -> Layout:
    """The versions of every bucket, oldest first, by the newest manifest or that of ``number``; at most
    ``CORPUS_BUCKETS`` lists reach the driver."""
    finished = manifests(spark, path)
    if not finished:
        return {}
    rows = spark.read.schema("deal_bucket int, versions array<int>").parquet(f"{path}/manifests/m{number or finished[-1]:06d}")
    return {r.deal_bucket: list(r.versions) for r in rows.collect()}


def _publish(spark: SparkSession, path: str, number: int, buckets: Layout) -> None:
    rows = spark.createDataFrame(sorted(buckets.items()), "deal_bucket int, versions array<int>")
    write_table(rows.coalesce(1), f"{path}/manifests/m{number:06d}")


def _folders(path: str, buckets: Iterable[tuple[int, list[int]]]) -> list[str]:
    return [f"{path}/data/version={v}/deal_bucket={b}" for b, versions in buckets for v in versions]


def _merged(spark: SparkSession, path: str, buckets: Layout) -> DataFrame:
    """The newest row of every chunk of the buckets, marks of removed ones included.

    Later versions name the chunks they replace; only these names meet the other rows, and
    only where a bucket has several versions.  Rows that a map of the names does not hold are not moved.
    """

    def read(folders: list[str]) -> DataFrame:
        reader = spark.read.schema(f"{CHUNKS}, {LAYOUT}").option("basePath", f"{path}/data")
        return reader.parquet(*folders)

    rows = read(_folders(path, buckets.items()))
    later = {b: versions[1:] for b, versions in buckets.items() if len(versions) > 1}
    if not later:
        return rows
    newer = read(_folders(path, later.items())).select(
        F.col("deal_bucket").alias("in_bucket"), F.col("chunk_id").alias("named"), F.col("version").alias("by_version")
    )
    replaced = (F.col("deal_bucket") == F.col("in_bucket")) & (F.col("chunk_id") == F.col("named"))
    told = may_hold(rows, newer.select(F.col("named").alias("chunk_id")), "chunk_id", "named_later")
    asked = told.filter("named_later").join(newer, replaced & (F.col("by_version") > F.col("version")), "left_anti")
    return told.filter("NOT named_later").unionByName(asked).drop("named_later")


def read_corpus(spark: SparkSession, path: str, deals: DataFrame | None = None) -> DataFrame | None:
    """(chunk_id, deal_id, document, text_key, encoder, embedding, deal_bucket); None where there is no corpus yet.

    With ``deals`` (deal_id) only their chunks.  Only the buckets of these deals are
    listed and opened, at most ``CORPUS_BUCKETS`` numbers reach the driver for that; the ids
    then filter the scan itself, or a join beside it when they are many.
    """
    buckets = layout(spark, path)
    if not buckets:
        return None
    if deals is not None:
        asked = {r[0] for r in deals.select(bucket_of("deal_id")).distinct().collect()}
        buckets = {b: versions for b, versions in buckets.items() if b in asked}
    if not buckets:
        return spark.createDataFrame([], f"{CHUNKS}, {LAYOUT}").drop("deleted", "version")
    rows = _merged(spark, path, buckets)
    if deals is not None:
        rows = with_values(rows, "deal_id", deals)
    return rows.filter("NOT deleted").drop("deleted", "version")


def with_values(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """``rows`` whose ``column`` stands in that of ``wanted``: by a filter the scan can use, or by a join."""
    values = wanted.select(column).filter(F.col(column).isNotNull()).distinct()
    few = [r[0] for r in values.limit(LISTED_VALUES + 1).collect()]
    if len(few) <= LISTED_VALUES:
        return rows.filter(F.col(column).isin(few))
    return may_hold(rows, values, column, "asked").filter("asked").drop("asked").join(values, column, "left_semi")


def read_vectors(spark: SparkSession, path: str, encoder: str, before: int, wanted: DataFrame) -> DataFrame:
    """(text_key, embedding) of the ``wanted`` texts (text_key) that updates before number ``before`` embedded."""
    folders = [f for f in _glob(spark, f"{path}/vectors/version=*") if int(f.rsplit("=", 1)[1]) < before]
    if not folders:
        return spark.createDataFrame([], VECTORS).select("text_key", "embedding")
    rows = spark.read.schema(VECTORS).option("basePath", f"{path}/vectors").parquet(*folders)
    return with_values(rows.filter(F.col("encoder") == encoder), "text_key", wanted).select("text_key", "embedding")


def changed_chunks(spark: SparkSession, path: str, chunks: DataFrame, encoder: str) -> DataFrame:
    """Rows of ``chunks`` that are new or differ from the stored ones in deal, text or encoder.

    Adds ``text_key``, ``deal_bucket`` and ``old_bucket``, where the chunk lies now.  Of the
    corpus only ids and keys are read, no texts or vectors.
    """
    keyed = chunks.select("chunk_id", "deal_id", "document").withColumns(
        {"text_key": text_key("document"), "deal_bucket": bucket_of("deal_id")}
    )
    known = read_corpus(spark, path)
    if known is None:
        return keyed.withColumn("old_bucket", F.lit(None).cast("int"))
    stored = known.select(
        "chunk_id",
        F.struct("deal_id", "text_key", "encoder").alias("stored"),
        F.col("deal_bucket").alias("old_bucket"),
    )
    now = F.struct("deal_id", "text_key", F.lit(encoder).alias("encoder"))
    return keyed.join(stored, "chunk_id", "left").filter(~now.eqNullSafe(F.col("stored"))).drop("stored")


def update_corpus(
    chunks: DataFrame, path: str, embed: Callable[[DataFrame], DataFrame], encoder: str
) -> tuple[int, int]:
    """Puts ``chunks`` (chunk_id, deal_id, document) into the corpus by chunk id; ids must be unique.

    ``embed`` adds ``embedding`` to rows with a ``document``; it is given each distinct text
    once, and only texts no earlier update embedded under the name ``encoder``.  Returns how
    many chunks and how many vectors were written.  Chunks as they are stored cost nothing; a
    chunk whose deal changed leaves a mark of removal where it lay.
    """
    spark = chunks.sparkSession
    finished = manifests(spark, path)
    number = finished[-1] + 1 if finished else 1
    work = f"{path}/work"
    changed = write_table(changed_chunks(spark, path, chunks, encoder), f"{work}/changed", compression=COMPRESSION)
    written = changed.count()
    if not written:
        remove(spark, work)
        return 0, 0

    texts = changed.groupBy("text_key").agg(F.first("document").alias("document"))
    have = read_vectors(spark, path, encoder, number, changed)
    missing = texts.join(have.select("text_key"), "text_key", "left_anti")
    target = f"{path}/vectors/version={number}"
    remove(spark, target)  # of a run that failed
    made = embed(missing).select("text_key", "embedding", F.lit(encoder).alias("encoder"))
    # With a bloom filter a few wanted keys open few row groups.
    writer = made.write.option("parquet.bloom.filter.enabled#text_key", "true").option("compression", COMPRESSION)
    writer.partitionBy("encoder").parquet(target)
    embedded = spark.read.schema(VECTORS).parquet(target).count()
    if not embedded:
        remove(spark, target)

    vectors = read_vectors(spark, path, encoder, number + 1, changed)
    full = changed.join(vectors, "text_key").select(
        "chunk_id", "deal_id", "document", "text_key", F.lit(encoder).alias("encoder"), "embedding",
        F.lit(False).alias("deleted"), "deal_bucket",
    )
    left = changed.filter("old_bucket != deal_bucket").select(
        "chunk_id", F.lit(True).alias("deleted"), F.col("old_bucket").alias("deal_bucket")
    )
    _write_version(full.unionByName(left, allowMissingColumns=True), path, number, layout(spark, path), keep=True)
    remove(spark, work)
    return written, embedded


def _write_version(rows: DataFrame, path: str, number: int, buckets: Layout, keep: bool) -> None:
    """Writes a version and its manifest; ``keep`` puts it on top of the versions of its buckets, else in their place."""
    spark, folder = rows.sparkSession, f"{path}/data/version={number}"
    write_table(rows, folder, ["deal_bucket"], COMPRESSION)
    touched = [int(f.rsplit("=", 1)[1]) for f in _glob(spark, f"{folder}/deal_bucket=*")]
    _publish(spark, path, number, buckets | {b: [*(buckets.get(b, []) if keep else []), number] for b in touched})


def compact(spark: SparkSession, path: str, least: int = 2) -> int:
    """Brings buckets of ``least`` versions or more into one version each; gives their number.  Other buckets stay."""
    buckets = layout(spark, path)
    chosen = {b: versions for b, versions in buckets.items() if len(versions) >= least}
    if chosen:
        rows = _merged(spark, path, chosen).filter("NOT deleted").drop("version")
        rest = {b: versions for b, versions in buckets.items() if b not in chosen}
        _write_version(rows, path, manifests(spark, path)[-1] + 1, rest, keep=False)
    return len(chosen)


def expire(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Removes all but the newest ``keep`` manifests and the data that none of these names; gives the folders removed.

    Readers of a removed manifest must be done.  Vectors stay.
    """
    finished = manifests(spark, path)
    named = {f for n in finished[-keep:] for f in _folders("", layout(spark, path, n).items())}
    gone = [f for f in _glob(spark, f"{path}/data/version=*/deal_bucket=*") if f[f.rindex("/data/version=") :] not in named]
    for folder in gone:
        remove(spark, folder)
    for number in finished[:-keep]:
        remove(spark, f"{path}/manifests/m{number:06d}")
    return len(gone)
