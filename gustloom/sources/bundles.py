"""Landed bundles: raw bytes with their identity, VARIANT payloads, and exploded records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustloom.functions import variants as V

MODEL_KINDS = ("models", "svg", "skm", "wunstorf", "etnw")


def read_bundles(spark: SparkSession, path: str, manifest: DataFrame | None = None) -> DataFrame:
    """(path, present, sha256, n_bytes, payload): the hash and size stay where the bytes aren't JSON.

    A file that is listed but can't be read is present with a null size; it doesn't end the job. ``manifest`` has the
    paths that should be there (column ``path``, file name); one that isn't has present = false.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").load(path)
    name = F.regexp_extract("path", r"[^/]+$", 0)
    read = files.select(name.alias("path"), F.sha2("content", 256).alias("sha256"), F.octet_length("content").alias("n_bytes"), F.try_parse_json(F.expr("try_validate_utf8(content)")).alias("payload"))
    listed = files.select(name.alias("path"), F.lit(True).alias("present"))  # without the content no file is opened
    found = listed.join(read, "path", "left") if manifest is None else manifest.select("path").join(listed, "path", "left").join(read, "path", "left")
    return found.select("path", F.coalesce("present", F.lit(False)).alias("present"), "sha256", "n_bytes", "payload")


def from_text(rows: DataFrame, id_col: str = "bundle_id", json_col: str = "json") -> DataFrame:
    """The same shape from JSON text that is already in a table."""
    raw = F.col(json_col).cast("binary")
    return rows.select(F.col(id_col).alias("path"), F.col(json_col).isNotNull().alias("present"), F.sha2(raw, 256).alias("sha256"), F.octet_length(raw).alias("n_bytes"), F.try_parse_json(json_col).alias("payload"))


def spread(rows: DataFrame, *key: str) -> DataFrame:
    """The rows dealt over tasks by their key. Texts made of few bytes a row, and read again, are work that sizes in bytes don't show: left to those, a task gets most of it."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), *key)


def records(bundles: DataFrame, path: str = "$.models") -> DataFrame:
    """(path, model, pos, rec): a model's records in input order; what isn't an object is left out."""
    models = bundles.select("path", F.explode(V.entries("payload", path)).alias("model", "list"))
    rows = models.select("path", "model", F.posexplode(V.items("list")).alias("pos", "rec"))
    return rows.where(V.is_object("rec"))


def archive_records(bundles: DataFrame) -> DataFrame:
    sources = bundles.select("path", F.explode(V.entries("payload", "$.full_horizon_archive.sources")).alias("model", "source"))
    rows = sources.select("path", "model", F.posexplode(V.items("source", "$.records")).alias("pos", "rec"))
    return rows.where(V.is_object("rec"))


def attempts(bundles: DataFrame) -> DataFrame:
    rows = bundles.select("path", F.posexplode(V.items("payload", "$.provider_attempts")).alias("pos", "a")).where(V.is_object("a"))
    return rows.select("path", "pos", V.text("a", "$.model").alias("model"), F.coalesce(V.text("a", "$.stage"), F.lit("unknown")).alias("stage"), V.text("a", "$.status").alias("status"), "a")


def native_values(recs: DataFrame) -> DataFrame:
    """(path, model, pos, parameter, message, status, value, error): values are a dict, a list of dicts or an error dict."""
    fields = recs.select("path", "model", "pos", F.explode(V.entries("rec", "$.values")).alias("parameter", "raw"))
    listed = F.when(V.is_array("raw"), V.items("raw")).otherwise(F.array("raw"))
    rows = fields.select("path", "model", "pos", "parameter", F.posexplode(listed).alias("message", "item")).where(V.is_object("item"))
    return rows.select(
        "path", "model", "pos", "parameter", "message", V.text("item", "$.availability_status").alias("status"), V.number("item", "$.value").alias("value"),
        F.coalesce(V.text("item", "$.error"), V.text("item", "$.error_message"), V.text("item", "$.error_type")).alias("error"), "item",
    )


def observations(bundles: DataFrame, path: str = "$.observations") -> DataFrame:
    """(path, pos, row): rows of a station series in input order, objects or not."""
    return bundles.select("path", F.posexplode(V.items("payload", path)).alias("pos", "row"))


def defaults(bundles: DataFrame) -> DataFrame:
    """The envelope with defaults for absent sections."""
    return bundles.select(
        "path", F.coalesce(V.text("payload", "$.mode"), F.lit("unknown")).alias("mode"), V.text("payload", "$.retrieved_at_utc").alias("retrieved_at_utc"),
        F.coalesce(F.try_variant_get("payload", "$.schema_version", "int"), F.lit(1)).alias("schema_version"), V.entries("payload", "$.models").alias("models"), V.items("payload", "$.quality.errors").alias("errors"),
    )


def request_diagnostics(bundles: DataFrame) -> DataFrame:
    """(path, endpoint, success, http_status, elapsed_seconds, response_bytes, exception_type, provider_error): requests recorded as an object by endpoint or as a list.

    A provider that answers with an error flag (anything but 0, "0", false or null) hasn't succeeded.
    """
    one = bundles.select("path", F.explode(V.entries("payload", "$.request_diagnostics")).alias("endpoint", "d"))
    many = bundles.select("path", F.explode(V.items("payload", "$.requests")).alias("d")).select("path", V.text("d", "$.kind").alias("endpoint"), "d")
    flag = F.to_json(V.part("d", "$.provider_error"))
    error = F.when(~F.coalesce(flag, F.lit("null")).isin("null", "0", '"0"', "false", "0.0"), V.text("d", "$.provider_error"))
    return one.unionByName(many).select(
        "path", "endpoint", (V.truth("d", "$.success") & error.isNull()).alias("success"), F.try_variant_get("d", "$.http_status", "int").alias("http_status"), V.number("d", "$.elapsed_seconds").alias("elapsed_seconds"),
        F.try_variant_get("d", "$.response_bytes", "long").alias("response_bytes"), V.text("d", "$.exception_type").alias("exception_type"), error.alias("provider_error"),
    )


def response_bytes(diagnostics: DataFrame) -> DataFrame:
    """(path, requests, response_bytes): what each bundle's requests brought in, 0 where none says."""
    return diagnostics.groupBy("path").agg(F.count(F.lit(1)).alias("requests"), F.coalesce(F.sum("response_bytes"), F.lit(0)).alias("response_bytes"))


def pointer_json(meta: DataFrame, content: str = "content") -> DataFrame:
    """Pointers whose JSON came as base64 text with line breaks, as a VARIANT ``pointer``; null where there is none or it isn't JSON."""
    raw = F.try_to_binary(F.regexp_replace(F.col(content), r"\s+", ""), F.lit("base64"))
    return meta.withColumn("pointer", F.try_parse_json(raw.cast("string"))).drop(content)


def verified_payloads(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """(path, payload, reject): gzip files whose unpacked bytes must have the hash that ``expected`` (path, sha256) gives."""
    import gzip
    import hashlib
    import zlib
    from collections.abc import Iterable, Iterator

    import pyarrow as pa

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select(F.regexp_extract("path", r"[^/]+$", 0).alias("path"), "content")

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    raw = gzip.decompress(content)
                except (OSError, EOFError, zlib.error):
                    out.append((name, None, None))
                    continue
                out.append((name, raw.decode("utf-8", "replace"), hashlib.sha256(raw).hexdigest()))
            names, texts, hashes = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string()), pa.array(hashes, pa.string())], ["path", "text", "got"])

    raw = files.mapInArrow(unpack, "path string, text string, got string")
    joined = expected.select("path", "sha256").join(raw, "path", "left")
    reject = F.when(F.col("got").isNull(), "absent_or_not_gzip").when(F.col("got") != F.col("sha256"), "sha256_mismatch").when(F.try_parse_json("text").isNull(), "not_json")
    return joined.select("path", F.when(reject.isNull(), F.try_parse_json("text")).alias("payload"), reject.alias("reject"))
