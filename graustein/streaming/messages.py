"""Message-driven runs.

Each message names one model (a URL, or JSON ``{fileUrl, projectId}``). A micro-batch
is handled as ONE set of DataFrame jobs: the projects named by all its messages are
computed together with the batch LCA and cost functions (no per-message loop), and
one reply row per message is written.

Every message runs the whole chain: elements and materials stored, LCA and cost computed,
errors, history and project status kept, and a reply written. All tables of a micro-batch
are published by one commit (``streaming.deliveries``).

Fault tolerance: the stream's checkpoint records offsets (X2). A batch that is replayed
before its commit writes its folders again; one that was committed is left as it is (X3,
at-least-once made idempotent). A project that is delivered again shows the new delivery's
rows only, also when that has none.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graustein.functions.ids import project_from_filename, url_bucket, url_object
from graustein.sinks import commits

MESSAGE_JSON = T.StructType([T.StructField("fileUrl", T.StringType()), T.StructField("projectId", T.StringType())])


def kafka_available(spark: SparkSession) -> bool:
    """True when the Kafka connector is on the classpath."""
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")  # noqa: SLF001
        return True
    except Exception:
        return False


def kafka_messages(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest") -> DataFrame:
    """Message stream from a topic, earliest offsets, value as UTF-8 text."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting_offsets).load()
            .select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset"))


def file_messages(spark: SparkSession, path: str, fmt: str = "text", schema: T.StructType | None = None,
                  glob: str | None = None, value: Callable[[], F.Column] | None = None) -> DataFrame:
    """S11 without a broker: messages are rows of files arriving in a folder."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(path)
    return df.select(value().alias("value")) if value is not None else df


def clean_messages(messages: DataFrame) -> DataFrame:
    """P17 + H16 + H13: trimmed text, empty dropped; JSON or bare URL; bucket and object."""
    text = F.regexp_replace(F.col("value").cast("string"), "^\\s+|\\s+$", "")  # all white space, tabs too
    parsed = F.from_json(text, MESSAGE_JSON)
    is_json = text.startswith("{")
    url = F.when(is_json, parsed["fileUrl"]).otherwise(text)
    keep = [c for c in messages.columns if c != "value"]
    return (messages.select(*keep, text.alias("value"))
            .filter(F.length("value") > 0)
            .select(*keep, "value", url.alias("file_url"),
                    F.when(is_json, parsed["projectId"]).alias("project_id"))
            .withColumn("bucket", url_bucket("file_url"))
            .withColumn("object_name", url_object("file_url")))


def replies(messages: DataFrame, stats: DataFrame) -> DataFrame:
    """K5: one reply per handled message: ``{status, project_id, message}`` and its JSON."""
    s = stats.select("project_id", "total_components", "failed_components")  # one row per project
    j = messages.join(s, "project_id", "left")
    ok = F.col("total_components").isNotNull()
    message = F.when(ok, F.concat(
        F.lit("Processed "), F.col("object_name"), F.lit(": "),
        (F.col("total_components") - F.col("failed_components")).cast("string"), F.lit(" components computed, "),
        F.col("failed_components").cast("string"), F.lit(" failed"))).otherwise(
        F.concat(F.lit("No elements for project "), F.coalesce("project_id", F.lit("None"))))
    out = j.select(F.when(ok, F.lit("success")).otherwise(F.lit("error")).alias("status"), "project_id",
                   message.alias("message"), *[c for c in messages.columns if c not in ("project_id",)])
    return out.withColumn("reply", F.to_json(F.struct("status", "project_id", "message")))


@dataclass
class BatchContext:
    """What a micro-batch needs: functions giving the current reference and model tables."""
    lca_inputs: Callable[[], object]   # -> plans.jobs.LcaInputs
    output_root: str
    reply_kafka: dict | None = None    # e.g. {"kafka.bootstrap.servers": ..., "topic": ...}
    cost_reference: Callable[[], DataFrame] | None = None  # when given, the cost job runs too (C2)


def run_chain(spark: SparkSession, root: str, batch_id: int, delivered: DataFrame, elements: DataFrame, materials: DataFrame | None,
              components: DataFrame, version: str, cost_reference: DataFrame | None = None) -> DataFrame:
    """Writes all tables of a batch for the projects in ``delivered`` (project_id, ...) and returns
    their run statistics: elements, materials, components (C1), cost rows (C2), errors (K8), history
    (K9) and the projects with their new status (M3, M7). The caller adds replies and commits."""
    from graustein.operators import cost as cost_ops
    from graustein.operators import lca as lca_ops
    from graustein.plans import jobs
    from graustein.session import written_copy
    from graustein.sinks import writers
    from graustein.streaming import deliveries as dl
    started = time.time()
    write = lambda df, table: dl.write_rows(df, root, table, batch_id)
    projects = dl.write_rows(delivered, root, dl.DELIVERIES, batch_id).select("project_id").distinct()
    elements = write(elements, "elements")
    if materials is not None:
        write(materials, "materials")
    components = write(components, "components")
    stats = written_copy(lca_ops.lca_run_stats(components, version), "run_stats")  # a row per project, used four times
    errors, history = lca_ops.lca_errors(components), stats
    # M7: a project is completed once its LCA has run; with costs, their run has the last word
    status = stats.select("project_id", "status")
    if cost_reference is not None:
        costs = write(jobs.cost(elements, cost_reference), "cost_results")
        cost_stats = cost_ops.cost_run_stats(costs)
        errors = errors.unionByName(cost_ops.cost_errors(costs), allowMissingColumns=True)
        history = stats.select(*cost_stats.columns).unionByName(cost_stats)
        status = stats.select("project_id").join(cost_stats.select("project_id", "status"), "project_id")
    write(errors, "processing_errors")
    write(writers.history_rows(history, time.time() - started), "processing_history")
    # M3: created once; a delivery without a component that could be computed is a failed one
    now = F.current_timestamp()
    rows = projects.join(status, "project_id", "left").select(
        "project_id", F.coalesce("status", F.lit("failed")).alias("status"), F.lit(version).alias("kbob_version"), now.alias("updated_at"))
    if any(commits.names(spark, dl.folder(root, "projects", b)) for b in dl.committed(spark, root)):
        since = dl.read_current(spark, root, "projects").select("project_id", "created_at")
        rows = rows.join(since, "project_id", "left").withColumn("created_at", F.coalesce("created_at", now))
    else:
        rows = rows.withColumn("created_at", now)
    write(rows, "projects")
    return stats


def make_batch_handler(ctx: BatchContext):
    """The ``foreachBatch`` function. All messages of the batch in one set of jobs."""
    from graustein.plans import jobs
    from graustein.streaming import deliveries as dl

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id in dl.committed(spark, ctx.output_root):
            return  # X3: replayed after its commit
        # A message that names no project is the project its object is named after
        msgs = clean_messages(batch).withColumn("project_id", F.coalesce("project_id", project_from_filename(F.col("object_name"))))
        msgs.persist()
        try:
            inputs = ctx.lca_inputs()
            delivered = msgs.select("project_id").filter(F.col("project_id").isNotNull()).distinct()
            inputs.elements = inputs.elements.join(delivered, "project_id", "left_semi")
            comps, version = jobs.lca(inputs)
            stats = run_chain(spark, ctx.output_root, batch_id, delivered, inputs.elements, None, comps, version,
                              ctx.cost_reference() if ctx.cost_reference is not None else None)
            out = dl.write_rows(replies(msgs, stats), ctx.output_root, "replies", batch_id)
            dl.commit(spark, ctx.output_root, batch_id)
            if ctx.reply_kafka:  # K5 to a topic, when the connector is available
                (out.select(F.col("project_id").alias("key"), F.col("reply").alias("value"))
                 .write.format("kafka").options(**ctx.reply_kafka).save())
        finally:
            msgs.unpersist()

    return handle


def run_available(messages: DataFrame, ctx: BatchContext, checkpoint: str) -> None:
    """Process everything available now, then stop (tests, scheduled runs)."""
    q = (messages.writeStream.foreachBatch(make_batch_handler(ctx))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


# ---------------------------------------------------------------- model documents landing in a folder

def document_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S7 as a stream: element documents (JSON) arriving in ``landing``, one row per document
    (or bare element), with the source file and the project id from the file name (H14)."""
    from graustein import schemas
    reader = spark.readStream.schema(schemas.ELEMENT_DOCUMENT).option("multiLine", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.json(landing)
    name = F.col("_metadata.file_name")
    return df.select("*", name.alias("source_file"), project_from_filename(name).alias("project_id"))


@dataclass
class DocumentContext:
    """Reference data for document micro-batches (functions, so each batch sees the current tables)."""
    mappings: Callable[[], DataFrame]
    catalogue: Callable[[], DataFrame]
    versions: Callable[[], DataFrame]
    life: Callable[[], DataFrame]
    output_root: str
    cost_reference: Callable[[], DataFrame] | None = None


def file_replies(files: DataFrame, per_file: DataFrame) -> DataFrame:
    """K5 for documents: one reply per file; a file without a component is answered with an error."""
    n, failed = F.col("total_components"), F.col("failed_components")
    done = F.concat(F.lit("Processed "), F.col("source_file"), F.lit(": "), (n - failed).cast("string"), F.lit(" components computed, "),
                    failed.cast("string"), F.lit(" failed"))
    out = files.join(per_file, ["project_id", "source_file"], "left").select(
        F.when(n.isNotNull(), F.lit("success")).otherwise(F.lit("error")).alias("status"), "project_id", "source_file",
        F.when(n.isNotNull(), done).otherwise(F.concat(F.lit("No valid elements in "), F.col("source_file"))).alias("message"))
    return out.withColumn("reply", F.to_json(F.struct("status", "project_id", "message")))


def make_document_handler(ctx: DocumentContext):
    """X1 for documents: ingest (repeatable ids) -> validate -> LCA and cost -> replies per file, all
    documents of the micro-batch in one set of jobs and one commit."""
    from graustein.operators import catalogue as cat
    from graustein.operators import elements as el
    from graustein.operators import lca as lca_ops
    from graustein.plans.ingest import _with_uids
    from graustein.streaming import deliveries as dl

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch_id in dl.committed(batch.sparkSession, ctx.output_root):
            return  # X3: replayed after its commit
        batch.persist()  # parsed once for everything below
        try:
            compute(batch, batch_id)
        finally:
            batch.unpersist()

    def compute(batch: DataFrame, batch_id: int) -> None:
        spark, root = batch.sparkSession, ctx.output_root
        exploded = _with_uids(el.explode_documents(batch))
        # a file's project comes from its name: a file that arrives again is a new delivery of its project
        files = batch.select("project_id", "source_file").distinct()
        version = cat.active_version(ctx.versions())
        rows = el.validate_components(el.document_components(exploded))
        comps = lca_ops.lca_components(rows, ctx.mappings(), ctx.catalogue(), ctx.life(), version)
        projects_of = exploded.select("project_id", el.element_key().alias("element_id"), "source_file").distinct()
        materials = el.explode_materials(exploded).join(projects_of.select("project_id", "element_id").distinct(), "element_id")
        run_chain(spark, root, batch_id, files, el.flatten_elements(exploded), materials, comps, version,
                  ctx.cost_reference() if ctx.cost_reference is not None else None)
        written = spark.read.schema(comps.schema).parquet(dl.folder(root, "components", batch_id))  # this batch's rows only
        per_file = (written.join(projects_of, ["project_id", "element_id"]).groupBy("project_id", "source_file")
                    .agg(F.count(F.lit(1)).alias("total_components"), F.count_if("failed").alias("failed_components")))
        dl.write_rows(file_replies(files, per_file), root, "replies", batch_id)
        dl.commit(spark, root, batch_id)

    return handle


def run_documents_available(stream: DataFrame, ctx: DocumentContext, checkpoint: str) -> None:
    """Process every document that has landed, then stop."""
    q = (stream.writeStream.foreachBatch(make_document_handler(ctx))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
