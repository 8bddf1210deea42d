"""Sources and sinks: JSON lines with parse errors kept, whole JSON, file inventory and sniffing, links, conversation exports, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines): lines that do not parse keep their text and file; blank lines are neither.

    Lines are read as text and parsed after: a JSON scan refuses to return its corrupt records alone.
    """
    lines = spark.read.text(path).where("trim(value) <> ''")
    parsed = F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    every = lines.select(parsed.alias("r"), F.col("_metadata.file_path").alias("_file")).select("r.*", "_file")
    return every.where("_corrupt is null").drop("_corrupt"), every.where("_corrupt is not null").select("_file", "_corrupt")


def json_array(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The objects of files that hold one JSON array each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, modified, sha256, kind) of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"), sniffed(F.col("content"), F.col("path")).alias("kind"))


def duplicate_files(files: DataFrame) -> DataFrame:
    """(sha256, n, paths) of contents that several files hold."""
    return files.groupBy("sha256").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("path")).alias("paths")).where("n > 1")


#: Leading bytes of file formats, in hexadecimal.
MAGIC = (("pdf", "25504446"), ("zip", "504B0304"), ("png", "89504E47"), ("gzip", "1F8B"), ("sqlite", "53514C69746520666F726D6174"), ("parquet", "50415231"), ("jpeg", "FFD8FF"))


def sniffed(content: Column, path: Column) -> Column:
    """The kind of a file by its leading bytes, else by its first character or suffix, else unknown."""
    head = F.hex(F.substring(content, 1, 16))
    text = F.substring(content, 1, 256).cast("string")
    out = None
    for kind, magic in MAGIC:
        out = F.when(head.startswith(magic), kind) if out is None else out.when(head.startswith(magic), kind)
    out = out.when(F.lower(F.ltrim(text)).startswith("<!doctype html") | F.lower(F.ltrim(text)).startswith("<html"), "html").when(F.ltrim(text).rlike(r"^[\[{]"), "json")
    suffix = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    return out.when(suffix.isin("txt", "md", "csv", "yaml", "yml", "jsonl"), suffix).otherwise("unknown")


def repeated_names(files: DataFrame) -> DataFrame:
    """(name, n, contents) of file names, letter case aside, that stand at several paths, and how many contents they have."""
    return files.groupBy(F.lower(F.regexp_extract("path", r"([^/]+)$", 1)).alias("name")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sha256").alias("contents")).where("n > 1")


def extraction_gate(content: Column, path: Column, most_bytes: int = 5_000_000) -> Column:
    """What may be extracted: text (and valid JSON), deferred (documents, archives, images), or why not: too_large, not_utf8, invalid_json, unsupported."""
    kind, text = sniffed(content, path), F.try_validate_utf8(content)
    return F.when(F.length(content) > most_bytes, "too_large").when(kind.isin("pdf", "zip", "png", "jpeg", "gzip"), "deferred").when(text.isNull(), "not_utf8").when((kind == "json") & F.try_parse_json(text).isNull(), "invalid_json").when(kind.isin("json", "html", "txt", "md", "csv", "yaml", "yml", "jsonl"), "text").otherwise("unsupported")


def selected_records(rows: DataFrame, index_col: str, path_col: str, indexes: list[int] = (), paths: list[str] = ()) -> DataFrame:
    """Rows named by index or by path."""
    return rows.where(F.col(index_col).isin(list(indexes)) | F.col(path_col).isin(list(paths)))


def conversation_slice(conversations: DataFrame, id_col: str, start: int, limit: int) -> DataFrame:
    """(id, index) of the conversations start to start + limit - 1 in the order of their ids: a top-n, so only that many rows a task are kept."""
    taken = conversations.orderBy(id_col).limit(start + limit)
    one = Window.partitionBy(F.lit(1)).orderBy(id_col)  # of start + limit rows at most
    return taken.select(id_col, (F.row_number().over(one) - 1).alias("index")).where(F.col("index") >= start)


def byte_batches(rows: DataFrame, key: str, order: str, size: Column, budget: int) -> DataFrame:
    """rows with ``batch``: consecutive rows of a key whose sizes reach the budget together; the batch of a row follows from the sizes before it, so batches differ from a greedy cut by at most one row each."""
    before = F.coalesce(F.sum(size).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("batch", F.floor(before / F.lit(budget)))


def array_digest(rows: DataFrame, key: str, order: str, json: Column) -> DataFrame:
    """(key, digest): SHA-256 of the JSON array of a key's values in order (one key's array is one value, as in its file)."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), json.alias("j"))))
    return rows.groupBy(key).agg(F.sha2(F.concat(F.lit("["), F.array_join(F.transform(listed, lambda x: x["j"]), ","), F.lit("]")), 256).alias("digest"))


def links(pages: DataFrame, deny: list[str] | None = None) -> DataFrame:
    """(page_id, link, host): distinct targets of the pages' href attributes; denied hosts left out."""
    found = pages.select("page_id", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1)))).alias("link"))
    found = found.withColumn("host", F.lower(F.regexp_extract("link", r"^https?://([^/:?#]+)", 1)))
    return found.where(~F.col("host").isin(deny)) if deny else found


MAPPING_EXPORT = "id string, title string, create_time double, mapping map<string, struct<id: string, parent: string, children: array<string>, message: struct<author: struct<role: string>, content: struct<parts: array<string>>, create_time: double>>>"
CHAT_EXPORT = "uuid string, name string, created_at string, chat_messages array<struct<uuid: string, sender: string, text: string, created_at: string>>"


def detect_export(raw: DataFrame, json_col: str = "json") -> DataFrame:
    """raw with ``format``: mapping, chat, or rejected / ambiguous when not exactly one fingerprint fits."""
    mapping = F.get_json_object(json_col, "$.mapping").isNotNull()
    chat = F.get_json_object(json_col, "$.chat_messages").isNotNull()
    hits = mapping.cast("int") + chat.cast("int")
    return raw.withColumn("format", F.when(hits == 0, "rejected").when(hits > 1, "ambiguous").when(mapping, "mapping").otherwise("chat"))


def canonical_nodes(raw: DataFrame, json_col: str = "json") -> DataFrame:
    """(conversation_id, node_id, parent_id, role, value_index, text, created) of both export formats; one row a content part."""
    known = detect_export(raw, json_col)
    m = known.where("format = 'mapping'").select(F.from_json(json_col, MAPPING_EXPORT).alias("d")).select(F.col("d.id").alias("conversation_id"), F.explode("d.mapping").alias("node_id", "n"))
    m = m.select("conversation_id", "node_id", F.col("n.parent").alias("parent_id"), F.col("n.message.author.role").alias("role"), F.posexplode_outer("n.message.content.parts").alias("value_index", "text"), F.timestamp_seconds("n.message.create_time").alias("created"))
    c = known.where("format = 'chat'").select(F.from_json(json_col, CHAT_EXPORT).alias("d")).select(F.col("d.uuid").alias("conversation_id"), F.posexplode("d.chat_messages").alias("i", "n"), "d")
    c = c.select("conversation_id", F.col("n.uuid").alias("node_id"), F.when(F.col("i") > 0, F.get("d.chat_messages", F.col("i") - 1)["uuid"]).alias("parent_id"), F.col("n.sender").alias("role"), F.lit(0).alias("value_index"), F.col("n.text").alias("text"), F.try_to_timestamp("n.created_at").alias("created"))
    return m.unionByName(c)


def append_snapshot(rows: DataFrame, root: str, sync_id: str) -> None:
    """Append rows as one more snapshot, a partition of the table at root."""
    rows.withColumn("sync_id", F.lit(sync_id)).withColumn("synced_at", F.current_timestamp()).write.mode("append").partitionBy("sync_id").parquet(root)
