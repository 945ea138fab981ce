"""Queries over file listings, manifests and whole files."""

from __future__ import annotations

from pyspark.sql import functions as F

from loreweave.catalog.base import query, table
from loreweave.operators import files
from loreweave.session import scratch_path
from loreweave.sources.readers import read_documents

# Every document is a file of the model named by its source; the name depends on its number.
NAMES = (
    "pytorch_model-{}.bin",
    "weights-{}.safetensors",
    "model-{}.pth",
    "ggml-model-{}-q4.bin",
    "tokenizer-{}.model",
    "config-{}.json",
    "image-{}.png",
    "adapter_config.json",
)
MODEL_SQL = "source || '-' || (doc_id // 20 % 3)"
LISTING = (
    f"listing AS (SELECT doc_id, {MODEL_SQL} AS model, CASE doc_id % 31 % 9 "
    + " ".join(f"WHEN {i} THEN '" + n.replace("{}", "' || doc_id || '") + "'" for i, n in enumerate(NAMES))
    + " ELSE 'plain-' || doc_id END AS path FROM documents)"
)


def listing(spark, sf):
    n = F.col("doc_id").cast("string")
    kind = F.col("doc_id") % 31 % 9
    path = F.concat(F.lit("plain-"), n)
    for i, name in enumerate(NAMES):
        start, _, end = name.partition("{}")
        full = F.concat(F.lit(start), n, F.lit(end)) if "{}" in name else F.lit(name)
        path = F.when(kind == i, full).otherwise(path)
    model = F.concat("source", F.lit("-"), F.expr("doc_id div 20 % 3").cast("string"))
    return table(spark, sf, "documents").select("doc_id", model.alias("model"), path.alias("path"))


CLASSIFIED = f"""{LISTING}, kinds AS (SELECT *, CASE
  WHEN regexp_matches(path, '^.*\\.(txt|json|py|md)') OR regexp_matches(path, '^(tokenizer|ice).*\\.model') THEN 'text'
  WHEN regexp_matches(path, '^.*\\.safetensors') THEN 'safetensors' WHEN regexp_matches(path, '^(pytorch|adapter)_model.*\\.bin') THEN 'pytorch'
  WHEN regexp_matches(path, '^.*\\.pt') THEN 'pt' WHEN regexp_matches(path, '^.*ggml.*\\.bin') THEN 'ggml' END AS class,
  max(CASE WHEN path LIKE '%adapter_config.json' OR path LIKE '%adapter_model.bin' THEN 1 ELSE 0 END) OVER (PARTITION BY model) = 1 AS is_lora FROM listing)"""


@query("classify_files", f"WITH {CLASSIFIED} SELECT doc_id, model, path, class, is_lora FROM kinds WHERE class IS NOT NULL")
def _classify_files(spark, sf):
    return files.classify_files(listing(spark, sf)).select("doc_id", "model", "path", "class", "is_lora")


@query(
    "prefer_format",
    f"""WITH {CLASSIFIED}, safe AS (SELECT DISTINCT model FROM kinds WHERE class = 'safetensors')
SELECT doc_id, model, path, class FROM kinds WHERE class IS NOT NULL AND (class NOT IN ('pytorch', 'pt') OR model NOT IN (SELECT model FROM safe))""",
)
def _prefer_format(spark, sf):
    return files.prefer_format(files.classify_files(listing(spark, sf))).select("doc_id", "model", "path", "class")


# Pages as files: some are expected with another checksum, some expected files are not there, some were too large to hash.
MANIFEST = r"""host AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS model, sha256(html) AS h FROM pages),
manifest AS (SELECT model, 'p' || page_id AS path, CASE WHEN page_id % 17 = 3 THEN sha256('x' || page_id) ELSE h END AS sha256, page_id FROM host),
verified AS (SELECT model, path, CASE WHEN page_id % 11 = 5 THEN 'missing' WHEN page_id % 23 = 7 THEN 'too_large' WHEN page_id % 17 = 3 THEN 'failed' ELSE 'ok' END AS status FROM manifest)"""


def manifest(spark, sf):
    pages = table(spark, sf, "pages")
    n = F.col("page_id")
    path = F.concat(F.lit("p"), n.cast("string"))
    wrong = F.sha2(F.concat(F.lit("x"), n.cast("string")), 256)
    given = pages.select(
        F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("model"),
        path.alias("path"),
        F.when(n % 17 == 3, wrong).otherwise(F.sha2("html", 256)).alias("sha256"),
    )
    seen = pages.where(n % 11 != 5).select(
        path.alias("path"), F.when(n % 23 != 7, F.sha2("html", 256)).alias("sha256")
    )
    return files.verify_manifest(given, seen)


@query("verify_manifest", f"WITH {MANIFEST} SELECT model, path, status FROM verified")
def _verify_manifest(spark, sf):
    return manifest(spark, sf).select("model", "path", "status")


@query(
    "manifest_summary",
    f"""WITH {MANIFEST} SELECT model, count(*) AS files, count(*) FILTER (WHERE status = 'ok') AS ok, count(*) FILTER (WHERE status = 'failed') AS failed,
  count(*) FILTER (WHERE status = 'missing') AS missing, count(*) FILTER (WHERE status = 'too_large') AS too_large, bool_and(status = 'ok') AS validated FROM verified GROUP BY 1""",
)
def _manifest_summary(spark, sf):
    return files.manifest_summary(manifest(spark, sf))


@query(
    "manifest_join",
    "SELECT item_id AS name, octet_length(encode(text)) + 1 AS size, sha256(text || chr(10)) AS sha256, 'ok' AS status FROM benchmark",
)
def _manifest_join(spark, sf):
    # every question becomes a file; the files are read back, hashed and held against their expected checksums
    path = scratch_path(spark, "files")
    items = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("value"))
    items.repartition("item_id").write.partitionBy("item_id").text(path)
    number = F.regexp_extract("path", r"item_id=([0-9]+)/", 1)
    seen = files.hash_files(spark, path, "*.txt").withColumn("path", number)
    given = items.select(
        F.col("item_id").cast("string").alias("path"), F.sha2(F.concat("value", F.lit("\n")), 256).alias("sha256")
    )
    checked = files.verify_manifest(given, seen).join(seen.select("path", "size"), "path")
    return checked.select(F.col("path").cast("long").alias("name"), "size", "sha256", "status")


@query("read_documents", "SELECT item_id AS name, text || chr(10) AS text FROM benchmark")
def _read_documents(spark, sf):
    path = scratch_path(spark, "documents")
    items = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("value"))
    items.repartition("item_id").write.partitionBy("item_id").text(path)
    number = F.regexp_extract("path", r"item_id=([0-9]+)/", 1).cast("long")
    return read_documents(spark, path).select(number.alias("name"), "text")


# Shards: every labelled document is one member of a set of 40, so sets have gaps where labels are missing.
SHARDS = """shards AS (SELECT 'model' || (doc_id // 40) || '-' || lpad((doc_id % 40 + 1)::VARCHAR, 5, '0') || '-of-00040.bin' AS path, doc_id // 40 AS s, doc_id % 40 + 1 AS i FROM labels
  UNION ALL SELECT 'old' || (doc_id // 40) || '.' || lpad((doc_id % 40)::VARCHAR, 2, '0') || '.pth', -1, 0 FROM labels WHERE toxic = 0
  UNION ALL SELECT 'part' || (doc_id // 40) || '.bin' || CASE WHEN doc_id % 40 = 0 THEN '' ELSE '.' || (doc_id % 40) END, -1, 0 FROM labels),
members AS (SELECT 'model' || (doc_id // 40) || '-of-00040.bin' AS stem, doc_id % 40 + 1 AS i, 40 AS expected, 1 AS start FROM labels
  UNION ALL SELECT 'old' || (doc_id // 40) || '.pth', doc_id % 40, NULL, 0 FROM labels WHERE toxic = 0
  UNION ALL SELECT 'part' || (doc_id // 40) || '.bin', doc_id % 40, NULL, 0 FROM labels),
ordered AS (SELECT *, i - start - (row_number() OVER (PARTITION BY stem ORDER BY i) - 1) AS gap FROM members)
SELECT stem, count(*) AS present, count(*) FILTER (WHERE gap = 0) AS contiguous_prefix, max(expected) AS expected,
  count(*) FILTER (WHERE gap <> 0) = 0 AND (max(expected) IS NULL OR max(expected) = count(*)) AS complete FROM ordered GROUP BY 1"""


@query("shard_sets", f"WITH {SHARDS}")
def _shard_sets(spark, sf):
    s, i = F.expr("doc_id div 40").cast("string"), F.col("doc_id") % 40
    number = i.cast("string")
    labels = table(spark, sf, "labels")
    of = F.concat(F.lit("model"), s, F.lit("-"), F.lpad((i + 1).cast("string"), 5, "0"), F.lit("-of-00040.bin"))
    old = F.concat(F.lit("old"), s, F.lit("."), F.lpad(number, 2, "0"), F.lit(".pth"))
    part = F.concat(F.lit("part"), s, F.lit(".bin"), F.when(i == 0, "").otherwise(F.concat(F.lit("."), number)))
    paths = F.array_compact(F.array(of, F.when(F.col("toxic") == 0, old), part))
    return files.shard_sets(labels.select(F.explode(paths).alias("path")))
