"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import (
    chunkrecipes,
    kdshards,
    maintext,
    merkle,
    nearduplicates,
    packing,
    projectedsearch,
    qualitymodel,
    repetition,
    secretscan,
    spectrum,
    suffixpieces,
    urlrules,
)

# Fixed rules of the url query: host, path, verdict.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
SHARDS = 40
TOKENIZER, PIECES = "word_bpe_49k.json", "piece_bpe_32k.model"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the public tokenizer files of this environment lie, on the driver and on executors alike."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return maintext.extract_main_text(table(spark, folder, "pages"))


def op2_projected_search(spark: SparkSession, folder: str) -> DataFrame:
    return projectedsearch.nearest_neighbours(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_repetition_rules(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.repetition_rules(table(spark, folder, "documents")).drop("spans")


def op4_randomness_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secretscan.scan_secrets(table(spark, folder, "documents"))


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path())


def op6_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return qualitymodel.score_documents(docs, qualitymodel.fit(docs, table(spark, folder, "labels")))


def op7_circulant_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return nearduplicates.near_duplicates(table(spark, folder, "documents"), width=2)


def op8_suffix_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return suffixpieces.encode_documents(table(spark, folder, "documents"), tokenizer_path(PIECES), with_decoded=True)


def op9_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS t(host, path, verdict)")
    return urlrules.judge_urls(table(spark, folder, "pages"), rules)


def op10_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    return kdshards.shard_documents(table(spark, folder, "documents"), SHARDS)


def op11_spectrum_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = spectrum.whitened(table(spark, folder, "embeddings"))
    # With millions of vectors the exact number leaves the range of a long: null then.
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_chunk_recipes(spark: SparkSession, folder: str) -> DataFrame:
    return chunkrecipes.exact_duplicates(table(spark, folder, "documents")).drop("n_chunks")


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.documents_manifest(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        op1_main_text,
        op2_projected_search,
        op3_repetition_rules,
        op4_randomness_scan,
        op5_best_fit_packing,
        op6_quality_model,
        op7_circulant_minhash,
        op8_suffix_pieces,
        op9_url_rules,
        op10_kd_shards,
        op11_spectrum_whitening,
        op12_chunk_recipes,
        op13_merkle_manifest,
    ]
    return {f.__name__: f for f in named}


_URL_ORACLE = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), fits AS (
  SELECT *,
    CASE WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') THEN 'net/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM fits
"""


_COPIES_ORACLE = """
WITH normal AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(text) AS text_sha256
FROM normal WINDOW w AS (PARTITION BY text)
"""


def _crc32(text: str) -> str:
    """SQL for the CRC-32 of an ASCII string; its table follows from the polynomial."""
    entries = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        entries.append(str(value))
    step = f"xor(c >> 8, [{', '.join(entries)}][((xor(c, x)) & 255) + 1])"
    codes = f"list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, x: {step}), 4294967295::BIGINT)"


def _merkle_oracle(levels: int = 9, upper: int = 4) -> str:
    """The manifest in SQL, for up to 8^levels rows of a group and 8^upper groups.

    Trees of fewer levels hand their only node on. Each level gives its nodes with the run they
    stand in; a leaf meets the runs of all levels above it.
    """

    def said(value: str) -> str:
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value} END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(f"({said(v)})" for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        f"""leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY lang) AS nodes
  FROM (SELECT doc_id, lang, {leaf("text")} AS leaf,
               CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0 THEN {leaf(lower)} ELSE {leaf("text")} END AS changed
        FROM documents)
)""",
        "t0 AS (SELECT lang AS tree, place, nodes, leaf AS node FROM leaves)",
    ]

    def reduce(name: str, count: int) -> None:
        for n in range(count):
            steps.append(
                f"""{name}r{n} AS (
  SELECT tree, place // 8 AS run, nodes, list(node ORDER BY place) AS run_nodes FROM {name}{n} GROUP BY tree, place // 8, nodes
)"""
            )
            steps.append(
                f"""{name}{n + 1} AS (
  SELECT tree, run AS place, (nodes + 7) // 8 AS nodes,
         CASE WHEN nodes = 1 THEN run_nodes[1] ELSE sha256(array_to_string(run_nodes, '')) END AS node
  FROM {name}r{n}
)"""
            )

    reduce("t", levels)
    steps.append(
        f"""g0 AS (
  SELECT 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place, count(*) OVER () AS nodes, node, tree AS lang FROM t{levels}
)"""
    )
    reduce("g", upper)
    runs = [("t", n, f"l.place // {8**n}") for n in range(levels)] + [("g", n, f"g0.place // {8**n}") for n in range(upper)]
    joins, others = [], []
    for name, n, place in runs:
        alias = f"{name}r{n}"
        key = f"{alias}.tree IS NOT DISTINCT FROM l.lang AND " if name == "t" else ""
        joins.append(f"JOIN {alias} ON {key}{alias}.run = ({place}) // 8")
        kept = f"list_filter({alias}.run_nodes, lambda d, i: i <> ({place}) % 8 + 1)"
        others.append(f"CASE WHEN {alias}.nodes = 1 THEN '' ELSE array_to_string({kept}, '') END")
    steps.append(
        f"""proofs AS (
  SELECT l.doc_id, l.leaf, l.changed, g0.node AS subroot, g{upper}.node AS root,
         sha256({" || ".join(others)}) AS proof_sha256,
         [{", ".join(f"struct_pack(place := ({p}) % 8, run_nodes := {a}r{n}.run_nodes, alone := {a}r{n}.nodes = 1)" for a, n, p in runs)}] AS path
  FROM leaves l JOIN g0 ON g0.lang IS NOT DISTINCT FROM l.lang CROSS JOIN g{upper}
  {" ".join(joins)}
)"""
    )
    previous = "SELECT *, changed AS node FROM proofs"
    for n in range(len(runs)):
        step = f"path[{n + 1}]"
        run = f"list_transform({step}.run_nodes, lambda d, i: CASE WHEN i = {step}.place + 1 THEN node ELSE d END)"
        steps.append(f"f{n} AS ({previous})")
        previous = f"SELECT * REPLACE (CASE WHEN {step}.alone THEN node ELSE sha256(array_to_string({run}, '')) END AS node) FROM f{n}"
    return (
        "WITH "
        + ",\n".join(steps)
        + f"\nSELECT doc_id, leaf, subroot, root, proof_sha256, node AS folded_root, node = root AS verified FROM ({previous})"
    )


def oracle_sql() -> dict[str, str]:
    return {
        "op9_url_rules": _URL_ORACLE,
        "op12_chunk_recipes": _COPIES_ORACLE,
        "op13_merkle_manifest": _merkle_oracle(),
    }
