"""The registered queries of this subpackage: each applies its operator to whole tables and derives the result columns."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tokenizer_file() -> str:
    """The byte-level vocabulary; the folder is a parameter (RASTERLOOM_TOKENIZERS), by default that of public_tokenizers."""
    if folder := os.environ.get("RASTERLOOM_TOKENIZERS"):
        return os.path.join(folder, "byte_bpe_50k.json")
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rasterloom.llm.token_counts import with_token_counts

    counted = with_token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file(), limit=512)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rasterloom.llm import warc

    pages = table(spark, sf_dir, "pages")
    manifest = warc.write_archives(pages, warc.archive_folder(pages), min_bytes=0)
    return warc.read_archives(manifest, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rasterloom.llm import mixing

    mixed = mixing.curriculum(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2.0)
    mixed = mixing.in_training_order(mixed.withColumn("position", F.array_min("positions")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "position")


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rasterloom.llm import media
    from rasterloom.llm.shared import fresh_path

    path = fresh_path(spark, "media")
    media.store_media(table(spark, sf_dir, "documents"), path)
    return media.media_features(media.read_media(spark, path))


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rasterloom.llm.decontaminate import contamination

    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10, k=5)
    return found.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).drop("items")


def op7_minhash_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rasterloom.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, percent=85)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rasterloom.llm import secrets

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.with_secrets(docs, secrets.fit(docs))
    names = F.array(*[F.lit(k) for k in secrets.KINDS])
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op8_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rasterloom.llm.sharding import kd_shards

    placed = kd_shards(table(spark, sf_dir, "documents"), shards=40, law="bytes", dimensions=("n_chars",), categories=("source", "lang"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rasterloom.llm.substring import repeated_spans

    found = repeated_spans(table(spark, sf_dir, "documents"), min_words=16)
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return found.select("doc_id", "n_words", "repeat_words", "removed_words", joined("spans").alias("spans"), joined("removed").alias("removed"), "repeated")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rasterloom.llm.langid import identified

    found = identified(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), fold=2, folds=4)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rasterloom.llm import merkle

    lowered = {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return merkle.verified(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], changed=lowered, where=tampered)


def op12_signature_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rasterloom.llm.signature_tree import similar_texts

    return similar_texts(table(spark, sf_dir, "documents"), shingle_words=5, percent=80).select("doc_id", "n_shingles", "component_id")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rasterloom.llm import conversations

    rows = table(spark, sf_dir, "conversations")
    return conversations.repaired(conversations.damaged(rows), rows.select("conv_id").distinct())


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_warc, op3_curriculum_mix, op4_media_columns, op5_winnowing,
        op6_secret_scan, op7_minhash_hamming, op8_kd_sharding, op9_chunk_dedup, op10_language_id,
        op11_merkle_manifest, op12_signature_tree, op13_conversation_repair,
    )
}

#: CRC-32 of a decimal number's digits.
_CRC = """xor(list_reduce(list_transform(string_split(CAST({x} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda r, b: list_reduce(range(0, 8), lambda d, i: xor(d >> 1, (d & 1) * 3988292384), xor(r, b)), 4294967295), 4294967295)"""
_SHA_OF = lambda text: "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _merkle_sql(depth: int = 5) -> str:
    """The tree unrolled: n0 are the leaves, n1 their runs, up to ``depth`` levels in a group; then the groups' own tree."""
    said = [
        f"d AS (SELECT doc_id, source, {_SHA_OF('text')} AS leaf, {_SHA_OF('low')} AS lowered, {_CRC.format(x='doc_id')} % 5 = 0 AS asked FROM "
        "(SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents))",
        "l AS (SELECT doc_id, source, leaf, CASE WHEN asked THEN lowered ELSE leaf END AS read, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM d)",
    ]

    def levels(p: str, key: str, first: str) -> str:
        said.append(f"{p}0 AS (SELECT {key}, r, n, h FROM {first})")
        for i in range(1, depth + 1):
            said.append(f"{p}{i} AS (SELECT {key}, r // 16 AS r, CAST(ceil(any_value(n) / 16.0) AS BIGINT) AS n, sha256(string_agg(h, '' ORDER BY r)) AS h FROM {p}{i - 1} WHERE n > 1 GROUP BY {key}, r // 16)")
            others = ", ".join(f"coalesce(string_agg(h, '') OVER (run ROWS BETWEEN {span}), '') AS {side}" for side, span in (("lft", "UNBOUNDED PRECEDING AND 1 PRECEDING"), ("rgt", "1 FOLLOWING AND UNBOUNDED FOLLOWING")))
            said.append(f"{p}s{i} AS (SELECT {key}, r, {others} FROM {p}{i - 1} WHERE n > 1 WINDOW run AS (PARTITION BY {key}, r // 16 ORDER BY r))")
        return " UNION ALL ".join(f"SELECT {key}, h FROM {p}{i} WHERE n = 1" for i in range(depth + 1))

    tops = levels("a", "source", "(SELECT source, r, n, leaf AS h FROM l)")
    said.append(f"sub AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM ({tops}))")
    root = levels("b", "k", "(SELECT 0 AS k, r, n, h FROM sub)")
    said.append(f"root AS (SELECT h AS root FROM ({root}))")
    joins, sides = "", []
    for i in range(1, depth + 1):
        joins += f" LEFT JOIN as{i} ON as{i}.source IS NOT DISTINCT FROM l.source AND as{i}.r = l.r // {16 ** (i - 1)}"
        sides.append(f"as{i}")
    for i in range(1, depth + 1):
        joins += f" LEFT JOIN bs{i} ON bs{i}.r = sub.r // {16 ** (i - 1)}"
        sides.append(f"bs{i}")
    fold = "read"
    for x in sides:
        said_fold = f"f{x}"
        joins += f", LATERAL (SELECT CASE WHEN {x}.r IS NULL THEN {fold} ELSE sha256({x}.lft || {fold} || {x}.rgt) END AS {said_fold})"
        fold = said_fold
    proof = " || ".join(f"coalesce({x}.lft || {x}.rgt, '')" for x in sides)
    return "WITH " + ",\n".join(said) + f"\nSELECT doc_id, leaf, sub.h AS subroot, root, sha256({proof}) AS proof_sha256, {fold} AS folded_root, {fold} = root AS verified FROM root, l JOIN sub ON sub.source IS NOT DISTINCT FROM l.source{joins}"


ORACLE_SQL: dict[str, str] = {
    "op11_merkle_manifest": _merkle_sql(),
    "op12_signature_tree": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
     p AS (SELECT doc_id, w, least(len(w), 5) AS k, unnest(range(0, len(w) - least(len(w), 5) + 1)) AS i FROM d WHERE len(w) > 0),
     s AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + k], ' ') AS x FROM p),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.x = y.x AND x.doc_id < y.doc_id GROUP BY ALL),
     l AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
     e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
     r AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op2_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
     k AS (SELECT page_id, octet_length(body) AS payload_bytes, upper(sha1(body)) AS hex, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           list_sum(list_transform(range(0, 5), lambda b: ((CAST(('0x' || substr(hex, 1 + (i * 5 + b) // 4, 1)) AS BIGINT) >> (3 - (i * 5 + b) % 4)) & 1) * (1 << (4 - b)))) AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM k""",
    "op5_winnowing": r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     bw AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
     bs AS (SELECT item, w, least(len(w), 10) AS n, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS i FROM bw WHERE len(w) > 0),
     bx AS (SELECT DISTINCT item, n, array_to_string(w[i + 1 : i + n], ' ') AS x FROM bs),
     sizes AS (SELECT DISTINCT n FROM bx),
     ds AS (SELECT doc_id, n, w, unnest(range(0, len(w) - n + 1)) AS i FROM dw, sizes WHERE len(w) >= n),
     dx AS (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS x FROM ds),
     occ AS (SELECT doc_id, dx.n, i, item FROM dx JOIN bx USING (n, x)),
     hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY doc_id),
     its AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS listed FROM occ GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""",
}
