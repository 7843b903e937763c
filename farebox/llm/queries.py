"""The registered queries over this package's operators, with their production parameters."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm import (
    decontaminate,
    html_text,
    infill,
    merkle,
    mixing,
    packing,
    quality,
    secrets,
    simhash,
    suffixes,
    tokens,
    toxicity,
    warc,
)
from farebox.llm.common import new_folder, ship

VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """Where this machine has the public tokenizer's file, which Spark sends to all others."""
    import public_tokenizers

    path = public_tokenizers.path(VOCABULARY)
    SparkSession.active().sparkContext.addFile(path)
    return path


def warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    manifest = warc.write_archives(pages, new_folder(spark, "warc"))
    records = warc.read_archives(manifest)
    # A response's digest is that of the payload as read; a revisit only has its header.
    digest = F.coalesce(F.sha1("payload"), F.col("declared_digest"))
    kind = pages.schema["page_id"].dataType
    return records.select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        digest.alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
        "problem",
    )


def template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.measured(rows)[0].drop("text")


def ngram_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = toxicity.train(docs, labels.filter(~held_out))
    return toxicity.scored(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.secrets(docs, secrets.identifiers(docs))


def pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


def sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


def token_digests(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    return tokens.read_tokens(manifest).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def simple8b_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = tokens.write_tokens(docs, new_folder(spark, "tokens"), vocabulary())
    return token_digests(spark, manifest)


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def merkle_witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # One record of five is tampered with.
    touched = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    fields = {name: F.col(name) for name in merkle.FIELDS}
    theirs = F.when(touched, merkle.record_digest((fields | {"text": lowered}).values()))
    claimed = F.coalesce(theirs, merkle.record_digest(fields.values()))
    proofs = merkle.manifest(docs, claimed).trees().proofs()
    return merkle.verified(proofs).withColumnRenamed("id", "doc_id")


def vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.sequences(table(spark, sf_dir, "documents"), vocabulary())
    part = F.col("part")
    ids = F.substring("ids", part["offset"] * 4 + 1, part["length"] * 4)
    return packed.select("sequence_id", "ids", F.explode("parts").alias("part")).select(
        part["doc_id"].alias("doc_id"),
        part["piece"].alias("piece"),
        part["start"].alias("start"),
        part["length"].alias("length"),
        F.crc32(ids).alias("ids_crc32"),
        "sequence_id",
        part["offset"].alias("offset"),
    )


def infill_rank_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = infill.transformed(table(spark, sf_dir, "documents"))
    output, form = F.col("output"), F.col("form")
    return rows.select(
        F.col("id").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(output, 256).alias("output_sha256"),
        F.sha2(infill.restored(output, form), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_segments": warc_segments,
    "op2_template_decontamination": template_decontamination,
    "op3_simhash_pivots": simhash_pivots,
    "op4_compression_bands": compression_bands,
    "op5_ngram_toxicity": ngram_toxicity,
    "op6_secret_novelty": secret_novelty,
    "op7_pivotal_mix": pivotal_mix,
    "op8_sparse_suffixes": sparse_suffixes,
    "op9_simple8b_tokens": simple8b_tokens,
    "op10_page_text": page_text,
    "op11_merkle_witnesses": merkle_witnesses,
    "op12_vector_packing": vector_packing,
    "op13_infill_rank_index": infill_rank_index,
}

def crc32(text: str) -> str:
    """The checksum of an ASCII text, as SQL: a byte, then a bit at a time."""
    bits = "lambda x, z: xor(x >> 1, (x & 1) * 3988292384)"
    step = f"lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), {bits})"
    first = "[CAST(4294967295 AS UBIGINT)]"
    letters = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1)))"
    return f"xor(list_reduce(list_concat({first}, {letters}), {step}), 4294967295)"


def record(text: str) -> str:
    """The digest of a document, as SQL."""
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    parts = [f"coalesce(strlen({value}) || ':' || {value}, '-')" for value in values]
    return f"sha256({' || '.join(parts)})"


lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

# The SQL that gives the same rows, where there is any; the others are tested against
# brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_warc_segments": """
        WITH sized AS (
            SELECT page_id, coalesce(html, '') AS payload,
                   strlen(coalesce(html, '')) AS payload_bytes
            FROM pages),
        last AS (
            SELECT payload, max(page_id) AS largest FROM sized
            WHERE payload_bytes >= 1000 GROUP BY payload)
        SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
               CASE WHEN largest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN largest <> page_id THEN largest END AS refers_to,
               CAST(NULL AS VARCHAR) AS problem
        FROM sized LEFT JOIN last USING (payload)""",
    "op11_merkle_witnesses": f"""
        WITH RECURSIVE
        records AS (
            SELECT *, row_number() OVER () AS row, 's' || source AS name,
                   {crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 AS touched
            FROM documents),
        leaves AS (
            SELECT row, doc_id, coalesce(name, '') AS tree, {record("text")} AS leaf,
                   CASE WHEN touched THEN {record(lowered)} ELSE {record("text")} END AS claimed
            FROM records),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1
                   AS pos, count(*) OVER (PARTITION BY tree) AS n
            FROM leaves),
        nodes AS (
            SELECT tree, 0 AS level, pos, n, leaf AS digest FROM placed
            UNION ALL
            SELECT tree, level + 1, pos // 16, (n + 15) // 16,
                   sha256(string_agg(digest, '' ORDER BY pos))
            FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 16, n),
        sources AS (
            SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos,
                   count(*) OVER () AS n
            FROM nodes WHERE n = 1),
        above AS (
            SELECT 0 AS level, pos, n, digest FROM sources
            UNION ALL
            SELECT level + 1, pos // 16, (n + 15) // 16,
                   sha256(string_agg(digest, '' ORDER BY pos))
            FROM above WHERE n > 1 GROUP BY level, pos // 16, n),
        -- The tree above has a name that no source's tree has.
        every AS (
            SELECT tree, level, pos, n, digest FROM nodes
            UNION ALL SELECT 'top', level, pos, n, digest FROM above),
        steps AS (
            SELECT tree, level, pos,
                   coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING
                       AND 1 PRECEDING), '') AS lefts,
                   coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING
                       AND UNBOUNDED FOLLOWING), '') AS rights
            FROM every WHERE n > 1
            WINDOW run AS (PARTITION BY tree, level, pos // 16 ORDER BY pos)),
        walk AS (
            SELECT row, tree, 0 AS level, pos, '' AS proof, claimed AS fold FROM placed
            UNION ALL
            SELECT row, tree, walk.level + 1, walk.pos // 16, proof || lefts || rights,
                   sha256(lefts || fold || rights)
            FROM walk JOIN steps USING (tree, pos) WHERE steps.level = walk.level),
        arrived AS (
            SELECT row, tree, arg_max(proof, level) AS proof, arg_max(fold, level) AS fold
            FROM walk GROUP BY row, tree),
        walk_above AS (
            SELECT row, 0 AS level, pos, proof, fold FROM arrived JOIN sources USING (tree)
            UNION ALL
            SELECT row, walk_above.level + 1, walk_above.pos // 16, proof || lefts || rights,
                   sha256(lefts || fold || rights)
            FROM walk_above JOIN steps USING (pos)
            WHERE tree = 'top' AND steps.level = walk_above.level),
        ended AS (
            SELECT row, arg_max(proof, level) AS proof, arg_max(fold, level) AS fold
            FROM walk_above GROUP BY row),
        top AS (SELECT digest AS root FROM above WHERE n = 1)
        SELECT doc_id, leaf, digest AS subroot, root, sha256(proof) AS proof_sha256,
               fold AS folded_root, fold = root AS verified
        FROM placed JOIN ended USING (row) JOIN sources USING (tree) CROSS JOIN top""",
    "op13_infill_rank_index": r"""
        WITH tokens AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
                   regexp_extract_all(coalesce(text, ''),
                       '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t
            FROM documents),
        hashes AS (
            SELECT *, CAST(len(t) AS BIGINT) AS n,
                   CAST(CAST('0x' || h[1:8] AS UBIGINT) % (len(t) + 1) AS BIGINT) AS c1,
                   CAST(CAST('0x' || h[9:16] AS UBIGINT) % (len(t) + 1) AS BIGINT) AS c2,
                   CAST('0x' || h[17:24] AS UBIGINT) % 100 AS h3,
                   CAST('0x' || h[25:32] AS UBIGINT) % 100 AS h4
            FROM tokens),
        parts AS (
            SELECT *, coalesce(array_to_string(t[1:least(c1, c2)], ''), '') AS p,
                   coalesce(array_to_string(t[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS m,
                   coalesce(array_to_string(t[greatest(c1, c2) + 1:n], ''), '') AS s,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                             OR contains(text, '<M>') OR h3 >= 50 THEN 'plain'
                        WHEN h4 < 80 THEN 'spm' ELSE 'psm' END AS form
            FROM hashes)
        SELECT doc_id, n, form,
               CAST(CASE WHEN form <> 'plain' THEN length(p) END AS BIGINT) AS prefix_chars,
               CAST(CASE WHEN form <> 'plain' THEN length(m) END AS BIGINT) AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                      WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts""",
}
