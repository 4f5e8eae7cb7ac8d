"""The registered queries of the operators, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.alignment import alignment
from tidemark.llm.byte_bpe import decode_ids, encode_texts, read_ranks
from tidemark.llm.common import table
from tidemark.llm.decontaminate import contamination
from tidemark.llm.exact_dedup import exact_groups
from tidemark.llm.jaccard_join import jaccard_groups
from tidemark.llm.kneser_ney import quality_scores
from tidemark.llm.license_scan import scan_licenses
from tidemark.llm.line_dedup import deduplicate_lines
from tidemark.llm.periodic_runs import periodic_runs
from tidemark.llm.rendezvous import assign_shards
from tidemark.llm.sanitise import sanitise
from tidemark.llm.token_rollup import (
    TOKENIZERS,
    TokenRollup,
    deletes,
    inserts,
    revisions,
    token_counts,
)
from tidemark.llm.topk_search import top_k
from tidemark.staging import Stages, stage_path

SHARDS = 40
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Of the alignment: ranks, the same vocabulary as byte_bpe_50k.json, and a sentencepiece model.
ALIGNED = ("byte_bpe_50k.tiktoken", "piece_bpe_32k.model")


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and the digest of what is left of every text."""
    return deduplicate_lines(table(spark, folder, "documents")).select(
        "doc_id",
        "n_lines",
        "n_deleted",
        F.char_length(F.coalesce("text", F.lit(""))).alias("n_chars_left"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("left_sha256"),
    )


def op2_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents are inserted under two tokenizer versions, recounted by the successor of
    one, and the toxic ones deleted; every batch is committed twice, which counts once."""
    with Stages(spark) as stages:
        counts = stages(token_counts(table(spark, folder, "documents"), *TOKENIZERS), "token-counts")
        toxic = table(spark, folder, "labels").filter("toxic = 1").select("doc_id").distinct()
        gone = counts.join(toxic, "doc_id", "left_semi")
        rollup = TokenRollup(spark, stage_path(spark, "token-rollup"))
        batches = {
            "insert": inserts(counts, "whitespace-1").unionByName(inserts(counts, "letters-1")),
            "recount": revisions(counts, "letters-1", "letters-2"),
            "delete-toxic": deletes(gone, "whitespace-1").unionByName(deletes(gone, "letters-2")),
        }
        for name, deltas in [*batches.items(), *batches.items()]:
            rollup.commit(name, deltas)
        rollup.compact()
    return rollup.totals()


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_sanitise(spark: SparkSession, folder: str) -> DataFrame:
    found = sanitise(table(spark, folder, "documents"), with_text=False)
    return found.select(
        "doc_id",
        "n_email",
        "n_ip",
        "n_card",
        "n_phone",
        F.sha2("base_spans", 256).alias("base_sha256"),
        "spans",
    )


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents"), keep="largest")


def token_digests(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the encoded and decoded texts."""
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path(vocabulary))
    encoded = encode_texts(docs, ranks, public_tokenizers.PATTERN)
    return decode_ids(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(table(spark, folder, "documents"))


def op8_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_groups(table(spark, folder, "documents"), words=4, percent=85)


def op9_rendezvous(spark: SparkSession, folder: str) -> DataFrame:
    return assign_shards(
        table(spark, folder, "documents"), range(SHARDS), grown={SHARDS: 1.0}
    )


def op10_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; a tenth of the texts, by a checksum of the identifier, repeat a block
    of words from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    picked = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    numbers = (
        docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(picked, words).alias("words"))
        .withColumn("n", F.when(F.size("words") > 0, F.size("words")))
        .withColumn("a", (F.col("g") % F.col("n")).cast("int"))
        .withColumn("left", F.col("n") - F.col("a"))
        .withColumn("p", (1 + F.floor(F.col("left") / (3 + F.col("g") % 8))).cast("int"))
    )
    block = F.slice("words", F.col("a") + 1, F.col("p"))
    repeated = F.flatten(F.array_repeat(block, F.ceil(F.col("left") / F.col("p")).cast("int")))
    every = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(repeated, F.lit(1), F.col("left")))
    return numbers.select(
        "doc_id", F.when(F.col("n").isNotNull(), F.array_join(every, " ")).otherwise(F.col("text")).alias("text")
    )


def run_digests(found: DataFrame) -> DataFrame:
    """The longest run of every document (ties: smallest start, then period), and digests."""
    longest = F.array_min(
        F.transform("runs", lambda run: F.struct((-run["length"]).alias("less"), run["start"], run["period"]))
    )
    written = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.less") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(written, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_digests(periodic_runs(planted_periods(table(spark, folder, "documents"))))


def op12_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), 20, scale=64, query_every=20)


def aligned(docs: DataFrame, **options) -> DataFrame:
    """The alignment of the two public vocabularies of ``ALIGNED``."""
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path(ALIGNED[0]))
    with open(public_tokenizers.path(ALIGNED[1]), "rb") as file:
        model = file.read()
    return alignment(docs, ranks, public_tokenizers.PATTERN, model, **options)


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return aligned(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_token_rollup": op2_token_rollup,
    "op3_decontaminate": op3_decontaminate,
    "op4_sanitise": op4_sanitise,
    "op5_license_scan": op5_license_scan,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_jaccard": op8_jaccard,
    "op9_rendezvous": op9_rendezvous,
    "op10_kneser_ney": op10_kneser_ney,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_topk_search": op12_topk_search,
    "op13_alignment": op13_alignment,
}

#: The checksum is computed byte by byte from its table of steps.
ORACLE_SQL: dict[str, str] = {
    "op2_token_rollup": r"""
        WITH kept AS (
            SELECT source, lang,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS white,
                   len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}]+')) AS letters
            FROM documents
            WHERE doc_id IS NULL
               OR doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)
        ),
        totals AS (
            SELECT source, lang, 'whitespace-1' AS tokenizer,
                   count(*) AS documents, CAST(sum(white) AS BIGINT) AS tokens
            FROM kept GROUP BY source, lang
            UNION ALL
            SELECT source, lang, 'letters-2', count(*), CAST(sum(letters) AS BIGINT)
            FROM kept GROUP BY source, lang
        )
        SELECT * FROM totals WHERE documents <> 0 OR tokens <> 0
    """,
    "op6_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER g AS keep_id,
               count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op9_rendezvous": """
        WITH crc AS (
            SELECT list_transform(range(0, 256), lambda i: list_reduce(
                list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
            )) AS steps
        ),
        bytes AS (
            SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size,
                   list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                  lambda pair: CAST('0x' || pair AS BIGINT)) AS content,
                   list_transform(range(0, 41), lambda shard: CAST('0x' || substr(md5(
                       coalesce(CAST(doc_id AS VARCHAR), '') || ':' || shard), 1, 13) AS BIGINT)) AS draws
            FROM documents
        ),
        rows AS (
            SELECT doc_id, size,
                   xor(4294967295, list_reduce(list_concat([4294967295], content),
                       lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS text_crc32,
                   list_position(draws[:40], list_max(draws[:40])) - 1 AS shard,
                   list_position(draws, list_max(draws)) - 1 AS grown_shard
            FROM bytes, crc
        )
        SELECT doc_id, size, text_crc32, 'key' AS law, shard,
               row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
               grown_shard
        FROM rows
    """,
    "op12_topk_search": """
        WITH w AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM w AS q JOIN w AS c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 20 = 0
        )
        SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score
        FROM scored
        WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER best <= 20
    """,
}
