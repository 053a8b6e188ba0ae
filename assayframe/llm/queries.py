"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, chat, decontaminate, folders, line_dedup, near_dedup, packing, quality, repair, repeats, token_counts, token_files, toxicity, vantage

TOKENIZER = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_vantage_point_trees")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    trees, shards = vantage.index(vectors, "vec_id", "embedding", dim=64)
    return vantage.nearest(trees, shards, vectors.filter("vec_id % 100 = 0"), "vec_id", "embedding", dim=64, k=10)


def _sql_escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\e')"
    for mark in chat.CONTROL:
        out = f"replace({out}, '{mark}', '{mark[0]}\\-{mark[1:]}')"
    return out


@query(
    "op2_prefix_targets",
    f"""WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(8 + length({_sql_escaped("replace(role, chr(10), '?')")}) + (length(role) - length(replace(role, chr(10), '')))
            + length({_sql_escaped("text")})) AS BIGINT) AS formatted_chars
    FROM turns GROUP BY conv_id""",
)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    turns = turns.unionByName(spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text")))
    found = chat.read_back(chat.expand(turns))
    replies = F.array_join("replies", "")
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(replies).cast("long").alias("loss_chars"),
        F.sha2(replies, 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query("op3_decontamination")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_items", "n_windows")


@query("op4_repeated_passages")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    found = repeats.repeated_passages(table(spark, sf, "documents"), length=50)
    return found.select(F.col("id").alias("doc_id"), F.size("spans").cast("long").alias("n_spans"), "n_words", "spans")


@query("op5_near_dedup")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "kept")


@query("op6_token_files")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    folder = folders.new_folder(spark, "token-files")
    listed = token_files.write_token_files(table(spark, sf, "documents"), folder, public_tokenizers.path(TOKENIZER), end_id=2)
    return token_files.read_token_files(folders.save(listed, "file-list"), folder)


@query("op7_length_buckets")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    # the tokens of the text and an end mark
    counted = token_counts.count_tokens(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER), keep=("doc_id",))
    docs = counted.select("doc_id", (F.col("n_tokens") + 1).alias("length"))
    return packing.pack(docs, "length", buckets=8, max_len=8192, budget=65_536)


@query(
    "op8_line_dedup",
    r"""WITH lines AS (
        SELECT doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
        FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
            generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
    gone AS (SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (k IN (SELECT k FROM gone)) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (k NOT IN (SELECT k FROM gone)), '')) AS kept_sha256
    FROM lines GROUP BY doc_id""",
)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf, "documents"), min_docs=10, keep="none", columns=("doc_id",), distinct_ids=True)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op9_quality")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    trees = quality.train(docs, table(spark, sf, "labels"))
    scored = quality.score(docs, trees, cut=0.3, columns=("doc_id",))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op10_token_counts")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER), keep=("doc_id",))


@query("op11_token_alignment")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    found = alignment.align(docs, a, b, columns=("doc_id",), describe=lambda groups: F.when(groups == "", "").otherwise(F.sha2(groups, 256)))
    return found.withColumnRenamed("groups", "groups_sha256")


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with planted faults, chosen by the CRC-32 of conversation and turn."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("act"))
    return rows.filter("act <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("act") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("act") == 1, "").when(F.col("act") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("act") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _moves_sql() -> str:
    """What one row may become, with rows inserted before it: from place, initial, inserted rows, edit, to place, new role."""
    moves = []
    for place in range(4):
        at, before = place, []
        for inserts in range(3):
            there = "user" if at != 2 else "assistant"
            after = 2 if at != 2 else 3
            inserted = "[" + ", ".join(f"'{r}:'" for r in before) + "]::VARCHAR[]"
            moves.append(f"({place}, NULL, {inserts}, 'D', {at}, NULL, 2, {inserted})")
            moves.append(f"({place}, NULL, {inserts}, 'R', {after}, '{there}', 1, {inserted})")
            kept = [("s", 1)] if at == 0 else []
            kept += [("a", 3)] if at == 2 else [("u", 2)]
            moves += [f"({place}, '{initial}', {inserts}, 'K', {to}, NULL, 0, {inserted})" for initial, to in kept]
            before, at = [*before, there], after
    return ", ".join(moves)


@query(
    "op12_conversation_repair",
    rf"""WITH RECURSIVE keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
    coded AS (
        SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, flatten([[(ord(c) >> b) & 1 for b in range(8)] for c in string_split(k, '')])::BIGINT[]),
            lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) % 20 AS act FROM keyed),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN act = 4 THEN 'user' ELSE role END AS role,
            CASE act WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(range(CASE act WHEN 3 THEN 2 WHEN 0 THEN 0 ELSE 1 END)) AS copy FROM coded),
    numbered AS (
        SELECT conv_id, turn, role, text, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '-' END AS initial,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
            regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS last FROM damaged),
    rows AS (
        SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
            lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair, max(n) OVER (PARTITION BY conv_id) AS size FROM numbered),
    moves(place, initial, inserts, op, next, new_role, cost, inserted) AS (VALUES {_moves_sql()}),
    paths AS (
        SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS n, 0 AS place, CAST(0 AS BIGINT) AS cost, '' AS audit, []::VARCHAR[] AS lines FROM rows
        UNION ALL
        SELECT conv_id, n, place, cost, audit, lines FROM (
            SELECT p.conv_id, r.n, m.next AS place, p.cost + m.cost + 5 * m.inserts + CASE WHEN r.fault = 'truncated' AND m.op <> 'D' THEN 5 ELSE 0 END AS cost,
                p.audit || repeat('I', m.inserts) || m.op AS audit,
                list_concat(list_concat(p.lines, m.inserted), CASE WHEN m.op = 'D' THEN [] ELSE [coalesce(m.new_role, r.role) || ':' || r.text] END) AS lines
            FROM paths p JOIN rows r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.n = p.n + 1
            JOIN moves m ON m.place = p.place AND (m.initial IS NULL OR m.initial = r.initial) AND (m.op = 'D' OR r.fault NOT IN ('blank', 'duplicate')))
        QUALIFY row_number() OVER (PARTITION BY conv_id, place ORDER BY cost, audit) = 1),
    ends(place, inserts, more) AS (VALUES (0, 0, []::VARCHAR[]), (1, 2, ['user:', 'assistant:']), (2, 1, ['assistant:']), (3, 0, [])),
    best AS (
        SELECT p.conv_id, p.cost + 5 * e.inserts AS cost, p.audit || repeat('I', e.inserts) AS audit, list_concat(p.lines, e.more) AS lines
        FROM paths p JOIN ends e USING (place)
        WHERE EXISTS (SELECT 1 FROM rows r WHERE r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.size = p.n)
        QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + 5 * e.inserts, p.audit || repeat('I', e.inserts)) = 1),
    told AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
            count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
            count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id)
    SELECT o.conv_id, CAST(coalesce(t.gaps, 0) AS BIGINT) AS gaps, coalesce(t.blank, 0) AS blank, coalesce(t.duplicate, 0) AS duplicate,
        coalesce(t.truncated, 0) AS truncated, coalesce(t.illegal, 0) AS illegal, coalesce(b.cost, 0) AS cost, coalesce(b.audit, '') AS audit,
        sha256(coalesce(array_to_string(b.lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id""",
)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    report, repaired = repair.repair(damaged(turns))
    digest = repair.digests(repaired).withColumnRenamed("conv_id", "id2")
    report = report.withColumnRenamed("conv_id", "id1")
    found = turns.select("conv_id").distinct()
    found = found.join(report, found["conv_id"].eqNullSafe(report["id1"]), "left")
    found = found.join(digest, found["conv_id"].eqNullSafe(digest["id2"]), "left")
    numbers = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit("")
    return found.select("conv_id", *numbers, F.coalesce("audit", empty).alias("audit"), F.coalesce("sha256", F.sha2(empty, 256)).alias("repaired_sha256"))


@query("op13_toxicity")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    network = toxicity.train(docs, labels)
    scored = toxicity.flag(toxicity.score(docs, network, cut=0.5, columns=("doc_id", "lang")), toxicity.calibrate(docs, labels, network))
    return scored.select("doc_id", (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted", "threshold", "flagged")
