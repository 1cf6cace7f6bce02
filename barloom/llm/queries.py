"""The registered queries of this subpackage, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import chat_format, decontamination, html_text, language, language_model, near_jaccard, packing, periodic_runs, prefix_trie, secret_scan, suffix_dedup, top_k, toxicity

#: public vocabulary of the language model; executors hold the same file
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.deduplicated(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secret_spans(table(spark, folder, "documents"))


@query
def op3_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


SQL["op3_exact_top_k"] = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.languages(table(spark, folder, "documents"))


@query
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontamination.contaminated(decontamination.retrieve(documents, benchmark))


@query
def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    said = F.lit("</s>[INST] ok [/INST]").alias("text")
    turns = F.explode(F.array(F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).alias("turn"), F.lit("assistant").alias("role"))))
    more = spark.range(1).select(turns.alias("t")).select(F.lit(-1).cast("long").alias("conv_id"), F.col("t.turn").cast("long").alias("turn"), "t.role", said)
    return chat_format.chat_digests(rows.unionByName(more, allowMissingColumns=True))


SQL["op6_chat_format"] = """
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), whole AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
           coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS learned,
           sum(length(replace(replace(role, '<', '<.'), '[', '[.')) + length(replace(replace(text, '<', '<.'), '[', '[.'))
               + length('<|im_start|><|im_sep|><|im_end|>')) AS formatted_chars
    FROM said GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
       sha256(learned) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM whole
"""


@query
def op7_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.corpus_scores(table(spark, folder, "documents"), VOCABULARY)


@query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.best_fit_packing(table(spark, folder, "documents"))


@query
def op10_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near_jaccard.jaccard_components(table(spark, folder, "documents"), words=4, least=85)


@query
def op11_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.main_text(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks")


def rebuilt_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations with their first turns taken from the one whose id is the next lower multiple of 5, and all ids."""
    own = prefix_trie.numbered(prefix_trie.filled(rows), ["role", "text"]).withColumnRenamed("pos", "turn")
    ids = own.select("conv_id").distinct()
    rest = F.col("conv_id") % 5
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    heads = own.where((rest == 0) & (F.col("turn") < 8)).withColumnRenamed("conv_id", "base")
    others = ids.where(rest != 0).withColumn("base", F.col("conv_id") - rest)
    first = others.join(heads, "base").where(F.col("turn") < taken).select(*own.columns)
    return own.where((rest == 0) | (F.col("turn") >= taken)).unionByName(first), ids


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(*rebuilt_conversations(table(spark, folder, "conversations")))


SQL["op12_prefix_trie"] = """
WITH own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS turn
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
    -- crc32 of the decimal id, bit by bit: a byte is mixed in, then eight times a bit goes out
    SELECT conv_id, (4294967295 - list_reduce(list_concat([4294967295], flatten(list_transform(
               string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) ELSE xor(s >> 1, (s & 1) * 3988292384) END)) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM own)
), said AS (
    SELECT ids.conv_id, own.turn, own.role, own.text FROM ids JOIN own ON own.conv_id = ids.conv_id AND own.turn >= h
    UNION ALL
    SELECT ids.conv_id, own.turn, own.role, own.text FROM ids JOIN own ON own.conv_id = ids.conv_id - ids.conv_id % 5 AND own.turn < h
), whole AS (
    SELECT ids.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY turn) FILTER (WHERE turn IS NOT NULL), []) AS turns
    FROM ids LEFT JOIN said ON said.conv_id = ids.conv_id GROUP BY ids.conv_id
), passed AS (
    SELECT conv_id, unnest(generate_series(0, len(turns))) AS depth, turns FROM whole
), nodes AS (
    SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(turns) = depth), '') AS ends
    FROM passed GROUP BY depth, turns[1:depth]
), valued AS (
    SELECT n.depth, n.path, n.conv_id, n.n_convs, n.ends, p.conv_id AS parent_conv_id,
           (n.n_convs - 1) * CASE WHEN n.depth = 0 THEN 0 ELSE strlen(n.path[n.depth].text) END AS saved,
           (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.path[1:n.depth] = n.path) AS n_children
    FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
), summed AS (
    SELECT above.depth, above.path, sum(v.saved) AS saved_tokens, count(*) FILTER (WHERE v.n_children = 0) AS n_leaves
    FROM (SELECT path, saved, n_children, unnest(generate_series(0, depth)) AS d FROM valued) v
    JOIN nodes above ON above.depth = v.d AND above.path = v.path[1:v.d] GROUP BY above.depth, above.path
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM valued JOIN summed USING (depth, path)
"""


def with_planted_periods(documents: DataFrame) -> DataFrame:
    """doc_id and text; in a tenth of the documents, by hash, the words from one on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = documents.select(
        "doc_id", "text", g.alias("g"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(packing.WORD), F.lit(0))).alias("words")
    ).withColumn("n", F.size("words"))
    cut = words.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    cut = cut.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    unit = F.slice("words", F.col("a") + 1, F.col("p"))
    repeated = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), repeated), " ")
    return cut.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_periods(table(spark, folder, "documents")))
    longest = F.array_max(F.transform("runs", lambda x: F.struct(x["length"].alias("length"), (-x["start"]).alias("start"), (-x["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n"))), "")
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
