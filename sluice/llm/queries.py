"""The registered queries of this subpackage: operators on their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.bpe import encode_documents
from sluice.llm.centroids import cluster_vectors
from sluice.llm.chat import conversation_digests, format_conversations
from sluice.llm.common import table
from sluice.llm.compact_windows import repeated_passages
from sluice.llm.exact_dedup import exact_groups
from sluice.llm.filter_audit import audit_filters
from sluice.llm.licenses import scan_licenses
from sluice.llm.mixing import mix_to_targets
from sluice.llm.multi_index import nearest
from sluice.llm.ngram_join import ngram_links
from sluice.llm.suffix_dedup import remove_repeats
from sluice.llm.token_counts import count_tokens
from sluice.llm.toxicity import score_toxicity

TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_links(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op7_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


# A turn that says the control strings themselves, to see that they come back.
TRICKY = "</s>[INST] ok [/INST]"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    tricky = spark.range(2).select(F.lit(-1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(TRICKY).alias("text"))
    return conversation_digests(format_conversations(turns.unionByName(tricky)))


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of labelled documents: their language and whether they are good."""
    known = docs.select(F.col("doc_id").alias("_id"), "lang")
    kind = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    joined = labels.join(known, F.col("doc_id") == F.col("_id"))
    return joined.select("doc_id", F.concat_ws("/", "lang", kind).alias("domain"))


LANGUAGES = {"en": 0.55, "de": 0.17, "fr": 0.17, "es": 0.11}
TARGETS = {f"{lang}/{kind}": w * part for lang, w in LANGUAGES.items() for kind, part in (("good", 0.9), ("poor", 0.1))}


def labelled_languages(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of labelled documents: their language."""
    known = docs.select(F.col("doc_id").alias("_id"), F.col("lang").alias("domain"))
    return labels.join(known, F.col("doc_id") == F.col("_id")).select("doc_id", "domain")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return mix_to_targets(docs, labelled_domains(docs, labels), TARGETS)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        size.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        (size > 0).alias("found"),
    )


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_nearest": op2_nearest,
    "op3_bpe": op3_bpe,
    "op4_toxicity": op4_toxicity,
    "op5_ngram_join": op5_ngram_join,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_compact_windows": op7_compact_windows,
    "op8_chat_format": op8_chat_format,
    "op9_mixing": op9_mixing,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_token_counts": op11_token_counts,
    "op12_centroids": op12_centroids,
    "op13_filter_audit": op13_filter_audit,
}


def _escaped(text: str) -> str:
    once = f"regexp_replace({text}, '<(\\\\*/?s>)', '<\\\\\\1', 'g')"
    return f"regexp_replace({once}, '\\[(\\\\*/?INST\\])', '[\\\\\\1', 'g')"


def _rounds(n: int) -> str:
    """Assignments a0 to an, and between them the moved centroids c1 to cn."""
    parts = []
    for i in range(n + 1):
        parts.append(f"""
        a{i} AS MATERIALIZED (
          SELECT r, c, d FROM (
            SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, c) AS place FROM (
              SELECT r, c, list_sum(list_transform(list_zip(k.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
              FROM kept k, c{i} m)) WHERE place = 1
        )""")
        if i < n:
            parts.append(f"""
        s{i} AS MATERIALIZED (
          SELECT c, j, sum(v[j])::BIGINT AS s, count(*) AS n
          FROM a{i} JOIN kept USING (r), unnest(range(1, 65)) AS places(j) GROUP BY c, j
        ), c{i + 1} AS MATERIALIZED (
          SELECT c, coalesce(moved, v) AS v FROM c{i} LEFT JOIN (
            SELECT c, list((s - (s % n + n) % n) // n ORDER BY j) AS moved FROM s{i} GROUP BY c) USING (c)
        )""")
    return ",".join(parts)


EXPECTED = {
    "op5_ngram_join": """
        WITH RECURSIVE words AS (
          SELECT doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
        ), grams AS (
          SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM words
        ), sizes AS (
          SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
        ), pairs AS (
          SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM grams a JOIN grams b USING (g)
          WHERE a.doc_id < b.doc_id GROUP BY ALL
        ), links AS (
          SELECT x, y FROM pairs p JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y
          WHERE 100 * p.n >= 85 * (sx.n + sy.n - p.n)
        ), ways AS (
          SELECT x, y FROM links UNION ALL SELECT y, x FROM links
        ), reach AS (
          SELECT doc_id, doc_id AS other FROM documents
          UNION SELECT doc_id, y FROM reach JOIN ways ON other = x
        )
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id FROM documents d
        LEFT JOIN sizes s USING (doc_id)
        JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)
    """,
    "op8_chat_format": f"""
        WITH turns AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -1, 0, 'user', '{TRICKY}' UNION ALL SELECT -1, 1, 'assistant', '{TRICKY}'
        ), sized AS (
          SELECT *, row_number() OVER w AS place, row_number() OVER w = 1 AND role = 'system' AS is_system,
            20 + length({_escaped('role')}) + length({_escaped('text')}) AS n
          FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
        ), counted AS (
          SELECT *, ceil(n / 4)::BIGINT AS tokens FROM sized
        ), placed AS (
          SELECT *, coalesce(max(tokens) FILTER (is_system) OVER c, 0) AS system_tokens,
            max(n) FILTER (is_system) OVER c AS system_n,
            sum(CASE WHEN is_system THEN 0 ELSE tokens END) OVER w AS until
          FROM counted WINDOW c AS (PARTITION BY conv_id), w AS (PARTITION BY conv_id ORDER BY place)
        ), started AS (
          SELECT *, CASE WHEN is_system THEN 0 ELSE until - tokens END AS since FROM placed
        ), spanned AS (
          SELECT *, since // greatest(1, 2048 - 512 - system_tokens) AS span FROM started
        ), neighbours AS (
          SELECT *, lag(span) OVER w AS span_before, lead(span) OVER w AS span_after
          FROM spanned WINDOW w AS (PARTITION BY conv_id ORDER BY place)
        ), ended AS (
          SELECT *, max(until) OVER s AS span_until, max(span_after) OVER s AS next_span
          FROM neighbours WINDOW s AS (PARTITION BY conv_id, span)
        )
        SELECT conv_id, count(*) AS n_turns,
          sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
          coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
          (sum(n) + coalesce(sum(n) FILTER (next_span > span AND span_until - since <= 512 AND NOT is_system), 0)
            + coalesce(sum(system_n) FILTER (span > span_before), 0))::BIGINT AS formatted_chars
        FROM ended GROUP BY conv_id
    """,
    "op10_suffix_dedup": """
        WITH coded AS (
          SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
        ), strings AS (
          SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS s
          FROM coded, unnest(range(0, len(h) // 2 - 399)) AS places(i)
        ), repeated AS (
          SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY s) AS n FROM strings) WHERE n > 1
        ), joined AS (
          SELECT *, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400, true) AS begins FROM repeated
        ), numbered AS (
          SELECT *, count(*) FILTER (begins) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM joined
        ), spans AS (
          SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY doc_id, span
        ), sums AS (
          SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS b FROM spans GROUP BY doc_id
        ), pieces AS (
          SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
          UNION ALL SELECT doc_id, coalesce(b, 0), len(h) // 2 FROM coded LEFT JOIN sums USING (doc_id)
        ), kept AS (
          SELECT doc_id, sha256(unhex(string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a))) AS kept_sha256
          FROM pieces JOIN coded USING (doc_id) GROUP BY doc_id
        )
        SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
          coalesce(n_spans, 0) AS n_spans, kept_sha256, coalesce(n_removed, 0) > 0 AS found
        FROM coded LEFT JOIN sums USING (doc_id) JOIN kept USING (doc_id)
    """,
    "op12_centroids": f"""
        WITH kept AS MATERIALIZED (
          SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
          FROM embeddings WHERE len(embedding) = 64
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), c0 AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM (
            SELECT v, sha256('2:' || vec_id::VARCHAR) AS h FROM kept ORDER BY h LIMIT 40)
        ),{_rounds(5)}
        SELECT vec_id, c::INTEGER AS cluster, d AS distance,
          sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
          sha256(array_to_string(c5.v, ',')) AS centroid_sha256
        FROM a5 JOIN kept USING (r) JOIN c5 USING (c)
    """,
    "op13_filter_audit": """
        WITH words AS (
          SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
            list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
          FROM documents
        ), judged AS (
          SELECT part, doc_id, (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END)
            || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
            || (CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) THEN 'C' ELSE '' END)
            || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
            || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS f
          FROM words
        ), marked AS (
          SELECT part, f, d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
            d.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic FROM judged d
        ), counts AS (
          SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
          FROM marked GROUP BY part, f
        ), letters AS (
          SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
        ), orders AS (
          SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
          FROM letters a, letters b, letters c, letters d, letters e
          WHERE b.l <> a.l AND c.l NOT IN (a.l, b.l) AND d.l NOT IN (a.l, b.l, c.l) AND e.l NOT IN (a.l, b.l, c.l, d.l)
        ), steps AS (
          SELECT filter_order, step::INTEGER AS step, filter_order[step] AS own, filter_order[1:step - 1] AS earlier
          FROM orders, unnest(range(1, 6)) AS s(step)
        ), each AS (
          SELECT *, contains(f, own) AS fails, translate(f, earlier, '') <> f AS gone FROM counts, steps
        ), sums AS (
          SELECT part, filter_order, step, own,
            coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
            coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
            coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
            coalesce(sum(n) FILTER (f = own), 0)::BIGINT AS unique_fails,
            coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost,
            coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost
          FROM each GROUP BY part, filter_order, step, own
        )
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
          sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
        FROM sums
    """,
    "op6_exact_dedup": """
        WITH texts AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS same FROM documents
        )
        SELECT doc_id,
          min(doc_id) OVER (PARTITION BY same) AS keep_id,
          count(*) OVER (PARTITION BY same) AS group_size,
          doc_id = min(doc_id) OVER (PARTITION BY same) AS kept,
          sha256(same) AS text_sha256
        FROM texts
    """,
}
