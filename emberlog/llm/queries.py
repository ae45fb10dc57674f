"""The registered queries of this package, with the SQL that must give the same rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm import negatives, repeats, trie, warc
from emberlog.llm.bpe import bpe_code
from emberlog.llm.chat import rotated
from emberlog.llm.decontaminate import decontaminated
from emberlog.llm.html_text import html_text
from emberlog.llm.licenses import license_scan
from emberlog.llm.ngram_join import ngram_components
from emberlog.llm.phrases import compared
from emberlog.llm.quality import fit, held_out, with_score, with_statistics
from emberlog.llm.shared import checkpointed, fresh_folder, hinted, table
from emberlog.llm.token_counts import token_counts

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

TOKEN_LIMIT = 512
KEEP_SCORE = 0.3


def register(name: str, sql: str | None = None) -> Callable:
    def add(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        _QUERIES[name] = function
        if sql is not None:
            _SQL[name] = sql
        return function

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with held_out, score and predicted, learnt from the labelled rows that are not held out."""
    learnt = labels.filter(~held_out()).select(F.col("doc_id").alias("labelled"), "quality")
    rows = docs.select("doc_id", "text").join(hinted(learnt), F.col("doc_id") == F.col("labelled"))
    model = fit(with_statistics(rows, keep=("quality",)), "quality")
    return with_score(docs, model).withColumns(
        {"held_out": held_out(), "predicted": (F.col("score") >= KEEP_SCORE).cast("int")}
    )


@register("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@register(
    "op2_warc",
    """
    WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                      sha256(coalesce(html, '')) AS payload_digest FROM pages),
         f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM p LEFT JOIN f USING (payload_digest)
    """,
)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, the archives normalised, and their records read back by the index."""
    folder = fresh_folder(spark, "warc")
    rows = warc.with_revisits(table(spark, sf_dir, "pages"), "page_id", "html")
    warc.write_archives(rows, f"{folder}/streams", "page_id", "url")
    records = warc.read_records(warc.normalise(spark, f"{folder}/streams", f"{folder}/members"), payloads=False)
    return records.select(
        warc.page_number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_number(F.col("refers_to")).alias("refers_to"),
    )


@register("op3_phrases")
def op3_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and how alike they and the next document's are."""
    return compared(table(spark, sf_dir, "documents"))


@register(
    "op4_decontaminate",
    r"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
         b AS (SELECT item_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
         i AS (SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS win
               FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s
                     FROM b WHERE len(w) > 0)),
         x AS (SELECT row, n, s, array_to_string(w[s : s + n - 1], ' ') AS win
               FROM (SELECT row, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
                     FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n)),
         h AS (SELECT row, item_id, s, n FROM x JOIN i USING (n, win)),
         c AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(generate_series(s, s + n - 1)) AS p FROM h)
               GROUP BY row),
         o AS (SELECT row, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS items
               FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS k FROM h) GROUP BY row)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN c USING (row) LEFT JOIN o USING (row)
    """,
)
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in benchmark windows, and the items they come from."""
    judged = decontaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@register("op5_html_text")
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text(table(spark, sf_dir, "pages"))


@register("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they go beyond the limit."""
    counted = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@register("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded, as digests."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe_code(table(spark, sf_dir, "documents"), path, digests=True)


@register(
    "op8_chat_rotation",
    r"""
    WITH t AS (SELECT conv_id AS conv, turn, regexp_replace(coalesce(role, 'unknown'), '[^\p{L}\p{N}_-]', '_', 'g') AS role,
                      regexp_replace(coalesce(text, ''), '<\|(im_start|im_end)\|>', '<|\1 |>', 'g') AS text
               FROM conversations),
         p AS (SELECT DISTINCT conv, role AS participant FROM t WHERE role <> 'system'),
         v AS (SELECT t.*, participant, role = participant AS masked,
                      '<|im_start|>' || CASE WHEN role = participant THEN 'assistant' WHEN role = 'system' THEN 'system'
                                             ELSE 'user name=' || role END || chr(10) AS head
               FROM t JOIN p ON t.conv IS NOT DISTINCT FROM p.conv),
         s AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS segment FROM v),
         e AS (SELECT *, row_number() OVER w AS position, CAST(sum(length(segment)) OVER w AS BIGINT) AS finish FROM s
               WINDOW w AS (PARTITION BY conv, participant ORDER BY turn NULLS FIRST, role, text
                            ROWS UNBOUNDED PRECEDING))
    SELECT conv AS conv_id, participant, turn, position, segment, masked, finish - length(segment) AS segment_start,
           CASE WHEN masked THEN finish - length(segment) + length(head) END AS mask_start,
           CASE WHEN masked THEN finish - 1 END AS mask_end
    FROM e
    """,
)
def op8_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the view of each participant, turn by turn with places and masks."""
    return rotated(table(spark, sf_dir, "conversations")).withColumnRenamed("conv", "conv_id")


@register("op9_licenses")
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices and texts in every document."""
    return license_scan(table(spark, sf_dir, "documents"))


@register(
    "op10_ngram_join",
    r"""
    WITH RECURSIVE w AS (
           SELECT doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') AS w FROM documents),
         s AS (SELECT DISTINCT doc_id, array_to_string(w[k : k + least(len(w), 5) - 1], chr(1)) AS g
               FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS k FROM w WHERE len(w) > 0)),
         n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
         p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id
               GROUP BY ALL),
         l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
         r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
    FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = d.doc_id
    """,
)
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of each document under links of at least 0.75 on five-word shingles."""
    return ngram_components(table(spark, sf_dir, "documents"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, depth, digest, size) and conversations (conv, len) after each has taken its first turns from another.

    The first crc32(conv) % 9 turns are those of conversation conv - conv % 5, as far as there are any, then come a conversation's
    own turns after as many.
    """
    of, least = F.col("conv"), F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(9))
    convs = turns.groupBy("conv").agg(F.max("position").alias("n"))
    convs = convs.select("conv", "n", least.alias("h"), (of - of % 5).alias("base"))
    lent = convs.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(lent, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = checkpointed(
        convs.select("conv", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"))
    )
    own = turns.join(convs, "conv").filter("position > h")
    own = own.select("conv", (F.col("taken") + F.col("position") - F.col("h")).alias("depth"), "digest", "size")
    heads = turns.filter("position <= 8").withColumnRenamed("conv", "base")
    taken = heads.join(convs, "base").filter("position <= h")
    return own.unionByName(taken.select("conv", F.col("position").alias("depth"), "digest", "size")), convs.select("conv", "len")


@register(
    "op11_trie",
    r"""
    WITH t AS (SELECT conv_id AS c, sha256(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
                      CAST(strlen(coalesce(text, '')) AS BIGINT) AS b,
                      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), k) AS p
               FROM conversations WHERE conv_id IS NOT NULL),
         v AS (SELECT c, count(*) AS n, xor(4294967295, list_reduce(
                          list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
                          lambda s, x: list_reduce(list_prepend(xor(s, x), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
                                                   lambda y, z: xor(y >> 1, (y & 1) * 3988292384)))) % 9 AS h
               FROM t GROUP BY c),
         m AS (SELECT v.c, least(v.h, coalesce(o.n, 0)) + p - v.h AS d, k, b
               FROM v LEFT JOIN v o ON o.c = v.c - v.c % 5 JOIN t ON t.c = v.c WHERE p > v.h
               UNION ALL SELECT v.c, p, k, b FROM v JOIN t ON t.c = v.c - v.c % 5 WHERE p <= v.h),
         l AS (SELECT v.c, coalesce(list(k ORDER BY d) FILTER (d IS NOT NULL), []) AS path,
                      list_prepend(0, coalesce(list(b ORDER BY d) FILTER (d IS NOT NULL), [])) AS sizes
               FROM v LEFT JOIN m USING (c) GROUP BY v.c),
         q AS (SELECT c, len(path) AS n, d, path[1 : d] AS path, sizes[d + 1] AS b
               FROM (SELECT *, unnest(generate_series(0, len(path))) AS d FROM l)),
         g AS (SELECT d, path, min(c) AS conv_id, count(*) AS n_convs, any_value(b) AS b,
                      coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '') AS ends
               FROM q GROUP BY d, path),
         k AS (SELECT path[1 : d - 1] AS path, count(*) AS n_children FROM g WHERE d > 0 GROUP BY 1),
         u AS (SELECT path[1 : e] AS path, CAST(sum(leaf) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
               FROM (SELECT g.path, CAST(n_children IS NULL AS INT) AS leaf, (n_convs - 1) * b AS saved,
                            unnest(generate_series(0, d)) AS e FROM g LEFT JOIN k ON k.path = g.path) GROUP BY 1)
    SELECT g.conv_id, g.d AS depth, o.conv_id AS parent_conv_id, g.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
           saved_tokens, sha256(g.ends) AS ends_sha256
    FROM g JOIN u ON u.path = g.path LEFT JOIN k ON k.path = g.path LEFT JOIN g o ON g.d > 0 AND o.path = g.path[1 : g.d - 1]
    """,
)
def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of the rebuilt conversations."""
    turns, convs = rebuilt(checkpointed(trie.numbered(table(spark, sf_dir, "conversations"))))
    paths = checkpointed(trie.with_nodes(turns, convs))
    nodes = trie.prefix_trie(paths).join(trie.ends_digests(paths), "node", "left")
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


@register(
    "op12_negatives",
    r"""
    WITH e AS (SELECT vec_id AS id, min(r) AS r FROM (
                   SELECT vec_id, struct_pack(label := CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END, vec :=
                              list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS r
                   FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND
                       coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true))
                   GROUP BY 1),
         v AS (SELECT id, r.label AS label, r.vec AS vec FROM e),
         s AS (SELECT a.id AS a, b.id AS b, a.label = b.label AS same,
                      CAST(list_inner_product(CAST(a.vec AS DOUBLE[]), CAST(b.vec AS DOUBLE[])) AS BIGINT) AS score
               FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 100 = 0),
         p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
    SELECT p.a AS anchor_id, p.b AS positive_id,
           CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS INT) AS rank, s.b AS negative_id,
           p.score AS positive_score, s.score AS negative_score
    FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
    QUALIFY rank <= 10
    """,
)
def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of five positives of every hundredth vector."""
    rows = table(spark, sf_dir, "embeddings").filter(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    )
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("int")
    vec = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    rows = rows.select(F.col("vec_id").cast("bigint").alias("id"), label.alias("label"), vec.alias("vec"))
    return negatives.hard_negatives(rows, F.col("id") % 100 == 0)


@register(
    "op13_repeats",
    r"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
               FROM documents),
         x AS (SELECT row, doc_id, s, array_to_string(w[s : s + 19], ' ') AS g
               FROM (SELECT row, doc_id, w, unnest(generate_series(1, len(w) - 19)) AS s FROM d WHERE len(w) >= 20)),
         f AS (SELECT g, min((doc_id, s)) AS least FROM x GROUP BY g HAVING count(*) > 1),
         r AS (SELECT DISTINCT row, p FROM (SELECT row, unnest(generate_series(s, s + 19)) AS p FROM x JOIN f USING (g)
                                            WHERE (doc_id, s) > least)),
         k AS (SELECT row, p, w[p] AS word FROM (SELECT row, w, unnest(generate_series(1, len(w))) AS p FROM d)),
         o AS (SELECT k.row, count(*) AS n_kept, string_agg(word, ' ' ORDER BY k.p) AS kept
               FROM k ANTI JOIN r ON k.row = r.row AND k.p = r.p GROUP BY k.row)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN o USING (row)
    """,
)
def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of twenty words that occur earlier."""
    cut = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
