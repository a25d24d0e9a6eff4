"""The queries of the ten operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adlake.llm import archives, contamination, edits, mixing, neardup, negatives, packing, periods, pseudonyms, repeats, rules, suffixes, toxicity
from adlake.llm.registry import query, table
from adlake.llm.shared import written

TOKENIZER = "word_bpe_49k.json"


def remainder(doc_id: str | Column, of: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % of


@query("op1_feistel_pseudonyms")
def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its personal values replaced, and how many of each kind."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", pseudonyms.pseudonymise(F.col("text")).alias("r")).select(
        "doc_id",
        "r.text",
        *(F.coalesce(F.col(f"r.{k}").cast("long"), F.lit(0)).alias(f"n_{k}") for k in pseudonyms.KINDS),
    )


_FIRST_SECOND = 1_700_000_000


@query(
    "op2_archive_index",
    f"""
    WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
    f AS (SELECT h, min(page_id) AS low FROM p WHERE strlen(h) >= {archives.REVISIT_BYTES} GROUP BY h),
    k AS (SELECT p.*, low, array_to_string(list_reverse(string_split(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)), '.')), ',')
                 || ')' || regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '#.*$', '') AS url_key
          FROM p LEFT JOIN f USING (h))
    SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
           CASE WHEN low < page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN low < page_id THEN low END AS refers_to, url_key,
           row_number() OVER (PARTITION BY url_key ORDER BY page_id) AS nth
    FROM k
    """,
)
def op2_archive_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages have no time of capture; one a second from a fixed one on stands for it."""
    captured = F.timestamp_seconds(F.col("page_id") + _FIRST_SECOND)
    return archives.archive_round_trip(table(spark, sf_dir, "pages"), captured).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "nth"
    )


@query("op3_decision_list")
def op3_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("rule")


@query("op4_binary_packing")
def op4_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return packing.pack(table(spark, sf_dir, "documents"), path).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def sample_edits(text: Column, doc_id: Column, length: Column) -> Column:
    """Edits that follow from the document alone: a span goes, and another place of the text is put in. A longer text has
    more and longer ones, by its root, so all of them together stay a part of it."""
    root = F.floor(F.sqrt(length.cast("double"))).cast("int")

    def one(k: Column) -> Column:
        drawn = lambda salt, below: F.pmod(F.xxhash64(doc_id, k, F.lit(salt)), F.greatest(below, F.lit(1)).cast("long")).cast("int")
        return F.struct(
            drawn("at", length + 1).alias("at"),
            drawn("cut", root + 40).alias("cut"),
            F.substring(text, drawn("from", length) + 1, drawn("put", root + 60)).alias("put"),
        )

    return F.transform(F.sequence(F.lit(1), 2 + F.floor(root / 16).cast("int")), one)


@query("op5_edit_counts")
def op5_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after its edits, and how much was encoded for them. The trees are written
    first; the edits work on those that are read back."""
    path = public_tokenizers.path(TOKENIZER)
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kept = written(docs.select("*", edits.trees(F.col("text"), path).alias("tree"), F.char_length("text").alias("length")), "trees")
    todo = sample_edits(F.col("text"), F.col("doc_id"), F.col("length"))
    after = edits.edited(F.col("text"), F.col("tree"), todo, path)
    return kept.select("doc_id", after.alias("after")).select(
        "doc_id",
        F.col("after.n_tokens_before").alias("tokens_before"),
        F.col("after.n_tokens").alias("tokens_after"),
        F.col("after.n_segments").cast("long").alias("n_segments"),
        F.col("after.n_encoded").cast("long").alias("n_encoded"),
        F.sha2(F.col("after.text").cast("binary"), 256).alias("text_sha256"),
    )


@query("op6_context_mixing")
def op6_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of remainder 0 are held out; one in fifty, all of them training documents, fits the mixture before the predictors learn it too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mixing.score(docs, remainder("doc_id", 10) == 0, remainder("doc_id", 50) == 1)


_CAPITALS = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTER_WORDS = rf"regexp_extract_all({_CAPITALS}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op7_winnowing",
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_LETTER_WORDS} AS ws FROM documents),
    b AS (SELECT item_id, {_LETTER_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL),
    bw AS (SELECT item_id, least(len(ws), 10) AS k, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS g
           FROM b, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS t(i) WHERE len(ws) > 0),
    ks AS (SELECT DISTINCT k FROM bw),
    dw AS (SELECT r, i, k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM d, ks, unnest(range(1, len(ws) - k + 2)) AS t(i)),
    hit AS (SELECT DISTINCT r, i, k, item_id FROM dw JOIN bw USING (k, g)),
    cover AS (SELECT r, count(DISTINCT p) AS n FROM hit, unnest(range(i, i + k)) AS t(p) GROUP BY r),
    its AS (SELECT r, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
            FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
    SELECT doc_id, len(ws) AS n_words, coalesce(cover.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
           sha256(coalesce(s, '')) AS items_sha256, coalesce(cover.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN cover USING (r) LEFT JOIN its USING (r)
    """,
)
def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hit = F.col("hits")
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        hit["n_words"].alias("n_words"),
        contamination.words_hit(hit).alias("n_hit"),
        F.size(hit["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform(hit["items"], lambda x: x.cast("string"))), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(hit["start"]) > 0).alias("contaminated"),
    )


_BLANK_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(
    "op8_super_kmers",
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_BLANK_WORDS} AS ws FROM documents),
    w AS (SELECT r, doc_id, i, array_to_string(ws[i:i + 49], ' ') AS g FROM d, unnest(range(1, len(ws) - 48)) AS t(i)),
    f AS (SELECT g, min(doc_id) AS low FROM w GROUP BY g),
    gone AS (SELECT DISTINCT r, p FROM w JOIN f USING (g), unnest(range(i, i + 50)) AS t(p) WHERE low < doc_id),
    stays AS (SELECT r, string_agg(ws[p], ' ' ORDER BY p) AS s, count(*) AS n
              FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS p FROM d) ANTI JOIN gone USING (r, p) GROUP BY r)
    SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
    FROM d LEFT JOIN stays USING (r)
    """,
)
def op8_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


@query("op9_ftrl_toxicity")
def op9_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1)
    score = toxicity.scorer(spark, toxicity.fit(docs, labels))
    return docs.select("doc_id", (F.coalesce(remainder("doc_id", 3), F.lit(1)) == 1).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.7).cast("int")
    )


_FOLDED_WORDS = rf"regexp_extract_all({_CAPITALS}, '[^\x20\x09-\x0D]+')"


@query(
    "op10_multi_index_hamming",
    f"""
    WITH RECURSIVE d AS (SELECT doc_id, {_FOLDED_WORDS} AS ws FROM documents),
    sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 1], ' ') AS s
           FROM d, unnest(range(1, greatest(len(ws) - 1, least(len(ws), 1)) + 1)) AS t(i)),
    n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
    sized AS (SELECT doc_id, s, n FROM sh JOIN n USING (doc_id)),
    links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM sized a JOIN sized b
              ON a.s = b.s AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
              GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    least_id AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept
    FROM d LEFT JOIN n USING (doc_id) JOIN least_id ON a = doc_id
    """,
)
def op10_multi_index_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def with_loops(text: Column, doc_id: Column) -> Column:
    """The text, of one document in ten with its words from a drawn one on repeating the first of them over and over."""
    drawn = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def looped(w: Column) -> Column:
        n, g = F.size(w), F.floor(drawn / 10)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (g % 8 + 3))).cast("int")
        one = lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), one), " ")).otherwise(text)

    return F.when(drawn % 10 == 0, F.element_at(F.transform(F.array(words), looped), 1)).otherwise(text)


_CRC = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END)"""


@query(
    "op11_periodic_runs",
    rf"""
    WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
               xor({_CRC}, 4294967295) AS h FROM documents),
    a AS (SELECT *, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a, h // 10 AS g FROM w),
    d AS (SELECT r, doc_id, CASE WHEN a IS NULL THEN ws ELSE list_transform(range(0, len(ws)),
          lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(ws) - a) // (3 + g % 8)) END]) END AS ws FROM a),
    t AS (SELECT r, i, ws[i + 1] AS word, len(ws) AS n FROM d, unnest(range(0, len(ws))) AS x(i)),
    m AS (SELECT u.r, v.i - u.i AS q, u.i FROM t u JOIN t v ON u.r = v.r AND u.word = v.word AND v.i > u.i AND 3 * (v.i - u.i) <= u.n),
    f AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM m),
    s AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM f GROUP BY r, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
    runs AS (SELECT r, start, length, min(q) AS period FROM s GROUP BY r, start, length),
    best AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS k FROM runs),
    listed AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS l FROM runs GROUP BY r),
    gone AS (SELECT DISTINCT r, i FROM runs, unnest(range(start + period, start + length)) AS x(i)),
    kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS k FROM t ANTI JOIN gone USING (r, i) GROUP BY r)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, (1000 * length) // period AS exponent_milli,
           sha256(coalesce(l, '')) AS runs_sha256, sha256(coalesce(kept.k, '')) AS collapsed_sha256
    FROM d LEFT JOIN listed USING (r) LEFT JOIN (SELECT * FROM best WHERE k = 1) USING (r) LEFT JOIN kept USING (r)
    """,
)
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periods.collapse_runs(docs, with_loops(F.col("text"), F.col("doc_id")))
    number = lambda x, k: x[k].cast("long")
    larger = lambda a, b: number(b, "length") * number(a, "period") > number(a, "length") * number(b, "period")
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(larger(a, b), b).otherwise(a))
    lines = F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return found.select("doc_id", "runs", "kept", best.alias("best"), listed.alias("listed")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(number(F.col("best"), k).alias(k) for k in ("start", "length", "period")),
        F.expr("1000L * best.length div best.period").alias("exponent_milli"),
        sha(F.col("listed")).alias("runs_sha256"),
        sha(F.col("kept")).alias("collapsed_sha256"),
    )


@query(
    "op12_previous_factors",
    """
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
    n AS (SELECT *, len(x) // 2 AS n FROM d),
    w AS (SELECT r, doc_id, i, substring(x, 2 * i + 1, 100) AS g FROM n, unnest(range(0, n - 49)) AS t(i)),
    f AS (SELECT g, min(doc_id) AS low FROM w GROUP BY g),
    hit AS (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 50, true) AS opens FROM w JOIN f USING (g) WHERE low < doc_id),
    span AS (SELECT r, min(i) AS a, max(i) + 50 AS b
             FROM (SELECT r, i, count(*) FILTER (opens) OVER (PARTITION BY r ORDER BY i) AS k FROM hit) GROUP BY r, k),
    gap AS (SELECT r, b AS a, lead(a, 1, NULL) OVER (PARTITION BY r ORDER BY a) AS b FROM span UNION ALL SELECT r, 0, min(a) FROM span GROUP BY r),
    kept AS (SELECT r, string_agg(substring(x, 2 * a + 1, 2 * (coalesce(b, n) - a)), '' ORDER BY a) AS x FROM gap JOIN n USING (r) GROUP BY r),
    gone AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY r)
    SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(coalesce(kept.x, n.x))) AS kept_sha256
    FROM n LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
    """,
)
def op12_previous_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query(
    "op13_hard_negatives",
    """
    WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
               FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
               AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
          FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT anchor_id, p.id AS positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
           n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM p JOIN (SELECT * FROM s WHERE NOT same) n USING (anchor_id)
    WHERE 80 * p.score <= 100 * n.score AND n.score <= p.score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, p.id ORDER BY n.score DESC, n.id) <= 5
    """,
)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 100; labels of ids divisible by 7 are moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)
