"""Catalogue entries of the subpackage: one query per operator over its whole
table with production parameters, and its DuckDB twin where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from strataforge.functions.hashing import uniform_sql
from strataforge.llm import (alignment, decontam, exact_dedup, langid, lm_score, minhash, mixing, pieces, pii, secrets,
                            substring_dedup, suffix_dedup, whitening)
from strataforge.llm.common import WORD, lower_az_sql, read

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op6_exact_dedup", f"""
    WITH t AS (SELECT doc_id, {lower_az_sql("coalesce(text, '')")} AS x FROM documents WHERE doc_id IS NOT NULL)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
    FROM t""")
def op6_exact_dedup(spark, sf_dir):
    """Exact duplicate groups of all documents."""
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def mixing_sql(documents: str = "documents", labels: str = "labels") -> str:
    """The mix as DuckDB SQL: a plain sort per source instead of key ranges."""
    return f"""
    WITH q AS (SELECT doc_id, max(1.0 + quality) AS weight FROM {labels} GROUP BY doc_id),
    d AS (SELECT doc_id, source, coalesce(source, '') AS src, source IS NULL AS src_null,
                 CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size
          FROM {documents} WHERE doc_id IS NOT NULL),
    k AS (SELECT d.*, -ln({uniform_sql(mixing.SEED, "d.doc_id")}) / (CASE WHEN weight > 0 THEN weight ELSE 1 END)::DOUBLE
                 AS key FROM d LEFT JOIN q ON d.doc_id = q.doc_id),
    s AS (SELECT src, src_null, sum(size) AS source_size FROM d GROUP BY ALL),
    r AS (SELECT *, list_value(5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE)[(row_number() OVER (ORDER BY src_null, src) - 1) % 3 + 1] AS w
          FROM s),
    o AS (SELECT *, 3 * source_size / w AS ratio FROM r),
    v AS (SELECT *, (sum(source_size) OVER ()
                     - coalesce(sum(3 * source_size) OVER (ORDER BY ratio, src_null, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / sum(w) OVER (ORDER BY ratio, src_null, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o),
    t AS (SELECT *, least((3 * source_size)::DOUBLE,
                          w * (SELECT level FROM v WHERE level <= ratio ORDER BY ratio, level LIMIT 1)) AS target FROM v),
    e AS (SELECT *, CASE WHEN source_size > 0 THEN least(3, floor(target / source_size)) ELSE 0 END AS epochs FROM t),
    f AS (SELECT *, CASE WHEN epochs < 3 THEN floor(target - epochs * source_size) ELSE 0 END AS rest FROM e),
    x AS (SELECT k.doc_id, k.source, k.size, f.source_size, f.target, f.epochs, f.rest,
                 coalesce(sum(k.size) OVER (PARTITION BY k.src, k.src_null ORDER BY k.key, k.doc_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM k JOIN f ON k.src = f.src AND k.src_null = f.src_null)
    SELECT doc_id, source, size, CAST(source_size AS BIGINT) AS source_size, round(target, 6) AS target,
           CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM x"""


@register("op8_mixing", mixing_sql())
def op8_mixing(spark, sf_dir):
    """All documents mixed to source weights 5, 2, 1; quality 1 of ``labels`` doubles a document's chance."""
    quality = read(spark, sf_dir, "labels").select("doc_id", (F.col("quality") + 1.0).alias("weight"))
    return mixing.mix(read(spark, sf_dir, "documents"), quality).withColumn("target", F.round("target", 6))


@register("op4_pii")
def op4_pii(spark, sf_dir):
    """Personal data of all documents."""
    return pii.digest(pii.find(read(spark, sf_dir, "documents")))


@register("op9_secret_scan")
def op9_secret_scan(spark, sf_dir):
    """Secrets of all documents, from an empty ledger."""
    return secrets.digest(secrets.scan(read(spark, sf_dir, "documents"), secrets.fresh_ledger(spark)))


@register("op10_language_id")
def op10_language_id(spark, sf_dir):
    """Language of all documents, learned from the rows that are not held out."""
    docs = read(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(langid.training_rows(docs)))
    return found.select("doc_id", langid.held_out("doc_id", 4).alias("held_out"), "lang_pred", "score",
                        "cross_entropy", "rejected")


def near_sql(documents: str = "documents") -> str:
    """All pairs that share a shingle, and reachability over the links."""
    return f"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({lower_az_sql("coalesce(text, '')")}, '{WORD}') AS w
                         FROM {documents} WHERE doc_id IS NOT NULL),
    sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3),
                  lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) WHEN len(w) > 0 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE [] END) AS s FROM d),
    n AS (SELECT d.doc_id, count(s) AS n FROM d LEFT JOIN sh ON d.doc_id = sh.doc_id GROUP BY d.doc_id),
    pr AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
    ln AS (SELECT a, b FROM pr JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
    ed AS (SELECT a, b FROM ln UNION ALL SELECT b, a FROM ln),
    re AS (SELECT doc_id AS i, doc_id AS r FROM d UNION SELECT ed.b, re.r FROM re JOIN ed ON ed.a = re.i)
    SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept
    FROM n JOIN (SELECT i, min(r) AS component_id FROM re GROUP BY i) c ON c.i = n.doc_id"""


@register("op5_minhash_near_dedup", near_sql())
def op5_minhash_near_dedup(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def passages_sql(documents: str = "documents") -> str:
    """Windows of 13 words grouped by their text."""
    return f"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM {documents} WHERE doc_id IS NOT NULL),
    x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d),
    g AS (SELECT doc_id, i, list_aggregate(w[i:i + 12], 'string_agg', ' ') AS s
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
    b AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM g) WHERE first < doc_id),
    y AS (SELECT x.doc_id, x.j, x.word, coalesce(max(b.i) OVER (PARTITION BY x.doc_id ORDER BY x.j) >= x.j - 12, false) AS gone
          FROM x LEFT JOIN b ON b.doc_id = x.doc_id AND b.i = x.j),
    z AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
                 string_agg(word, ' ' ORDER BY j) FILTER (WHERE NOT gone) AS kept FROM y GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN z ON d.doc_id = z.doc_id"""


@register("op2_substring_dedup", passages_sql())
def op2_substring_dedup(spark, sf_dir):
    """Passages of 13 words that an earlier document has, removed from all documents."""
    return substring_dedup.digest(substring_dedup.repeated_passages(read(spark, sf_dir, "documents")))


@register("op3_suffix_dedup")
def op3_suffix_dedup(spark, sf_dir):
    """Every copy of byte strings of 400 that occur twice, removed from all documents."""
    return suffix_dedup.digest(suffix_dedup.repeated_bytes(read(spark, sf_dir, "documents"), keep_first=False))


def decontam_sql(documents: str = "documents", benchmark: str = "benchmark") -> str:
    """Every aligned window scored by exact shingle multisets; no fingerprints."""
    def five(w: str) -> str:
        return (f"CASE WHEN len({w}) >= 5 THEN list_transform(range(1, len({w}) - 3), lambda i: list_aggregate({w}[i:i + 4], 'string_agg', ' ')) "
                f"WHEN len({w}) > 0 THEN [list_aggregate({w}, 'string_agg', ' ') || ' ' || len({w})] ELSE [] END")
    return f"""
    WITH d AS (SELECT doc_id, regexp_extract_all({lower_az_sql("coalesce(text, '')")}, '{WORD}') AS w FROM {documents} WHERE doc_id IS NOT NULL),
    b AS (SELECT item_id, regexp_extract_all({lower_az_sql("coalesce(text, '')")}, '{WORD}') AS w FROM {benchmark} WHERE item_id IS NOT NULL),
    dl AS (SELECT doc_id, {five("w")} AS s FROM d),
    bl AS (SELECT item_id, len(w) AS length, {five("w")} AS s FROM b WHERE len(w) > 0),
    ds AS (SELECT doc_id, len(s) AS total, unnest(s) AS h, generate_subscripts(s, 1) - 1 AS p FROM dl),
    bs AS (SELECT item_id, length, len(s) AS m, unnest(s) AS h, generate_subscripts(s, 1) - 1 AS q FROM bl),
    st AS (SELECT DISTINCT doc_id, length, greatest(length - 4, 1) AS span, greatest(0, least(p - q, total - greatest(length - 4, 1))) AS start
           FROM ds JOIN bs USING (h)),
    ws AS (SELECT st.doc_id, st.length, st.start, ds.h, count(*) AS mine FROM st JOIN ds ON ds.doc_id = st.doc_id
           AND ds.p >= st.start AND ds.p < st.start + st.span GROUP BY ALL),
    n AS (SELECT doc_id, length, start, sum(mine) AS n FROM ws GROUP BY ALL),
    t AS (SELECT item_id, length, m, h, count(*) AS theirs FROM bs GROUP BY ALL),
    x AS (SELECT ws.doc_id, t.item_id, ws.length, ws.start, t.m, sum(least(mine, theirs)) AS shared FROM ws JOIN t USING (h, length) GROUP BY ALL),
    y AS (SELECT x.*, n.n + x.m - x.shared AS joint FROM x JOIN n USING (doc_id, length, start)),
    z AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY shared / joint DESC, start) AS r FROM y WHERE 100 * shared >= 75 * joint)
    SELECT doc_id, item_id, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, round(shared / joint, 6) AS similarity FROM z WHERE r = 1"""


@register("op7_decontamination", decontam_sql())
def op7_decontamination(spark, sf_dir):
    """Benchmark passages in all documents."""
    return decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@register("op1_lm_score")
def op1_lm_score(spark, sf_dir):
    """Model scores of all documents, learned from the rows that are not held out."""
    held = langid.held_out("doc_id", 7)
    out = lm_score.score(read(spark, sf_dir, "documents"), ~held)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def vocabulary(name: str) -> str:
    """A public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op11_embedding_whitening")
def op11_embedding_whitening(spark, sf_dir):
    """First components of all embeddings, whitened."""
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


@register("op12_sentencepiece")
def op12_sentencepiece(spark, sf_dir):
    """Piece ids of all documents, and the texts decoded from them."""
    data = pieces.read_model(vocabulary("piece_bpe_32k.model"))
    return pieces.digest(pieces.round_trip(read(spark, sf_dir, "documents"), data))


@register("op13_token_alignment")
def op13_token_alignment(spark, sf_dir):
    """Byte-level and piece tokens of all documents, aligned."""
    a, b = (pieces.read_model(vocabulary(f)) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.digest(alignment.align(read(spark, sf_dir, "documents"), a, b))
