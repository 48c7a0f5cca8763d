"""One registered query per corpus operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.bpe import bpe_digests
from vitrine.llm.collocation import collocations
from vitrine.llm.exact_dedup import exact_dedup
from vitrine.llm.fim import fim_digests
from vitrine.llm.html_extract import extract_pages
from vitrine.llm.line_dedup import line_dedup
from vitrine.llm.mixing import mix_report
from vitrine.llm.packing import pack
from vitrine.llm.quality import quality_report
from vitrine.llm.simhash import simhash_report
from vitrine.llm.suffix_dedup import suffix_dedup
from vitrine.llm.toxicity import toxicity
from vitrine.llm.vafile import vector_top_k
from vitrine.sources.tables import read_table


def op1_vafile_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return vector_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup(docs, counts=True).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "n_lines", "n_removed")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_report(read_table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read_table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(read_table(spark, sf_dir, "documents"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_digests(read_table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vafile_topk": op1_vafile_topk,
    "op2_toxicity": op2_toxicity,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_html_text": op5_html_text,
    "op6_quality": op6_quality,
    "op7_simhash": op7_simhash,
    "op8_bpe": op8_bpe,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_mixing": op10_mixing,
    "op11_fim": op11_fim,
    "op12_collocations": op12_collocations,
    "op13_packing": op13_packing,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op1_vafile_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
        p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM p QUALIFY rank <= 5""",
    "op3_exact_dedup": f"""
        WITH n AS (SELECT doc_id, {_LOWER} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
        FROM n""",
    "op4_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents),
        k AS (SELECT *, trim(line, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS key FROM l),
        s AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT source) >= 10),
        f AS (SELECT *, key IN (SELECT key FROM s)
                  AND row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS LAST, pos) > 1 AS gone FROM k)
        SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
               CASE WHEN count(*) = 1 AND min(line) = '' THEN 0 ELSE count(*) END AS n_lines,
               count(*) FILTER (WHERE gone) AS n_removed
        FROM f GROUP BY doc_id""",
    "op10_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, 'null') || '|' || md5(coalesce(text, ''))), 1, 13))::BIGINT AS r
            FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
              FROM d GROUP BY source),
        w AS (SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INT] AS weight, 2 * source_size AS cap FROM s),
        p AS (SELECT sum(cap) OVER o AS fixed, sum(weight) OVER () - sum(weight) OVER o AS open,
                     sum(source_size) OVER () * 1.5::DOUBLE AS total
              FROM w WINDOW o AS (ORDER BY cap / weight ROWS UNBOUNDED PRECEDING)),
        v AS (SELECT greatest(max(CASE WHEN open > 0 THEN (total - fixed) / open END),
                              max(total) / (SELECT sum(weight) FROM w)) AS level FROM p),
        t AS (SELECT source, source_size, least(cap::DOUBLE, level * weight) AS target FROM w, v),
        q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
        e AS (SELECT *, target - whole * source_size AS rest FROM q),
        z AS (SELECT source, size, count(*) AS m FROM d WHERE size > 0 GROUP BY source, size),
        y AS (SELECT z.source, size, (rest - (sum(m * size) OVER w - m * size))
                     / (sum(m * size * size) OVER (PARTITION BY z.source) - sum(m * size * size) OVER w + m * size * size)::DOUBLE AS k
              FROM z JOIN e ON z.source IS NOT DISTINCT FROM e.source WHERE rest > 0
              WINDOW w AS (PARTITION BY z.source ORDER BY size DESC)),
        k AS (SELECT source, arg_max(k, size) AS k FROM y WHERE k * size <= 1 GROUP BY source),
        u AS (SELECT d.*, source_size, target, whole, rest, coalesce(k.k, 0) AS k, (r + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u,
                     least(1.0::DOUBLE, coalesce(k.k, 0) * size) AS p
              FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source),
        g AS (SELECT *, u * (1 - p) / (u * (1 - p) + (1 - u) * p) AS g FROM u),
        x AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY g RANGE UNBOUNDED PRECEDING) AS upto,
                     sum(size) OVER (PARTITION BY source, g) AS own FROM g),
        c AS (SELECT *, CASE WHEN upto <= rest THEN TRUE WHEN upto - own >= rest THEN FALSE
                             ELSE upto - rest < rest - (upto - own) END AS drawn FROM x)
        SELECT doc_id, size, source_size, target, ((whole + (drawn AND rest > 0)::INT) * size)::BIGINT AS taken,
               (whole + (drawn AND rest > 0)::INT)::BIGINT AS copies, p AS chance, CASE WHEN k > 0 THEN g END AS pareto
        FROM c""",
    "op11_fim": """
        WITH h AS (
            SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
                   sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
        u AS (SELECT doc_id, t, n, ('0x' || substr(d, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(d, 9, 8))::BIGINT % (n + 1) AS b,
                     ('0x' || substr(d, 17, 8))::BIGINT AS h3, ('0x' || substr(d, 25, 8))::BIGINT AS h4 FROM h),
        f AS (SELECT doc_id, t, n, least(a, b) AS p, greatest(a, b) AS q,
                     CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                          WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
        c AS (SELECT *, substr(t, 1, p) AS head, substr(t, p + 1, q - p) AS mid, substr(t, q + 1) AS tail FROM f)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
               sha256(CASE form WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || mid
                                WHEN 'spm' THEN '<S>' || tail || '<P>' || head || '<M>' || mid ELSE t END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM c""",
    "op12_collocations": rf"""
        WITH p AS (SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS (SELECT doc_id, lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
        i AS (SELECT doc_id, lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
        g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f, min(doc_id) AS first_doc
              FROM i, unnest([1, 2, 3, 4]) AS u(k) WHERE i + k - 1 <= len(ws) GROUP BY ALL),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, phrase, f AS a, first_doc, string_split(phrase, ' ') AS ws FROM g WHERE k > 1 AND f >= 30),
        x AS (SELECT c.*, cut, array_to_string(ws[1:cut], ' ') AS h, array_to_string(ws[cut + 1:], ' ') AS t
              FROM c, unnest([1, 2, 3]) AS u(cut) WHERE cut < k),
        s AS (SELECT x.lang, x.phrase, a, x.first_doc, y.f AS l, z.f AS r, cut, ((2000000::HUGEINT * a) // (y.f + z.f))::BIGINT AS score
              FROM x JOIN g y ON y.lang = x.lang AND y.phrase = x.h JOIN g z ON z.lang = x.lang AND z.phrase = x.t
              QUALIFY row_number() OVER (PARTITION BY x.lang, x.phrase ORDER BY score, cut) = 1),
        o AS (SELECT lang, array_to_string(ws[b:b + m - 1], ' ') AS phrase, max(a) AS longer
              FROM c, unnest([2, 3]) AS u(m), unnest([1, 2, 3]) AS v(b) WHERE m < k AND b + m - 1 <= k GROUP BY ALL)
        SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, n, score, s.first_doc
        FROM s JOIN n ON n.lang = s.lang LEFT JOIN o ON o.lang = s.lang AND o.phrase = s.phrase
        WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a QUALIFY rank <= 2000""",
}
