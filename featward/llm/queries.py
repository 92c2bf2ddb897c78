"""The registered queries of this subpackage, and SQL for those that it can express."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featward.llm.bpe import encode_bpe
from featward.llm.decontaminate import find_contamination
from featward.llm.divergence import LEAST_DOCUMENTS, SCALE, TERM_RANKS, source_divergence
from featward.llm.jaccard import jaccard_components
from featward.llm.langid import fit_languages, identify_languages
from featward.llm.licenses import RULES, SENTENCE_END, SENTENCES, plain_sentence, scan_licenses
from featward.llm.lm import fit_kneser_ney, score_kneser_ney
from featward.llm.manifest import FAN, merkle_manifest
from featward.llm.quality import fit_rules, score_quality
from featward.llm.tokencount import count_tokens
from featward.llm.topk import top_k
from featward.llm.toxicity import SeverityModel, fit_severity, predict_severity
from featward.llm.urls import filter_urls, rule_table
from featward.llm.workers import prepare

QUALITY_AT = 0.7  # a score from here on predicts label 1
TOXIC_AT = 0.1  # a probability of any toxic grade from here on,
TOXIC_ODDS = 3.0  # if its odds are so many times those of a text without a telling word
MOST_TOKENS = 2048  # a text with more is over the limit
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder_is(id_col: str, divisor: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; false for NULL."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % divisor == remainder, F.lit(False))


def tokenizer() -> tuple[str, str]:
    """Rank file and pattern of the queries' tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = tokenizer()
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_bpe(docs, ranks, pattern, decoded_col="decoded").select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder_is("doc_id", 4, 2)
    model = fit_rules(docs, _table(spark, sf_dir, "labels").filter(~held_out))
    return score_quality(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= QUALITY_AT).cast("int").alias("predicted")
    )


def toxic_from(model: SeverityModel) -> float:
    """The probability of a toxic grade from which on a text is called toxic."""
    if not len(model.thresholds):
        return 2.0
    odds = TOXIC_ODDS * math.exp(-model.thresholds[0])
    return max(TOXIC_AT, odds / (1 + odds))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_severity(docs, _table(spark, sf_dir, "labels"))
    return predict_severity(docs, model).select(
        "doc_id", "severity", "grade", "p_toxic", (F.col("p_toxic") >= toxic_from(model)).alias("toxic")
    )


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder_is("doc_id", 7, 2)
    model = fit_kneser_ney(docs.filter(~held_out))
    return score_kneser_ney(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "lm.n_tokens",
        "lm.n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "lm.base_score",
        "lm.score",
    )


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, rule_table(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder_is("doc_id", 5, 0)
    model = fit_languages(docs.filter(~held_out))
    return identify_languages(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", F.to_json("languages").alias("languages")
    )


def op11_tokencount(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > MOST_TOKENS).alias("over_limit"),
    )


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_table(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lower = {"text": F.translate("text", ASCII_UPPER, ASCII_LOWER)}
    return merkle_manifest(docs, tampered=tampered, tampered_fields=lower).drop("source")


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_bpe,
        op2_decontaminate,
        op3_licenses,
        op4_quality,
        op5_toxicity,
        op6_topk,
        op7_lm,
        op8_urls,
        op9_jaccard,
        op10_langid,
        op11_tokencount,
        op12_divergence,
        op13_manifest,
    )
}

_LOWER = f"translate({{}}, '{ASCII_UPPER}', '{ASCII_LOWER}')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _licenses_sql() -> str:
    known = ", ".join(f"({_quoted(plain_sentence(s))}, {_quoted(i)})" for i, s in SENTENCES.items())
    parts = f"string_split(regexp_replace(coalesce(text, ''), '{SENTENCE_END}', '\\1' || chr(10) || '\\2', 'g'), chr(10))"
    steps, last = [], "s"
    for n, (licence, ids) in enumerate(RULES):
        seq = _quoted("".join(f"<{i}>" for i in ids))
        times = f"(length(seq) - length(replace(seq, {seq}, ''))) // length({seq})"
        steps.append(
            f"t{n} AS (SELECT doc_id, ids, replace(seq, {seq}, '|') AS seq, "
            f"got || repeat({_quoted(',' + licence)}, CAST({times} AS BIGINT)) AS got FROM {last})"
        )
        last = f"t{n}"
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
parts AS (SELECT rowid AS r, doc_id, unnest({parts}) AS part, generate_subscripts({parts}, 1) AS i
          FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)),
hits AS (SELECT r, i, id FROM parts
         JOIN known ON sentence = lower(trim(regexp_replace(part, '[^A-Za-z0-9]+', ' ', 'g')))),
listed AS (SELECT r, list(id ORDER BY i) AS ids FROM hits GROUP BY r),
s AS (SELECT doc_id, coalesce(ids, []) AS ids,
             coalesce('<' || array_to_string(ids, '><') || '>', '') AS seq, '' AS got
      FROM (SELECT row_number() OVER () AS r, doc_id FROM documents) LEFT JOIN listed USING (r)),
{', '.join(steps)}
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
       substr(got, 2) AS licenses FROM {last}"""


def _urls_sql() -> str:
    rules = ", ".join(f"({_quoted(a)}, {_quoted(h)}, {_quoted(p)})" for a, h, p in URL_RULES)
    host = _LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")
    return f"""
WITH rules(action, rh, rp) AS (VALUES {rules}),
p AS (SELECT row_number() OVER () AS r, page_id, {host} AS host,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
fit AS (SELECT r, rh || rp AS rule, action, row_number() OVER (
            PARTITION BY r ORDER BY length(rh) + length(rp) DESC, action DESC, rh || rp DESC) AS place
        FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM fit WHERE place = 1) USING (r)"""


TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
      FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""

JACCARD_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id
         GROUP BY 1, 2),
link AS (SELECT met.a, met.b FROM met JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT link.b, reach.b FROM reach JOIN link ON link.a = reach.a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.b AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS b FROM reach GROUP BY a) c ON c.a = w.doc_id"""

DIVERGENCE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  {_LOWER.format("coalesce(text, '')")} AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM d),
kept AS (SELECT lang, t FROM w GROUP BY lang, t HAVING count(DISTINCT r) >= {LEAST_DOCUMENTS}),
c AS (SELECT lang, source, t, count(*) AS n FROM w JOIN kept USING (lang, t) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
s AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT lang, s.source, t, coalesce(n, 0) AS n, CAST(1 + {SCALE} * (coalesce(n, 0) + 1) // (total + v) AS BIGINT) AS p
      FROM s JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, t)),
q AS (SELECT lang, t, CAST(1 + {SCALE} * (sum(n) + 1) // (any_value(total) + any_value(v)) AS BIGINT) AS q
      FROM p JOIN (SELECT lang, sum(total) AS total FROM s GROUP BY lang) USING (lang) JOIN v USING (lang) GROUP BY lang, t),
met AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT lang, source, 'pair' AS part, item, CAST(coalesce(value, 0) AS BIGINT) AS value
          FROM (SELECT g.lang, g.source, o.source AS item FROM g JOIN g o ON g.lang = o.lang AND g.source <> o.source)
          LEFT JOIN met USING (lang, source, item)),
terms AS (SELECT lang, source, 'term' AS part, t AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
          FROM p JOIN q USING (lang, t) WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TERM_RANKS}"""


def _manifest_sql(levels: int = 6, top_levels: int = 4) -> str:
    """Level by level, for up to 16**levels rows per source and 16**top_levels sources."""
    crc = (
        "4294967295 - list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), "
        "lambda a, x: xor(a // 256, crc_table[xor(a % 256, x) + 1]), CAST(4294967295 AS BIGINT))"
    )

    def leaf(text: str) -> str:
        fields = ("doc_id", "source", "lang", "n_chars", text)
        return "sha256(" + " || ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || {f}, '-')" for f in fields) + ")"

    lower = _LOWER.format("text")
    steps = [
        "crc AS (SELECT list(v ORDER BY i) AS crc_table FROM (SELECT i, list_reduce(range(8), "
        "lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS v FROM range(256) r(i)))",
        f"leaves AS (SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, {leaf('text')} AS leaf, "
        f"CASE WHEN ({crc}) % 5 = 0 THEN {leaf(lower)} END AS other FROM documents, crc)",
        "u0 AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves)",
        "a0 AS (SELECT s AS grp, pos, leaf AS node, count(*) OVER (PARTITION BY s) AS n FROM u0)",
    ]

    def tree(name: str, depth: int) -> None:
        for k in range(depth):
            steps.append(
                f"{name}r{k} AS (SELECT grp, pos // {FAN} AS run, list(node ORDER BY pos) AS nodes, any_value(n) AS n "
                f"FROM {name}{k} GROUP BY grp, pos // {FAN})"
            )
            steps.append(
                f"{name}{k + 1} AS (SELECT grp, run AS pos, CASE WHEN n > 1 THEN sha256(array_to_string(nodes, '')) "
                f"ELSE nodes[1] END AS node, (n + {FAN - 1}) // {FAN} AS n FROM {name}r{k})"
            )

    tree("a", levels)
    steps.append(f"b0 AS (SELECT 0 AS grp, grp AS pos, node, count(*) OVER () AS n FROM a{levels})")
    tree("b", top_levels)
    rows = (
        f"w0 AS (SELECT u0.*, a{levels}.node AS subroot, b{top_levels}.node AS root, coalesce(other, leaf) AS folded, '' AS proof "
        f"FROM u0 JOIN a{levels} ON a{levels}.grp = s, b{top_levels})"
    )
    steps.append(rows)
    runs = [("a", k, "s", "w.pos") for k in range(levels)] + [("b", k, "0", "w.s") for k in range(top_levels)]
    for i, (name, k, grp, pos) in enumerate(runs):
        place = f"({pos} // {FAN**k}) % {FAN}"
        before, after = f"array_to_string(nodes[1:{place}], '')", f"array_to_string(nodes[{place} + 2:], '')"
        steps.append(
            f"w{i + 1} AS (SELECT w.* REPLACE (CASE WHEN n > 1 THEN sha256({before} || folded || {after}) ELSE folded END AS folded, "
            f"proof || {before} || {after} AS proof) FROM w{i} w JOIN {name}r{k} ON grp = {grp} AND run = {pos} // {FAN ** (k + 1)})"
        )
    return (
        f"WITH {', '.join(steps)} SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, "
        f"folded = root AS verified FROM w{len(runs)}"
    )


LLM_ORACLE = {
    "op3_licenses": _licenses_sql(),
    "op6_topk": TOPK_SQL,
    "op8_urls": _urls_sql(),
    "op9_jaccard": JACCARD_SQL,
    "op12_divergence": DIVERGENCE_SQL,
    "op13_manifest": _manifest_sql(),
}
