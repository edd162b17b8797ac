"""The registered queries of the operators: each over its whole table, with the parameters of production."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gigloom.llm import alignment, decontaminate, langid, lattice_lm, lexical, license_scan, line_dedup, mixing, ngram_join, token_counts, topk, toxicity, wrappers
from gigloom.llm.store import read
from gigloom.llm.tokens import public

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"


def _shingled(width: int, table: str, key: str) -> str:
    """SQL for (key, shingle), distinct: the `width`-word runs of each text, or all its words if they are fewer."""
    return f"""(SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= {width} THEN list_transform(range(1, len(w) - {width - 2}),
        lambda i: array_to_string(w[i:i + {width - 1}], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS s
        FROM (SELECT {key}, {_WORDS} AS w FROM {table}))"""


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies: sets of 4-word shingles with a Jaccard similarity of 0.85 or more."""
    return ngram_join.groups_of_near_copies(read(spark, sf_dir, "documents"), width=4, similarity=(85, 100))


OP1_SQL = f"""WITH RECURSIVE s AS MATERIALIZED {_shingled(4, 'documents', 'doc_id')},
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS MATERIALIZED (SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
r(u, v) AS (SELECT u, v FROM l UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.v, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
LEFT JOIN (SELECT u, min(v) AS v FROM r GROUP BY u) m ON m.u = d.doc_id"""

def _fold(k: int) -> Column:
    """Which of k folds a document is in, by its id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(k))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How toxic every text is, learned from labels outside the held-out fold."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), _fold(3) != 1)
    return toxicity.scored(docs, model).select(
        "doc_id", F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned outside the held-out fold."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.languages(docs, _fold(5) != 0)
    return found.select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every text under the subword lattice model and the word base, learned outside the held-out fold."""
    scored = lattice_lm.scored(read(spark, sf_dir, "documents"), _fold(10) != 0)
    return scored.select("doc_id", F.coalesce(_fold(10) == 0, F.lit(False)).alias("held_out"),
                         "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated run of whole lines and sentences that goes, with its offsets in the original text."""
    return line_dedup.repeated_passages(read(spark, sf_dir, "documents"), anywhere=False)


_WS = r"\x20\x09-\x0D"
OP5_SQL = rf"""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
placed AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base
    FROM lines),
runs AS (SELECT doc_id, i, base, regexp_extract_all(line, '[{_WS}]*[^{_WS}]+') AS r FROM placed),
words AS (SELECT doc_id, i, base, unnest(r) AS w, generate_subscripts(r, 1) AS j FROM runs),
ends AS (SELECT doc_id, i, j, regexp_replace(w, '^[{_WS}]+', '') AS word,
    base + sum(length(w)) OVER (PARTITION BY doc_id, i ORDER BY j)::BIGINT AS e FROM words),
cut AS (SELECT *, e - length(word) AS s, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    coalesce(sum((word[-1] IN ('.', '!', '?'))::INT) OVER (PARTITION BY doc_id, i ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k
    FROM ends),
units AS (SELECT 'sentence' AS kind, doc_id, i, k, min(s) AS s, max(e) AS e, count(*) AS n, string_agg(low, ' ' ORDER BY j) AS norm
    FROM cut GROUP BY doc_id, i, k
  UNION ALL SELECT 'line', doc_id, i, 0, min(s), max(e), count(*), string_agg(low, ' ' ORDER BY j) FROM cut GROUP BY doc_id, i),
judged AS (SELECT *, row_number() OVER (PARTITION BY kind, norm ORDER BY doc_id, s) > 1 AS again, min(doc_id) OVER (PARTITION BY kind, norm) AS first,
    row_number() OVER (PARTITION BY kind, doc_id ORDER BY s) AS place FROM units),
marks AS (SELECT *, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS island FROM judged WHERE again AND kind = 'sentence'),
spans AS (SELECT doc_id, min(s) AS s, max(e) AS e FROM marks GROUP BY doc_id, island HAVING sum(n) >= {line_dedup.MIN_RUN}
  UNION ALL SELECT doc_id, s, e FROM judged WHERE again AND kind = 'line' AND n >= {line_dedup.MIN_LINE}),
opened AS (SELECT *, coalesce(max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= s, FALSE) AS joins FROM spans),
numbered AS (SELECT *, sum((NOT joins)::INT) OVER (PARTITION BY doc_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS part FROM opened),
merged AS (SELECT doc_id, min(s) AS s, max(e) AS e FROM numbered GROUP BY doc_id, part)
SELECT p.doc_id, p.s AS start, p.e AS "end", sum(m.n)::BIGINT AS n_words, min(m.first) AS first_doc_id
FROM merged p JOIN marks m ON m.doc_id = p.doc_id AND m.s >= p.s AND m.s < p.e GROUP BY p.doc_id, p.s, p.e"""


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice in every text: which, where, and how much of its template is there."""
    return license_scan.licenses(read(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document a mix of all sources takes, weights 5, 2, 1."""
    return mixing.mixed(read(spark, sf_dir, "documents"), weights=(5, 2, 1)).select(
        "doc_id", "size", "source_size", "target", "taken", "source")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector among all others."""
    return topk.nearest(read(spark, sf_dir, "embeddings"), k=10, every=100)


OP8_SQL = """WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
QUALIFY rank <= 10"""


def op9_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, by wrappers inferred from all pages of its host."""
    return wrappers.extracted(read(spark, sf_dir, "pages"))


# the given pages have their text in h1 and p blocks of one article element
_BLOCK = r"""trim(regexp_replace(replace(replace(replace(replace(regexp_replace(replace(x, '<br>', ' '), '</?b>', '', 'g'),
    '&quot;', '"'), '&quot', '"'), '&amp;', '&'), '&amp', '&'), '\s+', ' ', 'g'))"""
OP9_SQL = rf"""WITH t AS (SELECT page_id, url, array_to_string(list_filter(list_transform(string_split_regex(
    regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|\z)', 1), '</?(?:h1|p)>'), lambda x: {_BLOCK}), lambda x: x <> ''), chr(10)) AS text FROM pages)
SELECT page_id, url, text, length(text) AS n_chars FROM t"""


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold 80% or more of a test item's 5-word shingles, or all words in a row of a shorter item."""
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _shingled_lower(table: str, key: str) -> str:
    return _shingled(5, table, key).replace(_LOWER, "lower(text)")


OP10_SQL = f"""WITH w AS MATERIALIZED (SELECT doc_id, {_WORDS.replace(_LOWER, "lower(text)")} AS w FROM documents),
i AS MATERIALIZED {_shingled_lower('benchmark', 'item_id')},
q AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id),
k AS (SELECT DISTINCT len(string_split(s, ' ')) AS k FROM i),
d AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
  FROM w, k WHERE len(w) >= k)
SELECT d.doc_id, i.item_id, q.n AS n_item_shingles, count(*) AS n_found, count(*) / q.n AS containment
FROM d JOIN i ON d.s = i.s JOIN q ON q.item_id = i.item_id
GROUP BY d.doc_id, i.item_id, q.n HAVING 100 * count(*) >= 80 * q.n"""


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents of every benchmark item by their terms."""
    return lexical.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=20)


_TERMS = rf"unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"
OP11_SQL = f"""WITH t AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_TERMS} FROM documents) GROUP BY doc_id, term),
s AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM t GROUP BY doc_id),
g AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM s),
m AS (SELECT doc_id, 100 - 25 + (25 * n * docs) // words AS m FROM s, g),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM t GROUP BY term), g),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {_TERMS} FROM benchmark) GROUP BY item_id, term),
r AS (SELECT q.item_id, t.doc_id, sum(q.times * w.w * ((1000000000 * t.tf) // (1000 * t.tf + 12 * m.m)))::BIGINT AS score
  FROM q JOIN w ON w.term = q.term JOIN t ON t.term = q.term JOIN m ON m.doc_id = t.doc_id GROUP BY q.item_id, t.doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 20"""


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many tokens word_bpe_49k gives every text; the cache of digests is this call's own, so all distinct texts are encoded."""
    return token_counts.counted(read(spark, sf_dir, "documents"), public("word_bpe_49k.json"), limit=2048)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of byte_bpe_50k and piece_bpe_32k line up in every text, and how usual each pair is in the corpus."""
    found = alignment.aligned(read(spark, sf_dir, "documents"), public("byte_bpe_50k.json"), public("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {f.__name__: f for f in (
    op1_ngram_join, op2_toxicity, op3_language_id, op4_lattice_lm, op5_line_dedup, op6_license_scan, op7_mixing, op8_topk, op9_wrappers,
    op10_decontaminate, op11_lexical, op12_token_counts, op13_alignment)}
ORACLES = {"op1_ngram_join": OP1_SQL, "op5_line_dedup": OP5_SQL, "op9_wrappers": OP9_SQL, "op8_topk": OP8_SQL, "op10_decontaminate": OP10_SQL,
           "op11_lexical": OP11_SQL}
