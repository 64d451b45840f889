"""The registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempestry.llm import (
    chat,
    dedup_exact,
    dedup_lines,
    dedup_substrings,
    html,
    mixing,
    near_dups,
    packing,
    quality,
    ranked_search,
    secrets,
    warc,
    whitening,
)
from tempestry.llm.common import reachable, table

#: The tokenizer of the packed sequences; its file is installed beside the library that names it.
TOKENIZER = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reachable(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@_query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and risk-controlled verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted from their event logs, and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    events = chat.events_of_rows(rows.unionByName(chat.control_sample(spark)))
    return chat.read_back(chat.format_log(events))


_CONTROL = "|".join(map(re.escape, chat.CONTROLS))
ORACLES["op2_chat_format"] = rf"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, length(text) + length(regexp_replace(text, '[^\\]', '', 'g'))
    + len(regexp_extract_all(text, '{_CONTROL}')) AS escaped FROM r)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(escaped + length(role) + 12 + 1 + 10 + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@_query
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


ORACLES["op3_source_mix"] = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  CASE WHEN doc_id IS NULL THEN md5(coalesce(text, '')) END AS mark FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS tie
  FROM d GROUP BY source),
sw AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][tie % 3 + 1] AS weight, source_size * 2 AS cap,
  sum(source_size) OVER () * 1.5::DOUBLE AS total FROM s),
sl AS (SELECT *, (total - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS unit
  FROM sw WINDOW before AS (ORDER BY cap / weight, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
su AS (SELECT *, arg_min(unit, [cap / weight, tie]) FILTER (unit * weight < cap) OVER () AS level FROM sl),
t AS (SELECT source, source_size, CASE WHEN level IS NULL THEN CAST(cap AS DOUBLE) ELSE least(CAST(cap AS DOUBLE), level * weight) END AS target FROM su),
c AS (SELECT d.source, size < 50 AS light, sum(size) AS words, any_value(source_size) AS source_size, any_value(target) AS target
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source GROUP BY d.source, size < 50 HAVING sum(size) > 0),
cw AS (SELECT *, words * CASE WHEN light THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight, words * 2 AS cap, CAST(light AS INTEGER) AS tie FROM c),
cl AS (SELECT *, (target - coalesce(sum(cap) OVER before, 0)) /
    (sum(weight) OVER (PARTITION BY source) - coalesce(sum(weight) OVER before, 0)) AS unit
  FROM cw WINDOW before AS (PARTITION BY source ORDER BY cap / weight, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cu AS (SELECT *, arg_min(unit, [cap / weight, tie]) FILTER (unit * weight < cap) OVER (PARTITION BY source) AS level FROM cl),
e AS (SELECT *, floor(CASE WHEN level IS NULL THEN CAST(cap AS DOUBLE) ELSE least(CAST(cap AS DOUBLE), level * weight) END
    / words * 1e9 + 0.5) / 1e9 AS expected FROM cu),
f AS (SELECT source, light, floor(expected) AS certain, (expected - floor(expected)) / (1 - (expected - floor(expected))) AS odds,
  max(target) OVER (PARTITION BY source) - sum(floor(expected) * words) OVER (PARTITION BY source) AS rest FROM e),
u AS (SELECT d.*, f.certain, f.odds, f.rest, (CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || mark)), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM d LEFT JOIN f ON d.source IS NOT DISTINCT FROM f.source AND (d.size < 50) = f.light),
r AS (SELECT *, CASE WHEN odds > 0 THEN u / (1 - u) / odds END AS rank FROM u),
k AS (SELECT *, rank IS NOT NULL AND sum(size) FILTER (rank IS NOT NULL) OVER (PARTITION BY source ORDER BY rank NULLS LAST, coalesce(doc_id, 0), size, coalesce(mark, '')
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size / 2.0::DOUBLE <= rest AS drawn FROM r)
SELECT k.doc_id, k.size, t.source_size, t.target, CAST((coalesce(k.certain, 0) + CAST(k.drawn AS INTEGER)) * k.size AS BIGINT) AS taken
FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
"""


@_query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets of every document, by patterns and by character models."""
    return secrets.scan(table(spark, sf_dir, "documents")).drop("found")


@_query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without lines that many documents share."""
    result = dedup_lines.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return result.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op5_line_dedup"] = r"""
WITH l AS (SELECT doc_id, i, line, lower_ascii AS k FROM (
  SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)) AS s,
  LATERAL (SELECT translate(regexp_replace(regexp_replace(line, '^[ 	-
]+', ''), '[ 	-
]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii)),
r AS (SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.*, r.k IS NOT NULL AND l.doc_id <> r.last AS gone FROM l LEFT JOIN r USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@_query
def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, sf_dir, "pages"))


@_query
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's shingle set, and its component of similar documents."""
    return near_dups.similar_documents(table(spark, sf_dir, "documents"))


ORACLES["op7_ngram_jaccard"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.b, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.a = d.doc_id
"""


@_query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which copy of each text stays."""
    return dedup_exact.exact_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op8_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents),
g AS (SELECT doc_id, sha256(text) AS text_sha256, min(doc_id) OVER (PARTITION BY text) AS keep_id,
      count(*) OVER (PARTITION BY text) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


@_query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@_query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 35 words that occur again."""
    result = dedup_substrings.without_repeats(table(spark, sf_dir, "documents"))
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op10_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM p),
r AS (SELECT doc_id, i FROM h WHERE h IN (SELECT h FROM h GROUP BY h HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM r),
u AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d),
k AS (SELECT u.*, c.j IS NOT NULL AS gone FROM u LEFT JOIN c USING (doc_id, j))
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(s.gone, 0) AS n_removed, sha256(coalesce(s.kept, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) FILTER (gone) AS gone, string_agg(word, ' ' ORDER BY j) FILTER (NOT gone) AS kept
  FROM k GROUP BY doc_id) s USING (doc_id)
"""


@_query
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and read back through the merged index of captures."""
    captures = warc.archive_pages(table(spark, sf_dir, "pages"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op11_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT *, CASE WHEN strlen(html) >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS first FROM p)
SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""


@_query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all documents for each benchmark item."""
    return ranked_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"""
ORACLES["op12_ranked_search"] = f"""
WITH t AS (SELECT doc_id, {_TERMS} FROM documents),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM p, c GROUP BY term, docs),
m AS (SELECT doc_id, 75 + (25 * n * docs) // terms AS m FROM d, c),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {_TERMS} FROM benchmark) GROUP BY item_id, term),
s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20
"""


@_query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings along the principal components of their different vectors."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
